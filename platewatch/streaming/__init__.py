"""Live alerts."""
