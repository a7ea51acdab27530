"""Vehicle-sighting analytics as plain Spark DataFrame and streaming plans."""
