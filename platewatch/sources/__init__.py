"""Where sightings come from: files, tables, relational databases and message topics."""
