"""Input schemas, readers, writers and literal lookup tables."""
