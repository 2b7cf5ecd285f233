"""Reading landed payloads and stored tables, and writing tables."""
