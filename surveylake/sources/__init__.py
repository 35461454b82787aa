"""Reading raw files, reading and writing lake tables, the catalog."""
