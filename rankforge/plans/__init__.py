"""Stand-in tables built from the driver's parquet tables, and the
registered demonstration queries with their independent SQL twins."""
