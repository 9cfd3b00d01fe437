"""Writers for files, tables and streams."""
