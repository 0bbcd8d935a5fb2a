"""Writers: files, tables, logs."""
