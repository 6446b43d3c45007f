"""Bronze ingest as an incremental file stream."""
