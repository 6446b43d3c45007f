"""Readers and writers: source files, the batch-partitioned lake, versioned tables, JDBC."""
