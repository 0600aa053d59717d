"""Batch sources and sinks: files, catalog tables, JDBC, control tables."""
