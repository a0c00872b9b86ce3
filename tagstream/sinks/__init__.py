"""Outputs: files (text, parquet snapshots), JDBC, Kafka, console."""
