"""Inputs: parquet tables, text lines, JSON/Kafka messages, JDBC, literals."""

from tagstream.sources.tables import events_as_readings, read_table, spread, stream_table  # noqa: F401
from tagstream.sources.text import read_text, read_text_stream, split_lines  # noqa: F401
from tagstream.sources.literal import literal_rows  # noqa: F401
