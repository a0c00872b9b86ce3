"""Text sources: one record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Lines of text files as ``value`` (batch)."""
    return spark.read.option("encoding", encoding).text(path)


def read_text_stream(spark: SparkSession, path: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Follow a directory: each new file's lines arrive as ``value``.

    Replaces re-reading a growing file on a timer: the file source keeps a
    log of files already read, so each file is read exactly once.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def split_lines(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Explode a document column into ``(id, line_no, line)``.

    Runs per row inside the scan's stage (no shuffle); every line of every
    document is kept, line numbers start at 0.
    """
    return df.select(
        F.col(id_col),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"),
    )
