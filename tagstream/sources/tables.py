"""Parquet table sources and the canonical reading projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table.  Selections made later prune the scan's columns
    and filters are pushed into it; nothing is read eagerly."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over the cluster's cores before CPU-heavy per-row work
    (tokenising whole texts) when the scan yields fewer partitions than the
    default parallelism -- e.g. a file with a single row group is read by
    one task however it is split.  A round-robin shuffle of the raw rows,
    skipped entirely when the scan already has enough partitions (any large
    input) and for streams."""
    if df.isStreaming:
        return df
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


#: Bytes of text that a task of ``deal_text`` gets.
TASK_TEXT = 8 << 20


def deal_text(df: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """Deal rows to tasks of about ``TASK_TEXT`` bytes of text, however large a
    scan's tasks are, for work whose memory grows with a task's words; also
    their number.  The text is read once more to find its size."""
    size = df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, min(-(-size // TASK_TEXT), 100_000))
    return df.repartition(tasks), tasks


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The same table, one file or a folder of files, as a file stream (new
    files become micro-batches)."""
    # as a pattern the path may name a file; a plain one must be a folder
    path = f"{sf_dir.rstrip('/')}/{name}.parque[t]"
    reader = spark.readStream.schema(read_table(spark, sf_dir, name).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def events_as_readings(events: DataFrame) -> DataFrame:
    """Map the ``events`` table onto the canonical reading record.

    device = user id, sensor = event type, area = one of two lines by user,
    value, unit derived from the sensor, ts (timestamp_ntz), seq = event id.
    """
    return events.select(
        F.col("user_id").cast("string").alias("device"),
        F.concat(F.lit("line_"), (F.col("user_id") % 2 + 1).cast("string")).alias("area"),
        F.col("event_type").alias("sensor"),
        F.col("value"),
        F.concat(F.lit("u_"), F.col("event_type")).alias("unit"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
    )
