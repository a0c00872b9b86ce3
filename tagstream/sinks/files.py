"""File sinks.

``write_snapshot`` is the all-or-nothing batch write: a new table state goes
to a fresh directory and only directories with Spark's ``_SUCCESS`` marker
are visible to ``read_latest``; a failed job leaves no partial state behind.
``text_stream`` is the row-format text sink for streams; the file sink's
metadata log makes its output exactly-once across restarts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_snapshot(df: DataFrame, base: str, partition_by: list[str] | None = None) -> str:
    """Write a complete new table state under ``base``; returns its path.

    The data goes to a fresh directory first; only after that job succeeded
    is one row appended to ``base/_commits``.  Readers follow the commit
    log, so a failed or half-written snapshot is never visible."""
    base = base.rstrip("/")
    path = f"{base}/snapshot={int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    spark = df.sparkSession
    commit = spark.createDataFrame([(path, int(time.time() * 1000))], "path string, committed_ms long")
    commit.coalesce(1).write.mode("append").parquet(f"{base}/_commits")
    return path


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    """The newest committed snapshot under ``base``."""
    return spark.read.parquet(latest_version(spark, base))


def versions(spark: SparkSession, base: str) -> DataFrame:
    """The commit log of a snapshot table: path, committed_ms."""
    return spark.read.schema("path string, committed_ms long").parquet(f"{base.rstrip('/')}/_commits")


def latest_version(spark: SparkSession, base: str) -> str:
    """Path of the newest committed snapshot."""
    newest = versions(spark, base).orderBy(F.col("committed_ms").desc(), F.col("path").desc()).limit(1).collect()
    if not newest:
        raise FileNotFoundError(f"no committed snapshot under {base}")
    return newest[0]["path"]


def write_clustered(df: DataFrame, path: str, by: Sequence[str], bloom: Mapping[str, int],
                    group_bytes: int = 32 << 20) -> None:
    """A table laid out for look-ups, as secondary indexes serve them: rows are
    ranged and sorted by ``by``, so a predicate on it meets the files and row
    groups whose statistics hold it, and the columns of ``bloom`` (each with the
    distinct values to expect in a row group) carry Bloom filters, so an equality
    on them skips the other row groups.  ``group_bytes`` sizes row groups."""
    w = df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("errorifexists")
    w = w.option("parquet.block.size", group_bytes)
    for col, distinct in bloom.items():
        w = w.option(f"parquet.bloom.filter.enabled#{col}", "true")
        w = w.option(f"parquet.bloom.filter.expected.ndv#{col}", distinct)
    w.parquet(path)


def point_lookup(spark: SparkSession, path: str, col: str, values: Sequence) -> DataFrame:
    """Rows of a clustered table with ``col`` among ``values``.  The scan gets
    one equality per value, which Bloom filters can test; above 100 values a
    join is the better plan and a list is refused."""
    values = list(dict.fromkeys(values))
    if len(values) > 100:
        raise ValueError("more than 100 values: join with a table of them")
    table = spark.read.parquet(path)
    hit = F.lit(False)
    for v in values:
        hit = hit | (F.col(col) == F.lit(v))
    return table.where(hit)


def text_stream(df: DataFrame, path: str, checkpoint: str, text_col: str = "value",
                trigger: dict | None = None) -> StreamingQuery:
    """Row-format UTF-8 text sink: one line per row of ``text_col``."""
    w = (df.select(text_col).writeStream.format("text").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()
