"""JDBC sink and source.

A stream is written through ``foreachBatch``: each micro-batch is appended
with ``batchsize`` rows per round trip (one connection and transaction per
partition task), under a bounded retry.  A ``batch_id`` column is added so a
micro-batch replayed after a failure can be recognised and collapsed by
readers (the target table has no key of its own).  Credentials come from
options the caller passes, never from code.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_batch_id(df: DataFrame, batch_id: int | None) -> DataFrame:
    """Tag rows with their micro-batch id (replays carry the same id)."""
    return df if batch_id is None else df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))


def append_batch(df: DataFrame, url: str, table: str, props: Mapping[str, str],
                 batch_id: int | None = None, batchsize: int = 100, retries: int = 3,
                 backoff_s: float = 1.0) -> None:
    """Append one batch; retry the whole batch up to ``retries`` times.

    Partitions commit one by one, so a failed attempt may leave rows behind, and
    so may an earlier run of a replayed batch.  With a ``batch_id``, every
    attempt deletes the batch's rows first, which makes both harmless; without
    one, a retry can repeat rows."""
    out = with_batch_id(df, batch_id)
    opts = {**props, "batchsize": str(batchsize)}
    for attempt in range(retries + 1):
        try:
            if batch_id is not None:
                delete_batch(df.sparkSession, url, table, props, batch_id)
            out.write.mode("append").jdbc(url, table, properties=opts)
            return
        except Exception:  # noqa: BLE001 - the driver's error types vary
            if attempt == retries:
                raise
            time.sleep(backoff_s * (attempt + 1))


def delete_batch(spark: SparkSession, url: str, table: str, props: Mapping[str, str], batch_id: int) -> None:
    """``DELETE FROM table WHERE batch_id = ?``, run once by the database; a
    table that does not exist yet has nothing to delete."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for k, v in props.items():
        settings.setProperty(k, v)
    con = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        if not con.getMetaData().getTables(None, None, table.split(".")[-1], None).next():
            return
        statement = con.prepareStatement(f"DELETE FROM {table} WHERE batch_id = ?")
        statement.setLong(1, int(batch_id))
        statement.executeUpdate()
    finally:
        con.close()


def batch_writer(url: str, table: str, props: Mapping[str, str], batchsize: int = 100,
                 retries: int = 3) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function appending each micro-batch over JDBC."""
    def _write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, url, table, props, batch_id, batchsize, retries)
    return _write


def read_query(spark: SparkSession, url: str, sql: str, props: Mapping[str, str],
               partition: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of a SQL query run by the database.  Pass ``partition``
    (``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions``)
    with ``dbtable`` to read in parallel ranges."""
    r = spark.read.format("jdbc").option("url", url).options(**props)
    if partition:
        return r.option("dbtable", f"({sql}) q").options(**partition).load()
    return r.option("query", sql).load()


def row_count(spark: SparkSession, url: str, table: str, props: Mapping[str, str]) -> DataFrame:
    """``SELECT COUNT(*)`` executed by the database (one row)."""
    return read_query(spark, url, f"SELECT COUNT(*) AS n_rows FROM {table}", props)
