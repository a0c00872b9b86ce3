"""Run streams to completion and read their results back.

``available_now`` processes everything currently in the source as a finite
series of micro-batches and stops, which turns a streaming job into a
replayable batch job (tests, backfills).  Outputs and checkpoints live in
the cluster's shared folder (``session.scratch_path``), never in a
machine-local temp dir.

Event time: ``withWatermark`` needs ``timestamp`` (not ``timestamp_ntz``).
``ntz_to_instant`` / ``instant_to_ntz`` convert through epoch microseconds,
so the result is independent of the session time zone.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagstream.functions.scalars import EPOCH_NTZ
from tagstream.operators.tables import last_per_key
from tagstream.session import path_exists
from tagstream.sinks.files import latest_version


def ntz_to_instant(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), c))


def instant_to_ntz(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(EPOCH_NTZ))


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Start streaming queries with ``n`` state partitions (default: the
    cluster's default parallelism, one per core).

    A stateful stream fixes its state partition count from
    ``spark.sql.shuffle.partitions`` at first start, and AQE does not
    resize it.  The session value is restored once the query has started."""
    n = n or spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def start(writer_fn: Callable[[], object], spark: SparkSession, until_idle: bool = False):
    """Start a streaming query built by ``writer_fn`` under
    ``state_partitions`` and wait until its bounded input is drained.  With
    ``until_idle`` (triggers that go on for ever), batches run until the source
    has nothing new, then the query is stopped."""
    with state_partitions(spark):
        q = writer_fn()
    if until_idle:
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    else:
        q.awaitTermination()
    return q


def _goes_on(trigger: dict | None) -> bool:
    return bool(trigger) and not (trigger.get("availableNow") or trigger.get("once"))


def run_updates(stream: DataFrame, keys: Sequence[str], base: str, checkpoint: str,
                trigger: dict | None = None) -> DataFrame:
    """Run an aggregating stream in update mode until its input is drained
    and return the final row of every key.

    Each micro-batch's updated rows are written to ``base/batch_id=N``
    (overwrite, so a replayed batch replaces itself); the result is the row
    of each key from its latest batch.  Unlike append mode this also
    returns windows the watermark has not closed yet -- a bounded source's
    end flushes every window, as a batch run would.
    """
    spark: SparkSession = stream.sparkSession
    start(lambda: update_writer(stream, base).option("checkpointLocation", checkpoint)
          .trigger(**(trigger or {"availableNow": True})).start(), spark, _goes_on(trigger))
    if not path_exists(spark, base):  # no micro-batch ever had rows
        return spark.createDataFrame([], stream.schema)
    return last_updates(spark, base, keys)


def update_writer(stream: DataFrame, base: str):
    """A writer that keeps each micro-batch's updated rows as
    ``base/batch_id=N``."""
    def _write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}")

    return stream.writeStream.outputMode("update").foreachBatch(_write)


def last_updates(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """The latest row of every key that ``update_writer`` kept."""
    return last_per_key(spark.read.parquet(base), list(keys), "batch_id").drop("batch_id")


def late_rows_dropped(query) -> int:
    """Rows the stateful operators discarded as later than the watermark,
    summed over the query's recent progress reports."""
    total = 0
    for prog in query.recentProgress:
        for op in prog.get("stateOperators", []):
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total


def run_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 trigger: dict | None = None, on_done=None) -> DataFrame:
    """Append a stream to files until drained; return the files' contents.
    ``on_done(query)`` is called after the run (e.g. to read metrics)."""
    q = start(lambda: stream.writeStream.format(fmt).option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append")
              .trigger(**(trigger or {"availableNow": True})).start(), stream.sparkSession, _goes_on(trigger))
    if on_done:
        on_done(q)
    spark = stream.sparkSession
    if not path_exists(spark, path):  # no micro-batch ever ran
        return spark.createDataFrame([], stream.schema)
    return spark.read.text(path) if fmt == "text" else spark.read.schema(stream.schema).format(fmt).load(path)


def run_with_restarts(writer_fn: Callable[[], object], spark: SparkSession, timeout_s: float = 600) -> int:
    """Run a query to the end of its input, stopping and starting it again
    after every micro-batch (a drill for recovery from its checkpoint); the
    number of starts.  ``writer_fn`` starts the query, with any trigger that goes
    on, such as ``processingTime="10 seconds"``: each start runs a batch at
    once, so the drill doesn't wait for the interval."""
    until, starts, before = time.monotonic() + timeout_s, 0, None
    while True:
        with state_partitions(spark):
            q = writer_fn()
        starts += 1
        try:
            while q.lastProgress is None:  # the first batch of this start, or the news that there is none
                if q.exception() is not None:
                    raise q.exception()
                if time.monotonic() > until:
                    raise TimeoutError(f"no batch ended within {timeout_s} s")
                time.sleep(0.05)
            done = q.lastProgress
        finally:
            q.stop()
        # a start without new data reports the batch that would come next
        if done["numInputRows"] == 0 and done["batchId"] == before:
            return starts
        before = done["batchId"] + (1 if done["numInputRows"] else 0)


def split_late(stream: DataFrame, ts: str, lateness: str, base: str, checkpoint: str,
               trigger: dict | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows on time, late rows, and exact counts per micro-batch (batch_id,
    accepted, late) of a whole run, however long.

    A row is late if its time is behind the watermark that stood before its
    batch: the largest time seen less ``lateness``.  One pass per batch writes
    both kinds to tables keyed by batch (a replayed batch replaces itself) and
    counts them with ``observe``; nothing depends on the progress reports the
    engine keeps.  A row without a time is on time."""
    spark = stream.sparkSession

    def mark_of(bid: int):
        if bid == 0:
            return None
        return spark.read.schema("batch_id long, accepted long, late long, mark timestamp").parquet(
            f"{base}/counts/batch_id={bid - 1}").first()["mark"]

    def _process(batch: DataFrame, bid: int) -> None:
        mark = mark_of(bid)
        t = F.col(ts).cast("timestamp")
        late = F.coalesce(t < F.lit(mark), F.lit(False)) if mark is not None else F.lit(False)
        seen = Observation()
        rows = batch.withColumn("is_late", late).observe(
            seen, F.count_if(F.col("is_late")).alias("late"), F.count(F.lit(1)).alias("n"),
            F.max(t - F.expr(f"INTERVAL {lateness}")).alias("top"))
        rows.write.mode("overwrite").partitionBy("is_late").parquet(f"{base}/rows/batch_id={bid}")
        got = seen.get
        tops = [x for x in (mark, got["top"]) if x is not None]
        spark.createDataFrame([(got["n"] - got["late"], got["late"], max(tops) if tops else None)],
                              "accepted long, late long, mark timestamp") \
            .coalesce(1).write.mode("overwrite").parquet(f"{base}/counts/batch_id={bid}")

    start(lambda: stream.writeStream.foreachBatch(_process).option("checkpointLocation", checkpoint)
          .trigger(**(trigger or {"availableNow": True})).start(), spark, _goes_on(trigger))
    if not path_exists(spark, f"{base}/counts"):
        empty = spark.createDataFrame([], stream.schema)
        return empty, empty, spark.createDataFrame([], "batch_id long, accepted long, late long")
    schema = stream.schema.add("batch_id", "long").add("is_late", "boolean")
    rows = spark.read.schema(schema).parquet(f"{base}/rows")
    counts = spark.read.parquet(f"{base}/counts").select(F.col("batch_id").cast("long"), "accepted", "late")
    cols = stream.columns
    return rows.where("not is_late").select(*cols), rows.where("is_late").select(*cols), counts


def leaderboard(counts: DataFrame, order: Sequence[Column], n: int, base: str, checkpoint: str,
                trigger: dict | None = None) -> DataFrame:
    """The ``n`` first rows of a running aggregate by ``order`` (complete
    mode).  Each batch's board is cut by a top-k before it is written, so what
    leaves the state is ``n`` rows a task at most; a replayed batch replaces its
    board.  Returns the last board."""
    spark = counts.sparkSession

    def _write(batch: DataFrame, bid: int) -> None:
        batch.orderBy(*order).limit(n).write.mode("overwrite").parquet(f"{base}/batch_id={bid}")

    start(lambda: counts.writeStream.outputMode("complete").foreachBatch(_write).option("checkpointLocation", checkpoint)
          .trigger(**(trigger or {"availableNow": True})).start(), spark, _goes_on(trigger))
    if not path_exists(spark, base):
        return spark.createDataFrame([], counts.schema)
    boards = spark.read.parquet(base)
    last = boards.agg(F.max("batch_id")).first()[0]
    return spark.read.schema(counts.schema).parquet(f"{base}/batch_id={last}")


def versioned_join(stream: DataFrame, dimension: str, on: str, dim_on: str, base: str, checkpoint: str,
                   trigger: dict | None = None) -> DataFrame:
    """LEFT JOIN of a stream with a dimension that changes: each micro-batch
    joins the snapshot that was the newest when it was first run.  The choice is
    written to ``base/versions`` before the batch's output, so a replayed batch
    sees the same version whatever was committed since.  ``dimension`` is the
    folder of a snapshot table (``sinks.files.write_snapshot``); ``on`` and
    ``dim_on`` are the keys' names."""
    spark = stream.sparkSession

    def _process(batch: DataFrame, bid: int) -> None:
        out = joined_at(batch, pinned_version(spark, dimension, base, bid), on, dim_on)
        out.write.mode("overwrite").parquet(f"{base}/rows/batch_id={bid}")

    start(lambda: stream.writeStream.foreachBatch(_process).option("checkpointLocation", checkpoint)
          .trigger(**(trigger or {"availableNow": True})).start(), spark, _goes_on(trigger))
    if not path_exists(spark, f"{base}/rows"):
        return joined_at(spark.createDataFrame([], stream.schema), latest_version(spark, dimension), on, dim_on)
    return spark.read.parquet(f"{base}/rows").drop("batch_id")


def joined_at(rows: DataFrame, version: str, on: str, dim_on: str) -> DataFrame:
    """Rows LEFT JOIN one snapshot of a dimension, without the key's copy."""
    dim = rows.sparkSession.read.parquet(version)
    return rows.join(dim, rows[on] == dim[dim_on], "left").drop(dim[dim_on])


def pinned_version(spark: SparkSession, dimension: str, base: str, batch_id: int) -> str:
    """The snapshot a batch was first run with; the newest, if it is new."""
    path = f"{base}/versions/batch_id={batch_id}"
    if path_exists(spark, f"{path}/_SUCCESS"):
        return spark.read.schema("version string").parquet(path).first()["version"]
    version = latest_version(spark, dimension)
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").parquet(path)
    return version


def read_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator_id: int = 0) -> DataFrame:
    """Keys and values (structs ``key``, ``value``) that a stateful query holds,
    read from its checkpoint while it runs or after, as of its last committed
    batch or of ``batch_id``."""
    r = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    return r.load(checkpoint)


def stamp_processing_time(df: DataFrame, col: str = "ingest_ts") -> DataFrame:
    """Processing-time windows: stamp each row once at the source with the
    micro-batch's time, then window on that column like event time.  Such
    results depend on arrival timing and are not replayable; batch runs pass
    an ingest-time column instead."""
    return df.withColumn(col, F.current_timestamp())


def fan_out(*writers):
    """A ``foreachBatch`` function sending each micro-batch to several
    outputs (e.g. a file and the console).  The batch is persisted once so
    the outputs do not recompute it, and released afterwards."""
    def _write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for w in writers:
                w(batch, batch_id)
        finally:
            batch.unpersist()
    return _write
