"""Streaming de-duplication with bounded state."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.operators.text import clean_lines


def distinct_lines_stream(df: DataFrame, text_col: str = "value", ts_col: str = "ingest_ts",
                          within: str | None = None) -> DataFrame:
    """Emit each stripped, non-blank line once: over the whole stream, or,
    with ``within``, once per that span of event time, after which a line's
    state is evicted.  The set of lines seen lies in the state store, sharded
    by line.
    """
    if within is None:
        return clean_lines(df, text_col).dropDuplicates([text_col])
    if ts_col not in df.columns:
        df = df.withColumn(ts_col, F.current_timestamp())
    lines = clean_lines(df, text_col)
    return lines.withWatermark(ts_col, within).dropDuplicatesWithinWatermark([text_col])


def _once_per_batch(df: DataFrame, col: str) -> DataFrame:
    """Drops repeats inside each Arrow batch of a task, so a line that makes
    up a third of the rows is sent to its state partition a few times."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pc.unique(batch.column(0))], names=[col])

    return df.select(col).mapInArrow(run, f"{col} string")


def distinct_lines_batches(stream: DataFrame, base: str, checkpoint: str, text_col: str = "value",
                           trigger: dict | None = None) -> DataFrame:
    """Each stripped, non-blank line once over the whole stream, exactly.

    The lines seen are the state of a streaming ``dropDuplicates`` in RocksDB:
    on the executors' disks, behind Bloom filters, dealt by line.  A batch looks
    up its own lines only, so its work grows with the batch, not with history;
    memory holds caches of fixed size.  Returns all emitted lines once the
    input is drained.
    """
    from tagstream.streaming.runner import run_to_files
    from tagstream.streaming.stateful import rocksdb_state

    lines = _once_per_batch(clean_lines(stream, text_col).select(F.col(text_col).alias("line")), "line")
    with rocksdb_state(stream.sparkSession):
        return run_to_files(lines.dropDuplicates(["line"]), f"{base}/out", checkpoint, trigger=trigger)
