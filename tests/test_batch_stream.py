"""Batch/stream equivalence: one operator function over ``read`` and over
``readStream ... availableNow`` gives the same rows."""

import pytest
from pyspark.sql import functions as F

from tagstream.operators import parse as P
from tagstream.operators import text as TX
from tagstream.operators import windows as W
from tagstream.plans import inputs as I
from tagstream.sources.tables import read_table, stream_table
from tagstream.streaming import runner as RN

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


STATELESS = {
    "parse_json": lambda e: P.accepted(P.parse_json_readings(I.json_messages_from(e)))
    .select("seq", "sensor", "area", "value_num", "ts_ms"),
    "parse_json_rejects": lambda e: P.rejected(P.parse_json_readings(I.json_messages_from(e)), keep=("seq",)),
    "classify": lambda e: e.select("event_id", TX.classify("event_type", [("click", "NAV")]).alias("c")),
}


@pytest.mark.parametrize("name", sorted(STATELESS))
def test_stateless_operators(spark, tmp_dir, name):
    fn = STATELESS[name]
    batch = fn(read_table(spark, SF, "events"))
    stream = RN.run_to_files(fn(stream_table(spark, SF, "events")), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert _rows(stream.select(*batch.columns)) == _rows(batch)


def _agg(e, windows):
    e = e.withColumn("ets", RN.ntz_to_instant("ts"))
    if e.isStreaming:
        e = e.withWatermark("ets", "0 seconds")
    return windows(e)


WINDOWED = {
    "tumbling": lambda e: W.tumbling(e, ["event_type"], "ets", "1 hour",
                                     [F.count(F.lit(1)).alias("n"), F.max("value").alias("mx")]),
    "sliding": lambda e: W.sliding(e, ["event_type"], "ets", "10 minutes", "2 minutes",
                                   [F.count(F.lit(1)).alias("n")]),
    "first_over_count": lambda e: W.first_over_count(e, ["event_type"], "ets", "event_id", "value", "1 day"),
}


@pytest.mark.parametrize("name", sorted(WINDOWED))
def test_windowed_operators(spark, tmp_dir, name):
    fn = WINDOWED[name]
    batch = _agg(read_table(spark, SF, "events"), fn)
    keys = ["event_type", "window_start"]
    stream = RN.run_updates(_agg(stream_table(spark, SF, "events"), fn), keys, f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert _rows(stream.select(*batch.columns)) == _rows(batch)
