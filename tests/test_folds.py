"""Ordered folds, batch and streamed, and processing-time windows."""

import functools
import json
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagstream.operators import folds as FO
from tagstream.streaming import stateful as ST

SCHEMA = "s string, ts timestamp, seq long, v double, g double, u string"


def _rows(seed, n):
    rng = np.random.default_rng(seed)
    return [("ab"[int(rng.integers(0, 2))], 1_700_000_000 + int(rng.integers(0, 40)), k,
             None if rng.random() < 0.2 else round(float(rng.normal(10, 5)), 2), float(rng.uniform(0.1, 1)), f"u{k}")
            for k in range(n)]


def _frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA.replace("ts timestamp", "t long"))
    return df.select("s", F.timestamp_seconds("t").alias("ts"), "seq", "v", "g", "u")


def _folds(rows, step, window=20):
    """{(key, window): (fold, cnt, first unit)} one row after the other."""
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        key = (r[0], r[1] // window * window)
        acc = out.setdefault(key, [None, 0, None])
        if r[3] is None:
            continue
        a, b = step(r)
        if acc[1] == 0:
            acc[0], acc[2] = r[3], r[5]
        acc[0], acc[1] = a * acc[0] + b, acc[1] + 1
    return out


STEPS = {
    "halving": (lambda r: (0.5, r[3] / 2), lambda: FO.halving("v")),
    "exponential": (lambda r: (0.8, 0.2 * r[3]), lambda: FO.exponential("v", 0.2)),
    "a coefficient per reading": (lambda r: (r[4], (1 - r[4]) * r[3]), lambda: (F.col("g"), (1 - F.col("g")) * F.col("v"))),
}


def _same(got, want):
    assert set(got) == set(want)
    for k, (fold, cnt, unit) in want.items():
        assert got[k][1:] == (cnt, unit)
        assert (got[k][0] is None) == (fold is None)
        assert fold is None or abs(got[k][0] - fold) < 1e-9


@pytest.mark.parametrize("name", sorted(STEPS))
def test_affine_fold_equals_one_row_after_the_other(spark, name):
    rows = _rows(1, 400) + [("nulls", 1_700_000_000, 1000, None, 0.5, "u")]
    step, columns = STEPS[name]
    df = _frame(spark, rows).withColumn("w", F.window("ts", "20 seconds").start)
    df = df.withColumn("b", F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 3) * 3))
    got = FO.affine_fold(df, ["s", "w"], ["ts", "seq"], "v", columns(), F.col("b"), first=["u"])
    got = {(r["s"], int(r["w"].timestamp())): (r["fold"], r["cnt"], r["first_u"]) for r in got.collect()}
    _same(got, _folds(rows, step))


@pytest.mark.parametrize("name", ["halving", "a coefficient per reading"])
def test_streamed_fold_continues_over_batches(spark, tmp_dir, name):
    rows = sorted(_rows(2, 120), key=lambda r: (r[1], r[2]))
    os.makedirs(f"{tmp_dir}/in")
    for k in range(4):
        with open(f"{tmp_dir}/in/{k}.json", "w") as f:
            for r in rows[k * 30:k * 30 + 30]:
                f.write(json.dumps({"s": r[0], "ts": r[1], "seq": r[2], "v": r[3], "g": r[4], "u": r[5]}) + "\n")
        os.utime(f"{tmp_dir}/in/{k}.json", (time.time() + k, time.time() + k))
    s = spark.readStream.schema("s string, ts long, seq long, v double, g double, u string") \
        .option("maxFilesPerTrigger", 1).json(f"{tmp_dir}/in").withColumn("ts", F.timestamp_seconds("ts"))
    step, columns = STEPS[name]
    out = ST.affine_fold_stream(s, ["s"], "ts", "seq", "v", columns(), "20 seconds", "3 seconds", f"{tmp_dir}/b",
                                f"{tmp_dir}/c", ["u"])
    got = {(r["s"], int(r["window_start"].timestamp())): (r["fold"], r["cnt"], r["first_u"]) for r in out.collect()}
    _same(got, _folds(rows, step))


def test_a_hot_key_is_dealt_over_state_partitions(spark, tmp_dir):
    rows = [("hot" if k % 3 else f"k{k % 7}", k, float(k)) for k in range(6000)]
    spark.createDataFrame(rows, "k string, seq long, v double").write.parquet(f"{tmp_dir}/in")
    s = spark.readStream.schema("k string, seq long, v double").parquet(f"{tmp_dir}/in")
    out = ST.running_sum_batches(s, "k", "seq", "v", f"{tmp_dir}/b", f"{tmp_dir}/c", width=50)
    sums, want = {}, {}
    for k, seq, v in rows:
        want[seq] = sums[k] = sums.get(k, 0.0) + v
    assert {r["seq"]: r["running_total"] for r in out.collect()} == want
    # rows of the stream's output files: one file per state partition
    sizes = [r["n"] for r in spark.read.parquet(f"{tmp_dir}/b/out").groupBy(F.input_file_name().alias("f"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 2 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_an_idle_source_closes_its_arrival_window(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")

    def write(name, rows):
        with open(f"{tmp_dir}/.{name}", "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.rename(f"{tmp_dir}/.{name}", f"{tmp_dir}/in/{name}")

    write("1.json", [{"k": "a", "t": 5, "seq": 1, "v": 2.0, "m": "second"}, {"k": "a", "t": 3, "seq": 0, "v": 1.0, "m": "first"},
                     {"k": "b", "t": 9, "seq": 2, "v": None, "m": "only"}])
    s = spark.readStream.schema("k string, t long, seq long, v double, m string").json(f"{tmp_dir}/in")
    w = ST.arrival_windows(s, "k", "t", "seq", "v", "m", size_ms=2000)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    with ST.rocksdb_state(spark):
        q = (w.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
             .outputMode("append").start())
    spark.conf.set("spark.sql.shuffle.partitions", old)
    try:
        until, got = time.time() + 90, []
        while time.time() < until and len(got) < 2:  # no further row ever comes
            time.sleep(1)
            if os.path.exists(f"{tmp_dir}/out/_spark_metadata/0"):
                got = spark.read.schema(w.schema).parquet(f"{tmp_dir}/out").collect()
    finally:
        q.stop()
    assert sorted((r["k"], r["cnt"], r["total"], r["max_ts"], r["first_head"]) for r in got) == [
        ("a", 2, 3.0, 5, "first"), ("b", 1, 0.0, 9, "only")]
    assert all(r["window_ms"] % 2000 == 0 for r in got)


def test_rows_in_the_gap_belong_to_no_arrival_window():
    class Value:
        v = None
        def exists(self): return self.v is not None
        def get(self): return self.v
        def update(self, v): self.v = v
        def clear(self): self.v = None

    class Handle:
        timers = set()
        def getValueState(self, *_): return Value()
        def registerTimer(self, t): self.timers.add(t)
        def deleteTimer(self, t): self.timers.discard(t)

    class Clock:
        def __init__(self, now): self.now = now
        def getCurrentProcessingTimeInMs(self): return self.now

    import pandas as pd
    p, out = ST.ArrivalWindow("k", 2000, 5000), []
    p.init(Handle())
    for now in (100, 1999, 2000, 4999, 5000, 11_000):
        rows = pd.DataFrame({"tg_ts": [now], "tg_seq": [0], "tg_value": [1.0], "tg_head": ["h"]})
        out += [tuple(x.iloc[0])[1:3] for x in p.handleInputRows(("a",), iter([rows]), Clock(now))]
    assert out == [(0, 2), (5000, 1)] and p.state.get()[:2] == (10_000, 1)
    assert Handle.timers == {12_000}
