"""Recovery, late rows, live state, versioned dimensions, clustered and
bucketed tables."""

import glob
import os
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tagstream.operators import tables as TB
from tagstream.operators import telemetry as TM
from tagstream.sinks import files as FS
from tagstream.sources import growing as G
from tagstream.streaming import runner as RN

NOW = {"processingTime": "0 seconds"}


def _append(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "a") as f:
        f.writelines(x + "\n" for x in lines)


def _parsed(lines):
    p = F.split("value", ",")
    return lines.select(p[0].alias("k"), F.timestamp_seconds(p[1].cast("long")).alias("ts"), p[2].cast("long").alias("v"))


def test_late_rows_are_kept_and_counted_over_more_batches_than_reports(spark, tmp_dir):
    # one row a batch; every fifth row is 60 s behind the largest time seen
    n = 40
    times = [1000 + 10 * i - (70 if i % 5 == 4 and i > 10 else 0) for i in range(n)]
    _append(f"{tmp_dir}/in/a", [f"k,{t},{i}" for i, t in enumerate(times)])
    rows = _parsed(G.follow_lines(spark, f"{tmp_dir}/in", max_lines=1))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")  # reports that the engine keeps
    try:
        on_time, late, counts = RN.split_late(rows, "ts", "30 seconds", f"{tmp_dir}/b", f"{tmp_dir}/ck", trigger=NOW)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    want_late, top = [], None
    for i, t in enumerate(times):
        if top is not None and t < top - 30:
            want_late.append(i)
        top = max(t, top or t)
    assert sorted(r["v"] for r in late.collect()) == want_late and len(want_late) == 6
    assert sorted(r["v"] for r in on_time.collect()) == [i for i in range(n) if i not in want_late]
    got = counts.orderBy("batch_id").collect()
    assert [(r["accepted"], r["late"]) for r in got] == [(i not in want_late, i in want_late) for i in range(n)]


def test_no_rows_no_late_rows(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    rows = _parsed(G.follow_lines(spark, f"{tmp_dir}/in"))
    on_time, late, counts = RN.split_late(rows, "ts", "1 second", f"{tmp_dir}/b", f"{tmp_dir}/ck", trigger=NOW)
    assert on_time.count() == late.count() == 0
    assert all((r["accepted"], r["late"]) == (0, 0) for r in counts.collect())


def test_a_stop_after_every_batch_changes_nothing(spark, tmp_dir):
    _append(f"{tmp_dir}/in/a", [f"{'abc'[i % 3]},{1000 + i},{i}" for i in range(25)])
    agg = _parsed(G.follow_lines(spark, f"{tmp_dir}/in", max_lines=6)).groupBy("k").agg(
        F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
    starts = RN.run_with_restarts(lambda: RN.update_writer(agg, f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
                                  .trigger(processingTime="10 seconds").start(), spark)
    assert starts > 3  # five batches; a start may run two where one takes longer than the interval
    got = {r["k"]: (r["s"], r["n"]) for r in RN.last_updates(spark, f"{tmp_dir}/out", ["k"]).collect()}
    assert got == {"a": (sum(range(0, 25, 3)), 9), "b": (sum(range(1, 25, 3)), 8), "c": (sum(range(2, 25, 3)), 8)}


def test_snapshot_read_from_state_after_each_batch(spark, tmp_dir):
    seen = []
    for k in range(3):
        _append(f"{tmp_dir}/in/a", [f"d{(i + k) % 2}|s{i % 2},{100 * k + i},{10 * k + i}" for i in range(4)])
        seen += [(f"d{(i + k) % 2}", f"s{i % 2}", 100 * k + i, 10 * k + i) for i in range(4)]
        p = _parsed(G.follow_lines(spark, f"{tmp_dir}/in"))
        r = p.select(F.split("k", "\\|")[0].alias("device"), F.split("k", "\\|")[1].alias("sensor"), "ts",
                     F.col("v").cast("double").alias("value"), F.col("v").alias("seq"))
        g = r.groupBy("device", "sensor").agg(F.max_by("value", F.struct("ts", "seq")).alias("value"), F.max("ts").alias("t"))
        RN.run_updates(g, ["device", "sensor"], f"{tmp_dir}/out", f"{tmp_dir}/ck", NOW)
        state = TM.snapshot_of_state(RN.read_state(spark, f"{tmp_dir}/ck"))
        batch = spark.createDataFrame([(d, s, t, float(v), v) for d, s, t, v in seen],
                                      "device string, sensor string, ts long, value double, seq long")
        batch = TM.latest_snapshot(batch.withColumn("ts", F.timestamp_seconds("ts")), ["device", "sensor"], ["value"], ["ts", "seq"])
        key = lambda r: (r["device"], r["sensor"], r["value"])
        assert sorted(map(key, state.collect())) == sorted(map(key, batch.collect()))


def test_leaderboard_equals_the_batch_form(spark, tmp_dir):
    words = [w for k in range(40) for w in ["a"] * (k % 3) + ["b"] + [f"w{k % 7}"]]
    _append(f"{tmp_dir}/in/a", [f"{w},0,0" for w in words])
    counts = _parsed(G.follow_lines(spark, f"{tmp_dir}/in", max_lines=30)).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    top = RN.leaderboard(counts, [F.col("n").desc(), F.col("k")], 4, f"{tmp_dir}/out", f"{tmp_dir}/ck", NOW)
    want = sorted(Counter(words).items(), key=lambda x: (-x[1], x[0]))[:4]
    assert sorted(((r["k"], r["n"]) for r in top.collect()), key=lambda x: (-x[1], x[0])) == want


def test_a_replayed_batch_joins_the_version_it_saw_first(spark, tmp_dir):
    dim, base = f"{tmp_dir}/dim", f"{tmp_dir}/b"
    FS.write_snapshot(spark.createDataFrame([("a", "one")], "code string, site string"), dim)
    _append(f"{tmp_dir}/in/f", ["a,0,1"])

    def run():
        rows = _parsed(G.follow_lines(spark, f"{tmp_dir}/in"))
        out = RN.versioned_join(rows, dim, "k", "code", base, f"{tmp_dir}/ck", NOW)
        return sorted((r["v"], r["site"]) for r in out.collect())

    assert run() == [(1, "one")]
    FS.write_snapshot(spark.createDataFrame([("a", "two")], "code string, site string"), dim)
    _append(f"{tmp_dir}/in/f", ["a,0,2", "z,0,3"])
    assert run() == [(1, "one"), (2, "two"), (3, None)]
    # the first batch again, as after a failure before its commit
    assert RN.pinned_version(spark, dim, base, 0) != RN.pinned_version(spark, dim, base, 1) == FS.latest_version(spark, dim)
    again = RN.joined_at(spark.createDataFrame([("a", 1)], "k string, v long"), RN.pinned_version(spark, dim, base, 0), "k", "code")
    assert again.first()["site"] == "one"


def test_a_point_lookup_skips_row_groups(spark, tmp_dir):
    # tags are dealt over time, so only Bloom filters can tell the row groups
    n = 40_000
    df = spark.range(n).select(F.timestamp_seconds(F.col("id")).alias("ts"),
                               F.concat(F.lit("tag-"), F.md5(F.col("id").cast("string"))).alias("tag"), F.col("id").alias("v"))
    FS.write_clustered(df, f"{tmp_dir}/t", ["ts"], {"tag": 20_000}, group_bytes=64 << 10)
    groups = sum(pq.ParquetFile(f).metadata.num_row_groups for f in glob.glob(f"{tmp_dir}/t/*.parquet"))
    assert groups >= 8
    wanted = [r["tag"] for r in df.where(F.col("v").isin(5, 77, 31_000)).collect()]
    hit = FS.point_lookup(spark, f"{tmp_dir}/t", "tag", [*wanted, "absent", "absent"])
    assert sorted(r["v"] for r in hit.collect()) == [5, 77, 31_000]

    def scanned(frame):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan()
        while plan.nodeName() != "Scan parquet ":
            plan = plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan.children().head()
        return plan.metrics().apply("numOutputRows").value()

    assert scanned(FS.point_lookup(spark, f"{tmp_dir}/t", "tag", wanted[:1])) < n / 2
    assert scanned(FS.point_lookup(spark, f"{tmp_dir}/t", "tag", ["absent"])) < n / 2
    with pytest.raises(ValueError):
        FS.point_lookup(spark, f"{tmp_dir}/t", "tag", range(101))


def test_upsert_into_a_bucketed_table_shuffles_the_batch_only(spark, tmp_dir):
    cols = "k long, day int, v string"
    name = "tg_test_" + os.path.basename(tmp_dir).replace("-", "_")
    old = spark.createDataFrame([(k, k % 3, f"old{k}") for k in range(200)], cols)
    TB.write_bucketed(old, f"{name}_0", f"{tmp_dir}/0", ["k", "day"], 4)
    batch = spark.createDataFrame([(k, k % 3, f"new{k}-{j}", j) for k in range(150, 260) for j in (1, 0)]
                                  + [(None, 1, "no key", 5), (3, 0, None, 1)], cols + ", seq int")
    merged = TB.bucketed_merge(spark.table(f"{name}_0"), batch, ["k", "day"], "seq", 4)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    assert "Bucketed: true" in plan and "Exchange" not in join[:join.index(f"{name}_0")], plan
    got = {(r["k"], r["day"]): r["v"] for r in
           TB.upsert_bucketed(f"{name}_0", batch, ["k", "day"], "seq", f"{name}_1", f"{tmp_dir}/1", 4).collect()}
    want = {(k, k % 3): f"old{k}" for k in range(150)} | {(k, k % 3): f"new{k}-1" for k in range(150, 260)} | {(3, 0): None}
    assert got == want
    for k in (0, 1):
        spark.sql(f"DROP TABLE {name}_{k}")
