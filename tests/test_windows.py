import functools

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagstream.operators import windows as W

FRUIT = [("apple", 1, 1), ("banana", 1, 2), ("apple", 1, 3), ("apple", 1, 5),
         ("banana", 1, 7), ("orange", 1, 8), ("apple", 1, 9), ("banana", 1, 9)]


def _fruit(spark, unit):
    df = spark.createDataFrame(FRUIT, "key string, n int, t long")
    df = W.event_time(df, "t", unit)
    out = W.tumbling(df, ["key"], "ts", "3 seconds", [F.sum("n").alias("s"), F.max("t").alias("max_t")])
    return sorted((r.key, r.window_start.second, r.s, r.max_t) for r in out.collect())


def test_fruit_ms_collapses_into_one_window(spark):
    # T read as milliseconds -> every row in the first 3-second window
    assert _fruit(spark, "ms") == [("apple", 0, 4, 9), ("banana", 0, 3, 9), ("orange", 0, 1, 8)]


def test_fruit_seconds(spark):
    # T in seconds
    assert _fruit(spark, "s") == sorted([
        ("apple", 0, 1, 1), ("banana", 0, 1, 2), ("apple", 3, 2, 5), ("banana", 6, 1, 7),
        ("orange", 6, 1, 8), ("apple", 9, 1, 9), ("banana", 9, 1, 9)])


def _fold(values):
    return functools.reduce(lambda a, b: (a + b) / 2, values)


def _pairwise(spark, rows):
    df = spark.createDataFrame(rows, "sensor string, t long, seq long, value double, unit string")
    df = W.event_time(df, "t", "ms")
    out = W.pairwise_avg(df, ["sensor"], "ts", "seq", "value", "5 seconds", "1 second", unit="unit")
    return {r.sensor: r for r in out.collect()}


def test_pairwise_average_is_the_ordered_fold(spark):
    # 10, 20, 40 -> 27.5 (mean would be 23.33)
    rows = [("s", 1000, 1, 10.0, "u1"), ("s", 2500, 2, 20.0, "u2"), ("s", 4000, 3, 40.0, "u3"),
            ("one", 1000, 4, 7.25, "x")]
    got = _pairwise(spark, rows)
    assert got["s"].pairwise_avg == 27.5 and got["s"].cnt == 3 and got["s"].first_unit == "u1"
    assert got["one"].pairwise_avg == 7.25


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4999), st.integers(0, 10_000)), min_size=1, max_size=40))
def test_pairwise_closed_form_matches_fold_property(spark, pts):
    rows = [("k", t, i, v / 100.0, "u") for i, (t, v) in enumerate(pts)]
    got = _pairwise(spark, rows)["k"].pairwise_avg
    ordered = [v for _k, _t, _i, v, _u in sorted(rows, key=lambda r: (r[1], r[2]))]
    assert abs(got - _fold(ordered)) <= 1e-9 * max(1.0, abs(_fold(ordered)))


def test_first_over_count(spark):
    # Values 12, 30, 48 in one window -> 12 / 3 = 4.0
    df = spark.createDataFrame([("line_1", 100, 1, 12.0), ("line_1", 200, 2, 30.0), ("line_1", 300, 3, 48.0)],
                               "area string, t long, seq long, value double")
    df = W.event_time(df, "t", "ms")
    r = W.first_over_count(df, ["area"], "ts", "seq", "value", "3 seconds").collect()[0]
    assert r.first_over_count == 4.0 and r.cnt == 3


def test_gapped_hopping(spark):
    # Size 2 s, slide 5 s
    ts = [0, 1999, 2000, 4900, 5000, 6500]
    df = W.event_time(spark.createDataFrame([("w", t) for t in ts], "word string, t long"), "t", "ms")
    out = W.hopping_gapped(df, ["word"], "ts", "2 seconds", "5 seconds", [F.count(F.lit(1)).alias("n")])
    got = sorted((r.window_start.second, r.n, (r.window_end - r.window_start).seconds) for r in out.collect())
    assert got == [(0, 2, 2), (5, 2, 2)]


def test_sliding(spark):
    # One row at 100 ms, 100 ms windows every 20 ms -> 5 windows
    df = W.event_time(spark.createDataFrame([("w", 100)], "word string, t long"), "t", "ms")
    out = W.sliding(df, ["word"], "ts", "100 milliseconds", "20 milliseconds", [F.count(F.lit(1)).alias("n")])
    starts = sorted(r.window_start.microsecond // 1000 for r in out.collect())
    assert starts == [20, 40, 60, 80, 100]


def test_sliding_counts_equal_rows_times_size_over_slide(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = W.sliding(df, ["event_type"], "ts", "10 minutes", "2 minutes", [F.count(F.lit(1)).alias("n")])
    assert out.agg(F.sum("n")).collect()[0][0] == df.count() * 5


def test_gapped_is_subset_of_tumbling_by_slide(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    g = W.hopping_gapped(df, ["event_type"], "ts", "2 minutes", "5 minutes", [F.count(F.lit(1)).alias("n")])
    t = W.tumbling(df, ["event_type"], "ts", "5 minutes", [F.count(F.lit(1)).alias("m")])
    j = g.join(t, ["event_type", "window_start"])
    assert j.count() == g.count() and j.where("n > m").count() == 0


def test_sliding_count_by_panes_equals_sliding(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for size, slide in (("10 minutes", "2 minutes"), ("10 minutes", "4 minutes")):
        got = W.sliding_count(e, ["event_type"], "ts", size, slide)
        want = W.sliding(e, ["event_type"], "ts", size, slide, [F.count(F.lit(1)).alias("cnt")])
        assert sorted(got.collect()) == sorted(want.collect())


def test_sliding_count_dealt_once_equals_sliding(spark):
    """Blocks of panes: rows at their edges, before 1970, without a time or key,
    hot and repeated; windows of one pane, of a few and of more than a block."""
    times = [0, 1, 299, 300, 301, 3599, 3600, 3601, 7200, -1, -300, -3600, 86_400 * 365, None]
    rows = [(w, t) for t in times for w in ("a", "b", None, "a")] + [("hot", 3_500 + k) for k in range(300)]
    df = spark.createDataFrame(rows, "word string, t long")
    df = df.select("word", F.expr("timestamp_ntz '1970-01-01' + t * interval 1 second").alias("ts"))
    for size, slide in (("10 minutes", "5 minutes"), ("5 minutes", "5 minutes"), ("2 hours", "5 minutes")):
        want = W.sliding(df, ["word"], "ts", size, slide, [F.count(F.lit(1)).alias("cnt")])
        got = W.sliding_count(df, ["word"], "ts", size, slide, tasks=3)
        assert got.schema == want.schema or got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_words_are_dealt_in_tasks_of_bounded_text(spark, tmp_dir):
    """A table that is read by one task, and six times as much of it: tasks
    grow with the text, and words are counted in as many (the old plan had as
    many tasks as the scan, or cores, whatever they held)."""
    from tagstream.plans.gallery import GALLERY
    from tagstream.sources.tables import TASK_TEXT
    text = " ".join(f"word{k}" for k in range(60_000))  # 0.6 MB
    found = {}
    for n in (20, 120):
        spark.range(n).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).coalesce(1).write.parquet(
            f"{tmp_dir}/{n}/documents.parquet")
        found[n] = GALLERY["ingest_word_sliding"](spark, f"{tmp_dir}/{n}").rdd.getNumPartitions()
    assert found[20] <= 4 and found[120] == -(-120 * len(text) // TASK_TEXT) > 8
