import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tagstream.operators import aggregate as A
from tagstream.operators import running as R
from tagstream.operators import topk as TK
from tagstream.sources.literal import literal_rows

TX = [{"user": "Alice", "amount": 100}, {"user": "Bob", "amount": 50}, {"user": "Alice", "amount": 200},
      {"user": "Charlie", "amount": 30}, {"user": "Bob", "amount": 150}, {"user": "Alice", "amount": 50}]


def _transactions(spark):
    df = literal_rows(spark, TX, "user string, amount int")
    return df.withColumn("seq", F.monotonically_increasing_id())


def test_transactions_running_and_final(spark):
    # G1: filter > 40, keyed running sum, Alice -> Rita
    df = _transactions(spark).where(F.col("amount") > 40)
    run = R.running_sum(df, ["user"], "amount", ["seq"], R.seq_bucket("seq", 2))
    run = run.withColumn("user", F.when(F.col("user") == "Alice", "Rita").otherwise(F.col("user")))
    got = [(r.user, r.running_total) for r in run.orderBy("seq").collect()]
    assert got == [("Rita", 100), ("Bob", 50), ("Rita", 300), ("Bob", 200), ("Rita", 350)]
    fin = A.keyed_sum(df, ["user"], "amount", out="total").collect()
    assert sorted((r.user, r.total) for r in fin) == [("Alice", 350), ("Bob", 200)]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=200),
       st.integers(1, 16))
def test_bucketed_prefix_equals_single_window(spark, rows, width):
    df = spark.createDataFrame([(k if k else None, i, v) for i, (k, v) in enumerate(rows)],
                               "k int, seq long, v long")
    got = R.bucketed_prefix(df, ["k"], ["seq"], R.seq_bucket("seq", width), {"s": F.col("v")}, total_col="n")
    w = Window.partitionBy("k").orderBy("seq")
    ref = df.select("seq", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                    F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"))
    expect = sorted(tuple(r) for r in ref.collect())
    assert sorted(tuple(r) for r in got.select("seq", "s", "rn", "n").collect()) == expect
    two_level = R.bucketed_prefix(df, ["k"], ["seq"], R.seq_bucket("seq", width), {"s": F.col("v")},
                                  total_col="n", coarse=lambda b: F.floor(b / 3))
    assert sorted(tuple(r) for r in two_level.select("seq", "s", "rn", "n").collect()) == expect
    glob = R.bucketed_prefix(df, [], ["seq"], R.seq_bucket("seq", width), {"s": F.col("v")},
                             total_col="n", coarse=lambda b: F.floor(b / 3))
    wg = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    gref = df.select("seq", F.sum("v").over(wg).alias("s"), F.row_number().over(Window.orderBy("seq")).alias("rn"))
    assert sorted(tuple(r) for r in glob.select("seq", "s", "rn").collect()) == sorted(tuple(r) for r in gref.collect())
    assert {r.n for r in glob.collect()} == {len(rows)}


def test_row_count(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert A.row_count(df).collect()[0].n_rows == df.count()


def test_top_n_per_key_with_hot_key(spark):
    random.seed(7)
    rows = [("hot" if i % 3 else f"k{i % 7}", i, random.randint(0, 1000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, seq long, v long")
    order = [F.col("v").desc(), F.col("seq").asc()]
    got = TK.top_n_per_key(df, ["k"], order, 3, salts=8)
    w = Window.partitionBy("k").orderBy(*order)
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn <= 3").drop("rn")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in ref.collect())


def test_bucketed_prefix_keeps_null_order_rows(spark):
    df = spark.createDataFrame([("a", None, 5), ("a", 1, 1), ("a", 2, 2), (None, None, 7)], "k string, seq long, v long")
    got = R.bucketed_prefix(df, ["k"], ["seq"], R.seq_bucket("seq", 1), {"s": F.col("v")})
    w = Window.partitionBy("k").orderBy("seq")
    ref = df.select("k", "seq", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    key = lambda r: (str(r.k), str(r.seq), r.s)
    assert sorted(map(key, got.select("k", "seq", "s").collect())) == sorted(map(key, ref.collect()))
    assert got.count() == 4
