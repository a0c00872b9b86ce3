"""Results stay exact when one key holds most of the rows (events with two
thirds of the rows relabelled to one hot key)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tagstream.operators import joins as J
from tagstream.operators import running as R
from tagstream.operators import tables as TB
from tagstream.operators import windows as W

SF = "/root/testdata/sf0.01"


def _skewed(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    hot = F.when(F.col("event_id") % 3 != 0, F.lit("hot")).otherwise(F.col("event_type"))
    return e.select("event_id", "ts", hot.alias("k"), F.col("value").cast("decimal(18,2)").alias("v"))


def test_running_sum_hot_key(spark):
    e = _skewed(spark)
    got = R.running_sum(e, ["k"], "v", ["event_id"], R.seq_bucket("event_id", 256))
    w = Window.partitionBy("k").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    ref = e.select("event_id", F.sum("v").over(w).alias("running_total"))
    assert got.select("event_id", "running_total").exceptAll(ref).count() == 0
    assert got.count() == e.count()


def test_pairwise_rank_hot_key(spark):
    e = _skewed(spark).withColumn("value", F.col("v").cast("double"))
    got = W.pairwise_avg(e, ["k"], "ts", "event_id", "value", "1 day", "1 minute")
    w = Window.partitionBy("k", F.window("ts", "1 day")).orderBy("ts", "event_id")
    n = Window.partitionBy("k", F.window("ts", "1 day"))
    ref = (e.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(n))
           .withColumn("wv", F.col("value") * F.pow(F.lit(2.0), F.when(F.col("rn") == 1, 1 - F.col("n"))
                                                     .otherwise(F.col("rn") - F.col("n") - 1)))
           .groupBy("k", F.window("ts", "1 day").start.alias("window_start")).agg(F.sum("wv").alias("ref")))
    j = got.join(ref, ["k", "window_start"])
    assert j.count() == got.count() == ref.count()
    assert j.where(F.abs(F.col("pairwise_avg") - F.col("ref")) > 1e-9).count() == 0


def test_left_join_hot_right_key(spark):
    e = _skewed(spark)
    keys = e.select("k").distinct().union(spark.createDataFrame([("cold",)], "k string"))
    safe = J.left_join(keys, e.withColumnRenamed("k", "rk"), "k", "rk", hot_right_keys=True)
    plain = keys.join(e.withColumnRenamed("k", "rk"), F.col("k") == F.col("rk"), "left")
    assert safe.select("k", "event_id").exceptAll(plain.select("k", "event_id")).count() == 0
    assert safe.count() == plain.count() == e.count() + 1


def test_upsert_and_first_with_hot_key(spark):
    e = _skewed(spark)
    target = TB.first_per_key(e.where("event_id < 5000"), ["k"], "event_id")
    out = TB.upsert(target, e.where("event_id >= 4000"), ["k"], "event_id")
    last = e.groupBy("k").agg(F.max_by("event_id", "event_id").alias("event_id"))
    assert sorted(tuple(r) for r in out.select("k", "event_id").collect()) == \
        sorted(tuple(r) for r in last.collect())
    foc = W.first_over_count(e.withColumn("value", F.col("v").cast("double")), ["k"], "ts", "event_id", "value", "30 days")
    assert foc.agg(F.sum("cnt")).collect()[0][0] == e.count()
