from tagstream.session import materialize, recommended_conf, scratch_path, shared_dir
from tagstream.sources.tables import spread


def test_recommended_conf_sizes():
    big = recommended_conf(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    small = recommended_conf(10 * 2**30, 64)
    assert small["spark.sql.shuffle.partitions"] == str(64 * 3)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_shared_dir_and_materialize(spark):
    base = shared_dir(spark)
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(base) and p1 != p2
    df = spark.range(10).withColumnRenamed("id", "a")
    m = materialize(df, "t")
    assert sorted(r.a for r in m.collect()) == list(range(10))


def test_spread_only_when_too_few_partitions(spark):
    one = spark.range(100).coalesce(1)
    spread_one = spread(one)
    assert spread_one.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert spread(many) is many
    assert sorted(r.id for r in spread_one.collect()) == list(range(100))
