import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tagstream.operators import tables as TB
from tagstream.schemas import TABLES

STAMP = dt.datetime(2024, 1, 1, 12, 0, 0)


def _readings(spark, rows):
    return spark.createDataFrame(rows, "sensor string, unit string, value double, record_time timestamp_ntz, seq long")


def test_upsert_last_per_key_and_idempotent(spark):
    # One stamped batch collapses to the last row per sensor
    batch = _readings(spark, [("flowmeter_1", "m3/s", 1.0, None, 1), ("flowmeter_2", "m3/s", 2.0, None, 2),
                              ("flowmeter_1", "m3/s", 3.0, None, 3)])
    batch = TB.stamp_batch(batch, "record_time", F.lit(STAMP).cast("timestamp_ntz"))
    target = spark.createDataFrame([], "sensor string, unit string, value double, record_time timestamp_ntz")
    once = TB.upsert(target, batch, ["sensor", "record_time"], "seq")
    got = sorted((r.sensor, r.value) for r in once.collect())
    assert got == [("flowmeter_1", 3.0), ("flowmeter_2", 2.0)]
    twice = TB.upsert(once, batch, ["sensor", "record_time"], "seq")
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_insert_if_absent(spark):
    # G17
    target = spark.createDataFrame([("LBA3", "London", 7)], "location_code string, site_name string, address_number int")
    batch = spark.createDataFrame([("LBA3", "London", 9, 1), ("HBB1", "Manchester", 3, 2), ("HBB1", "Manchester", 4, 3)],
                                  "location_code string, site_name string, address_number int, seq long")
    out = TB.insert_if_absent(target, batch, ["location_code"], "seq")
    assert sorted((r.location_code, r.address_number) for r in out.collect()) == [("HBB1", 3), ("LBA3", 7)]


def test_decimal_fit(spark):
    # 56.875 -> 56.88; 999.995 -> reject
    df = spark.createDataFrame([(56.875,), (999.995,), (12.0,)], "v double")
    got = [r.d for r in df.select(TB.decimal_fit("v").alias("d")).collect()]
    assert got == [Decimal("56.88"), None, Decimal("12.00")]


def test_pk_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2)], "s string, t int")
    got = {(r.s, r.t, r.n, r.has_null) for r in TB.pk_violations(df, ["s", "t"]).collect()}
    assert got == {(None, 2, 1, True), ("a", 1, 2, False)}


def test_conform_readings(spark):
    df = spark.createDataFrame([("s" * 60, "C", 1.0, STAMP), ("ok", "C", 1234.5, STAMP), ("ok", "C", 1.25, None)],
                               "sensor string, unit string, value double, record_time timestamp_ntz")
    got = [r._valid for r in TB.conform(df, TABLES["readings"]).collect()]
    assert got == [False, False, False]
    good = spark.createDataFrame([("ok", "C", 1.25, STAMP)], df.schema)
    assert TB.conform(good, TABLES["readings"]).collect()[0]._valid


def test_length_ok(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",), (None,)], "s string")
    assert [r.ok for r in df.select(TB.length_ok("s", 3).alias("ok")).collect()] == [True, False, True]


def test_upsert_into_rewrites_only_touched_partitions(spark, tmp_dir):
    import os
    path = f"{tmp_dir}/tbl"
    target = spark.createDataFrame([("s1", 1, "d1", 1.0), ("s2", 1, "d1", 2.0), ("s1", 2, "d2", 3.0)],
                                   "sensor string, hour int, day string, value double")
    target.write.partitionBy("day").parquet(path)
    d1_before = sorted(os.listdir(f"{path}/day=d1"))
    batch = spark.createDataFrame([("s1", 2, "d2", 30.0, 1), ("s1", 2, "d2", 31.0, 2), ("s3", 2, "d2", 5.0, 3)],
                                  "sensor string, hour int, day string, value double, seq long")
    TB.upsert_into(path, batch, ["sensor", "hour", "day"], "seq", "day")
    got = sorted((r.sensor, r.hour, r.day, r.value) for r in spark.read.parquet(path).collect())
    assert got == [("s1", 1, "d1", 1.0), ("s1", 2, "d2", 31.0), ("s2", 1, "d1", 2.0), ("s3", 2, "d2", 5.0)]
    assert sorted(os.listdir(f"{path}/day=d1")) == d1_before


def test_upsert_keeps_rows_without_a_key(spark):
    schema = "k string, v int"
    target = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4)], schema)
    batch = spark.createDataFrame([("a", 5, 1), (None, 6, 2), ("c", 7, 3), ("c", 8, 4)], schema + ", seq long")
    out = TB.upsert(target, batch, ["k"], "seq")
    assert out.columns == ["k", "v"]
    assert sorted((r.k or "", r.v) for r in out.collect()) == [("", 2), ("", 3), ("", 6), ("a", 5), ("b", 4), ("c", 8)]


def test_upsert_of_empty_inputs(spark):
    schema = "k string, v int"
    rows, none = spark.createDataFrame([("a", 1)], schema), spark.createDataFrame([], schema)
    empty_batch = spark.createDataFrame([], schema + ", seq long")
    assert [tuple(r) for r in TB.upsert(rows, empty_batch, ["k"], "seq").collect()] == [("a", 1)]
    assert TB.upsert(none, empty_batch, ["k"], "seq").collect() == []
