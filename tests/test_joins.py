import contextlib
import datetime as dt
import io
import random

from pyspark.sql import functions as F

from tagstream.operators import joins as J


def _inputs(spark, n_readings=40, seed=3):
    random.seed(seed)
    base = dt.datetime(2024, 1, 1)
    readings = spark.createDataFrame(
        [(f"s{i % 9}", random.random(), "u", base + dt.timedelta(minutes=random.randint(0, 30)), i)
         for i in range(n_readings)], "sensor string, value double, unit string, record_time timestamp_ntz, rid long")
    oee = spark.createDataFrame(
        [(f"s{i % 7}", float(i), f"L{i % 4}", i) for i in range(30)],
        "sensor_id string, up_time double, location string, oid long")
    locations = spark.createDataFrame([("L0", "London", 7), ("L1", "Manchester", 3), ("L2", "York", 1)],
                                      "location_code string, site_name string, address_number int")
    return readings, oee, locations


def _naive(readings, oee, locations, n):
    j = readings.join(oee, readings.sensor == oee.sensor_id, "left")
    j = j.join(locations, j.location == locations.location_code, "left")
    return j.orderBy(F.col("record_time").desc(), F.col("rid").desc(), F.col("oid").asc_nulls_first()).limit(n)


def test_report_fanout_and_unmatched(spark):
    # A reading with two oee rows gives two rows; no oee -> null location/site
    readings, oee, locations = _inputs(spark)
    for n in (1, 6, 25):
        got = J.latest_report(readings, oee, locations, "sensor", "sensor_id", "location", "location_code",
                              [F.col("record_time").desc(), F.col("rid").desc()], [F.col("oid").asc_nulls_first()], n)
        cols = ["rid", "oid", "site_name", "address_number"]
        assert [tuple(r) for r in got.select(*cols).collect()] == \
               [tuple(r) for r in _naive(readings, oee, locations, n).select(*cols).collect()]
    all_rows = J.latest_report(readings, oee, locations, "sensor", "sensor_id", "location", "location_code",
                               [F.col("record_time").desc(), F.col("rid").desc()], [F.col("oid").asc_nulls_first()], 1000)
    assert all_rows.where(F.col("sensor_id").isNull()).count() > 0
    assert all_rows.groupBy("rid").count().where("count > 1").count() > 0


def test_left_join_bounded_broadcast(spark):
    readings, oee, locations = _inputs(spark)
    j = J.left_join(oee, locations, "location", "location_code", broadcast_max_rows=10)
    assert j.count() == oee.count()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        j.explain()
    assert "Broadcast" in buf.getvalue()
    assert J.fits(locations, 3) and not J.fits(locations, 2)


def test_left_join_hot_right_keys_same_rows(spark):
    left = spark.createDataFrame([(k,) for k in ["a", "b", "c", None]], "k string")
    right = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), (None, 2)], "rk string, v int")
    plain = J.left_join(left, right, "k", "rk")
    safe = J.left_join(left, right, "k", "rk", hot_right_keys=True)
    key = lambda r: (str(r.k), str(r.v))
    assert sorted(map(key, safe.select("k", "v").collect())) == sorted(map(key, plain.select("k", "v").collect()))
