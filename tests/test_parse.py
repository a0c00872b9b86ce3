from pyspark.sql import functions as F

from tagstream.operators import parse as P


def _lines(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "value string")


def test_sensor_lines(spark):
    # G8
    good = "1000|ph_level|7.200|ph"
    bad = ["a|b|c", "x|ph|7|ph", "1|ph|abc|ph", "1|a|2|b|c", ""]
    parsed = P.parse_sensor_lines(_lines(spark, [good, *bad]))
    ok = P.accepted(parsed).collect()
    assert [(r.ts_ms, r.sensor, r.value_num, r.unit, r.n) for r in ok] == [(1000, "ph_level", 7.2, "ph", 1)]
    rej = P.rejected(parsed).collect()
    assert sorted(r.raw for r in rej) == sorted(bad)
    assert {r.raw: r.reason for r in rej}["1|ph|abc|ph"] == "bad_value"


def test_log_lines(spark):
    # Bad ts is a reject, not an exception
    xs = ["INFO | 1000 | Message no. 1", "WARN | 5", "ERROR | 1 | a | b", "INFO | x | m"]
    parsed = P.parse_log_lines(_lines(spark, xs))
    ok = P.accepted(parsed).collect()
    assert [(r.level, r.ts_ms, r.message, r.n) for r in ok] == [("INFO", 1000, "Message no. 1", 1)]
    assert P.rejected(parsed).count() == 3


def test_json_shapes(spark):
    # Two shapes -> one schema; malformed -> reject
    xs = ['{"sensor_id":"therm","area":"line_1","value":20.5,"timestamp":1000}',
          '{"timestamp":1000,"sensor":"THERM","value":20.5,"count":1}', "{bad"]
    parsed = P.parse_json_readings(_lines(spark, xs))
    ok = sorted(P.accepted(parsed).collect(), key=lambda r: r.sensor)
    assert [(r.sensor, r.area, r.value_num, r.ts_ms, r["count"]) for r in ok] == [
        ("THERM", None, 20.5, 1000, 1), ("therm", "line_1", 20.5, 1000, None)]
    assert [r.raw for r in P.rejected(parsed).collect()] == ["{bad"]


def test_accepts_plus_rejects_is_input(spark):
    from tagstream.plans import inputs as I
    lines = I.sensor_lines(spark, "/root/testdata/sf0.001")
    parsed = P.parse_sensor_lines(lines)
    assert P.accepted(parsed).count() + P.rejected(parsed).count() == lines.count()
    assert parsed.where(F.col("_ok").isNull()).count() == 0


def test_log_fields_strip_all_whitespace(spark):
    parsed = P.parse_log_lines(_lines(spark, ["\tWARN |\t42 | disk\tfull \r"]))
    r = P.accepted(parsed).collect()[0]
    assert (r.level, r.ts_ms, r.message) == ("WARN", 42, "disk\tfull")
