"""Scalar helpers that the gallery does not show one by one."""

import time

from pyspark.sql import functions as F

from tagstream import functions as S
from tagstream.operators.aggregate import ratio


def test_conversions_never_raise(spark):
    df = spark.createDataFrame([("12", " 7 x"), ("1.5", "3"), (None, "1e400")], "a string, b string")
    got = df.select(S.safe_long("a").alias("l"), S.safe_double("a").alias("d"), S.safe_long("b").alias("m")).collect()
    assert [tuple(r) for r in got] == [(12, 12.0, None), (None, 1.5, 3), (None, None, None)]


def test_clock_text_and_tokens(spark):
    before = int(time.time() * 1000) - 60_000
    r = spark.range(1).select(S.now_ms().alias("t"), S.fmt_decimals(F.lit(2.345), 1).alias("f"),
                              S.whitespace_tokens(F.lit(" a  b\tc ")).alias("w")).first()
    assert r["t"] > before and r["f"] == "2.3" and r["w"] == ["a", "b", "c"]


def test_ratio(spark):
    df = spark.createDataFrame([(1.0, 2), (3.0, 4)], "x double, y int")
    assert df.agg(ratio(F.sum("x"), F.sum("y")).alias("r")).first()["r"] == 4 / 6
