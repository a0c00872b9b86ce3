"""Parsing with reject routing.

Each parser returns the input with the parsed fields plus ``_ok`` and
``_reason`` columns; ``accepted`` / ``rejected`` split that into the clean
stream and a side table with the raw text and why it failed.  Every input row
lands in exactly one of the two -- nothing raises, nothing is silently lost.
All of it is native expressions (``split``/``try_cast``/``from_json``), so
it fuses into the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.functions.scalars import trim_all
from tagstream.schemas import JSON_READING

OK, REASON = "_ok", "_reason"


def _stage(df: DataFrame, name: str, parsed: Column) -> DataFrame:
    """Attach the parsed struct through a generator.  A filter on parse
    results (``accepted``) cannot be pushed below a generator, so the parse
    runs once per row instead of being inlined into every predicate."""
    return df.select("*", F.inline(F.array(F.struct(parsed.alias(name)))))


def _finish(df: DataFrame, reason: Column, fields: list[Column]) -> DataFrame:
    return df.select("*", *fields, reason.alias(REASON)).withColumn(OK, F.col(REASON).isNull())


def parse_sensor_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """``ts_ms|sensor|value|unit``: exactly four fields, integer ts, numeric
    value.  Adds ``ts_ms, sensor, value_num, unit, n`` (n = 1)."""
    # Split and cast once into a struct; the checks and fields read from it.
    parts = F.split(F.col(col), r"\|", -1)
    staged = _stage(df, "_tg_p", F.struct(
        F.size(parts).alias("n"), F.get(parts, 0).try_cast("bigint").alias("ts"),
        F.get(parts, 1).alias("sensor"), F.get(parts, 2).try_cast("double").alias("val"),
        F.get(parts, 3).alias("unit")))
    p = F.col("_tg_p")
    reason = (F.when(F.col(col).isNull(), "null")
              .when(p["n"] != 4, "field_count")
              .when(p["ts"].isNull(), "bad_ts")
              .when(p["val"].isNull(), "bad_value"))
    fields = [p["ts"].alias("ts_ms"), p["sensor"].alias("sensor"), p["val"].alias("value_num"),
              p["unit"].alias("unit"), F.lit(1).alias("n")]
    return _finish(staged, reason, fields).drop("_tg_p")


def parse_log_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """``LEVEL | ts_ms | message``: split on ``|``, strip each part, exactly
    three parts, integer ts.  Adds ``level, ts_ms, message, n``."""
    parts = F.split(F.col(col), r"\|", -1)
    staged = _stage(df, "_tg_p", F.struct(
        F.size(parts).alias("n"), trim_all(F.get(parts, 0)).alias("level"),
        trim_all(F.get(parts, 1)).try_cast("bigint").alias("ts"), trim_all(F.get(parts, 2)).alias("msg")))
    p = F.col("_tg_p")
    reason = (F.when(F.col(col).isNull(), "null")
              .when(p["n"] != 3, "field_count")
              .when(p["ts"].isNull(), "bad_ts"))
    fields = [p["level"].alias("level"), p["ts"].alias("ts_ms"), p["msg"].alias("message"),
              F.lit(1).alias("n")]
    return _finish(staged, reason, fields).drop("_tg_p")


def parse_json_readings(df: DataFrame, col: str = "value") -> DataFrame:
    """JSON readings in either producer shape, parsed with one superset
    schema; ``sensor`` is ``coalesce(sensor_id, sensor)``.  Malformed text or
    a missing sensor/value/timestamp is a reject, not an exception.
    Adds ``sensor, area, value_num, ts_ms, count``."""
    staged = _stage(df, "_tg_j", F.from_json(F.col(col), JSON_READING))
    j = F.col("_tg_j")
    sensor = F.coalesce(j["sensor_id"], j["sensor"])
    reason = (F.when(F.col(col).isNull(), "null")
              .when(j.isNull() | (sensor.isNull() & j["value"].isNull() & j["timestamp"].isNull()),
                    "malformed")
              .when(sensor.isNull(), "no_sensor")
              .when(j["value"].isNull(), "no_value")
              .when(j["timestamp"].isNull(), "no_timestamp"))
    fields = [sensor.alias("sensor"), j["area"].alias("area"), j["value"].alias("value_num"),
              j["timestamp"].alias("ts_ms"), j["count"].alias("count")]
    return _finish(staged, reason, fields).drop("_tg_j")


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows that parsed, without the bookkeeping columns."""
    return parsed.where(F.col(OK)).drop(OK, REASON)


def rejected(parsed: DataFrame, raw_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Side table of failures: ``keep`` columns, the raw text and the reason."""
    return parsed.where(~F.col(OK)).select(*keep, F.col(raw_col).alias("raw"),
                                           F.col(REASON).alias("reason"))
