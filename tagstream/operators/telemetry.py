"""Device telemetry as table operators over archived polls.

A poll row carries a register array (16-bit scaled integers by position) and
a bit array (discrete inputs).  Decoding is driven by *map tables* -- rows of
``(device_class, pos, tag, divisor, unit)`` -- so scales are data, not code.
Maps are small (bounded by the device layouts); they are broadcast after a
size check, so the poll table itself is never shuffled by decoding.  Rule
lists are Python lists, so their size is known up front.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.functions.scalars import truncating_scale
from tagstream.operators.joins import bounded_broadcast
from tagstream.schemas import ALARM_TEXTS, ALL_NORMAL

MAP_SCHEMA = "device_class string, pos int, tag string, divisor double, unit string"
MAP_MAX_ROWS = 100_000  # a register map larger than this is joined without a broadcast
RULE_SCHEMA = "tag string, op string, limit double, label string"


def register_map(spark: SparkSession, layouts: Mapping[str, Sequence[tuple]]) -> DataFrame:
    """Map table from ``{device_class: [(pos, tag, divisor, unit), ...]}``."""
    rows = [(cls, int(p), t, float(d), u) for cls, lay in layouts.items() for p, t, d, u in lay]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def decode_registers(polls: DataFrame, regmap: DataFrame, keep: Sequence[str],
                     reg_col: str = "registers", class_col: str = "device_class") -> DataFrame:
    """Long form of the registers present in each poll: ``keep..., tag,
    raw, value, unit`` with ``value = raw / divisor``.  Positions the map
    does not name are ignored; missing positions give no row."""
    exploded = polls.select(*keep, class_col, F.posexplode(reg_col).alias("pos", "raw"))
    j = exploded.join(bounded_broadcast(regmap, MAP_MAX_ROWS), [class_col, "pos"], "inner")
    return j.select(*keep, "tag", "raw", (F.col("raw") / F.col("divisor")).alias("value"), "unit")


def decode_registers_default(polls: DataFrame, regmap: DataFrame, keep: Sequence[str],
                             reg_col: str = "registers", class_col: str = "device_class") -> DataFrame:
    """Every mapped tag of the poll's device class; a register the poll
    lacks decodes to 0 and is flagged ``is_default``."""
    j = polls.select(*keep, class_col, reg_col).join(bounded_broadcast(regmap, MAP_MAX_ROWS), class_col, "inner")
    raw = F.try_element_at(F.col(reg_col), F.col("pos") + 1)
    return j.select(*keep, "tag",
                    (F.coalesce(raw, F.lit(0)) / F.col("divisor")).alias("value"),
                    "unit", raw.isNull().alias("is_default"))


def decode_wide(polls: DataFrame, layout: Sequence[tuple], keep: Sequence[str],
                reg_col: str = "registers") -> DataFrame:
    """One column per tag of a single layout, missing registers as 0."""
    cols = [(F.coalesce(F.try_element_at(F.col(reg_col), F.lit(p + 1)), F.lit(0)) / F.lit(float(d))).alias(t)
            for p, t, d, _u in layout]
    return polls.select(*keep, *cols)


def decode_bits(polls: DataFrame, names: Sequence[str], keep: Sequence[str],
                bits_col: str = "bits", with_count: bool = False) -> DataFrame:
    """Named booleans from a bit array by position; missing bits are False.
    ``with_count`` adds ``bits_read`` (bits actually present), so a False
    that is only a default can be told from a read False."""
    cols = [F.coalesce(F.try_element_at(F.col(bits_col), F.lit(i + 1)), F.lit(False)).alias(n)
            for i, n in enumerate(names)]
    if with_count:
        cols.append(F.coalesce(F.size(bits_col), F.lit(0)).alias("bits_read"))
    return polls.select(*keep, *cols)


def encode_registers(df: DataFrame, fields: Sequence[tuple[Column | str, float]],
                     keep: Sequence[str], out: str = "registers") -> DataFrame:
    """Values -> register array: ``int(value * factor)`` (toward zero) by
    position, the inverse of decoding within 1/factor."""
    regs = [truncating_scale(c, f) if f != 1 else (F.col(c) if isinstance(c, str) else c).cast("int")
            for c, f in fields]
    return df.select(*keep, F.array(*regs).alias(out))


def unpivot_readings(wide: DataFrame, ids: Sequence[str], value_cols: Sequence[str],
                     units: Mapping[str, str], decimals: int | None = 3) -> DataFrame:
    """Wide poll -> long readings ``ids..., sensor, value, unit``; booleans
    become 1.0/0.0, values are rounded to ``decimals``."""

    def reading(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.struct(F.lit(c).alias("sensor"), (v if decimals is None else F.round(v, decimals)).alias("value"),
                        F.lit(units.get(c)).cast("string").alias("unit"))

    return wide.select(*ids, F.inline(F.array(*[reading(c) for c in value_cols])))


def threshold_alarms(readings: DataFrame, spark: SparkSession, rules: Sequence[tuple],
                     tag_col: str = "sensor", value_col: str = "value") -> DataFrame:
    """Readings that trip a rule ``(tag, op, limit, label)``; ``op`` is one
    of ``> >= < <=``.  Adds ``limit`` and ``label``."""
    r = F.broadcast(spark.createDataFrame(list(rules), RULE_SCHEMA)
                    .withColumnRenamed("tag", tag_col))
    j = readings.join(r, tag_col, "inner")
    v, lim = F.col(value_col), F.col("limit")
    tripped = (F.when(F.col("op") == ">", v > lim).when(F.col("op") == ">=", v >= lim)
               .when(F.col("op") == "<", v < lim).when(F.col("op") == "<=", v <= lim)
               .otherwise(F.lit(False)))
    return j.where(tripped).drop("op")


def alarm_list(status: DataFrame, keep: Sequence[str],
               texts: Sequence[tuple[str, bool, str]] = ALARM_TEXTS,
               normal: str = ALL_NORMAL) -> DataFrame:
    """Active alarms per poll, in display order, as an array and a line;
    the line is ``normal`` when none is active.  A text fires when its bit
    equals the given polarity (the health text fires on False)."""
    parts = [F.when(F.col(bit) == F.lit(pol), F.lit(text)) for bit, pol, text in texts]
    arr = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return status.select(*keep, arr.alias("alarms")).withColumn(
        "alarm_text", F.when(F.size("alarms") == 0, F.lit(normal)).otherwise(F.array_join("alarms", "; ")))


def latest_snapshot(readings: DataFrame, keys: Sequence[str], values: Sequence[str],
                    order: Sequence[str]) -> DataFrame:
    """Latest value(s) per key by ``order`` (e.g. ``ts, seq``) and that time.
    ``max_by`` is a partial aggregate: a hot key is reduced map-side."""
    o = F.struct(*order)
    return (readings.groupBy(*keys)
            .agg(F.max_by(F.struct(*values), o).alias("_tg_v"), F.max(order[0]).alias("latest_ts"))
            .select(*keys, "_tg_v.*", "latest_ts"))


def dashboard(sensors: DataFrame, status: DataFrame | None, setpoints: DataFrame | None,
              key: str) -> DataFrame:
    """One row per device: sensors and status side by side (a device
    missing either is skipped), setpoints when present.  Pass
    ``status=None`` when ``sensors`` already carries the status columns
    (both decoded from the same poll)."""
    out = sensors if status is None else sensors.join(status, key, "inner")
    if setpoints is not None:
        out = out.join(setpoints, key, "left")
    return out


def normalize_tags(df: DataFrame, aliases: Sequence[tuple[str, str]], tag_col: str = "tag",
                   out: str = "tag") -> DataFrame:
    """Rename tags between naming schemes; unmapped tags are kept."""
    m = F.create_map(*[F.lit(x) for pair in aliases for x in pair])
    return df.withColumn(out, F.coalesce(F.try_element_at(m, F.col(tag_col)), F.col(tag_col)))


def union_devices(frames: Sequence[DataFrame]) -> DataFrame:
    """Devices with different tag sets in one table (missing tags NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def device_list(df: DataFrame, device_col: str = "device") -> DataFrame:
    """The distinct devices seen."""
    return df.select(device_col).distinct()


def snapshot_of_state(state: DataFrame) -> DataFrame:
    """Device, sensor, value and latest_ts from the state (``key``, ``value``
    structs) of a stream that keeps ``max_by(value, (ts, seq))`` and ``max(ts)``
    per (device, sensor): the latest reading of each as of the state's batch."""
    k, v = (state.schema[c].dataType.fieldNames() for c in ("key", "value"))
    return state.select(F.col("key")[k[0]].alias("device"), F.col("key")[k[1]].alias("sensor"),
                        F.col("value")[v[0]].alias("value"), F.col("value")[v[2]].alias("latest_ts"))
