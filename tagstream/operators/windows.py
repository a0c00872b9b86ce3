"""Event-time windows: tumbling, sliding, gapped hopping, and the folds.

All windows align to the Unix epoch.  Window columns are returned flat as
``window_start`` / ``window_end`` (same type as the input time column), after
the aggregate, so on a stream the aggregate still groups by the ``window``
struct that carries the watermark.

Time columns are ``timestamp`` or ``timestamp_ntz``.  Numeric epoch columns
are converted with ``event_time(df, col, unit)`` first: the unit is an
argument because a value in seconds read as milliseconds silently collapses
every window into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagstream.functions.scalars import epoch_ms_to_ts

_UNIT_MS = {"ms": 1, "s": 1000, "us": None}


def event_time(df: DataFrame, col: str, unit: str = "ms", out: str = "ts") -> DataFrame:
    """Attach an event-time column from an epoch number in ``unit``."""
    if unit not in ("ms", "s"):
        raise ValueError(f"unit must be 'ms' or 's', got {unit!r}")
    ms = F.col(col).cast("long") * F.lit(_UNIT_MS[unit])
    return df.withColumn(out, epoch_ms_to_ts(ms))


def _interval(spec: str) -> Column:
    return F.expr(f"INTERVAL {spec}")


def _flatten(agg: DataFrame, keys: Sequence[str], end: Column | None = None) -> DataFrame:
    rest = [c for c in agg.columns if c not in set(keys) | {"window"}]
    return agg.select(
        *keys,
        F.col("window.start").alias("window_start"),
        (end if end is not None else F.col("window.end")).alias("window_end"),
        *rest,
    )


def tumbling(df: DataFrame, keys: Sequence[str], ts: str, size: str,
             aggs: Sequence[Column]) -> DataFrame:
    """Tumbling windows of ``size`` per key (partial + final hash aggregate)."""
    g = df.groupBy(*keys, F.window(ts, size).alias("window")).agg(*aggs)
    return _flatten(g, keys)


def sliding(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
            aggs: Sequence[Column]) -> DataFrame:
    """Sliding windows (``size`` every ``slide``; each row in size/slide windows)."""
    g = df.groupBy(*keys, F.window(ts, size, slide).alias("window")).agg(*aggs)
    return _flatten(g, keys)


#: Panes of a block of ``sliding_count``.
BLOCK_PANES = 12


def sliding_count(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
                  out: str = "cnt", tasks: int | None = None) -> DataFrame:
    """Row counts of sliding windows, from panes of one ``slide``: rows are
    counted per pane first, and only the panes are dealt to the windows that
    hold them.  Batch only; ``slide`` must divide ``size``.

    Without ``tasks``, rows are combined before each of two shuffles, which
    suits few keys per pane.  Where almost every row has its own key and pane (words),
    that only fills memory: give ``tasks`` in proportion to the input.  Rows
    are then dealt once, to that many tasks, by key and block of panes (with the
    rows of the panes before it that its windows hold), and a
    task counts panes and windows of its blocks alone."""
    if _seconds(size) % _seconds(slide):
        return sliding(df, keys, ts, size, slide, [F.count(F.lit(1)).alias(out)])
    count = F.count(F.lit(1)).alias("_tg_n")
    if tasks is None:
        panes = df.groupBy(*keys, F.window(ts, slide).start.alias("_tg_pane")).agg(count)
        return sliding(panes, keys, "_tg_pane", size, slide, [F.sum("_tg_n").alias(out)])

    def start(of: str, length: str, name: str, frame: DataFrame) -> DataFrame:
        return frame.withColumn(name, F.window(of, length).start)

    block = f"{round(max(BLOCK_PANES * _seconds(slide), _seconds(size)) / _seconds(slide)) * _seconds(slide)} seconds"
    rows = start(ts, slide, "_tg_pane", df.select(*keys, ts))
    rows = rows.withColumn("_tg_first", F.col("_tg_pane") - _interval(size) + _interval(slide))  # its first window
    rows = start("_tg_pane", block, "_tg_b", start("_tg_first", block, "_tg_a", rows))
    homes = F.when(F.col("_tg_a") == F.col("_tg_b"), F.array("_tg_b")).otherwise(F.array("_tg_a", "_tg_b"))
    rows = rows.select(*keys, "_tg_pane", F.explode(homes).alias("_tg_block"))
    panes = rows.repartition(tasks, *keys, "_tg_block").groupBy(*keys, "_tg_block", "_tg_pane").agg(count)
    windows = F.array(*[F.col("_tg_pane") - _interval(slide) * k for k in range(round(_seconds(size) / _seconds(slide)))])
    held = panes.select(*keys, "_tg_block", "_tg_n", F.explode(windows).alias("window_start"))
    held = start("window_start", block, "_tg_own", held).where("_tg_own = _tg_block")
    return held.groupBy(*keys, "_tg_block", "window_start").agg(F.sum("_tg_n").alias(out)).select(
        *keys, "window_start", (F.col("window_start") + _interval(size)).alias("window_end"), out)


def _seconds(spec: str) -> float:
    n, unit = spec.split()
    unit = unit.lower().rstrip("s")
    scale = {"millisecond": 1e-3, "second": 1, "minute": 60, "hour": 3600, "day": 86400,
             "week": 604800}[unit]
    return float(n) * scale


def hopping_gapped(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str,
                   aggs: Sequence[Column]) -> DataFrame:
    """Hopping windows whose slide exceeds their size.

    A window of ``size`` starts every ``slide``; rows in the gap between the
    end of one window and the start of the next belong to no window.  Spark's
    ``window()`` requires slide <= size, so: tumble by ``slide`` and keep rows
    less than ``size`` past the window start.  ``window_end`` is start + size.
    When slide <= size this is an ordinary sliding window.
    """
    if _seconds(slide) <= _seconds(size):
        return sliding(df, keys, ts, size, slide, aggs)
    w = df.withColumn("window", F.window(ts, slide))
    kept = w.where(F.col(ts) < F.col("window.start") + _interval(size))
    g = kept.groupBy(*keys, "window").agg(*aggs)
    return _flatten(g, keys, F.col("window.start") + _interval(size))


def pairwise_avg(df: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str,
                 size: str, sub_bucket: str, unit: str | None = None) -> DataFrame:
    """The ordered fold ``acc = (acc + v) / 2`` per key and tumbling window.

    This is what a reduce with ``(a + b) / 2`` computes: not the mean, but an
    exponentially weighted fold over arrival order.  In closed form, with
    ``rn`` the 1-based rank by ``(ts, seq)`` and ``n`` the window's count,
    ``fold = sum(v * 2^(rn - n - 1))`` except the first row weighs
    ``2^(1 - n)``.  Rows are ranked from the end inside ``sub_bucket``
    sub-windows, each of which folds to one row (weighted sum, count, first
    row); these few rows are then weighed by the counts that follow them.  So
    the input is scanned and shuffled once, and no (key, window) is sorted in
    one piece.  A one-row window returns its value.  Also returns max ts,
    count and first unit.
    """
    keys = list(keys)
    w = df.withColumn("_tg_ws", F.window(ts, size).start).withColumn("_tg_bucket", F.window(ts, sub_bucket).start)
    part = [*keys, "_tg_ws"]
    from_end = Window.partitionBy(*part, "_tg_bucket").orderBy(F.col(ts).desc(), F.col(seq).desc())
    ranked = w.withColumn("_tg_r", F.row_number().over(from_end))
    # rank numbers fall along the order: the largest is the sub-window's first
    firsts = [value] + ([unit] if unit else [])
    subs = ranked.groupBy(*part, "_tg_bucket").agg(
        F.sum(F.col(value) * F.pow(F.lit(2.0), -F.col("_tg_r"))).alias("_tg_s"),
        F.count(F.lit(1)).alias("_tg_c"), F.max(ts).alias("_tg_max"),
        F.max_by(F.struct(*firsts), "_tg_r").alias("_tg_first"))
    after = Window.partitionBy(*part).orderBy(F.col("_tg_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    subs = subs.withColumn("_tg_after", F.coalesce(F.sum("_tg_c").over(after), F.lit(0)))
    g = subs.groupBy(*part).agg(
        F.sum(F.col("_tg_s") * F.pow(F.lit(2.0), -F.col("_tg_after"))).alias("_tg_fold"),
        F.max("_tg_max").alias("max_ts"), F.sum("_tg_c").alias("cnt"),
        F.min_by("_tg_first", "_tg_bucket").alias("_tg_first"))
    # the first row weighs twice what its rank gives
    first = F.coalesce(F.col("_tg_first")[value] * F.pow(F.lit(2.0), -F.col("cnt")), F.lit(0.0))
    return g.select(*keys, F.col("_tg_ws").alias("window_start"),
                    (F.col("_tg_ws") + _interval(size)).alias("window_end"),
                    (F.col("_tg_fold") + first).alias("pairwise_avg"), "max_ts", "cnt",
                    *([F.col("_tg_first")[unit].alias("first_unit")] if unit else []))


def first_over_count(df: DataFrame, keys: Sequence[str], ts: str, seq: str,
                     value: str, size: str, first_cols: Sequence[str] = ()) -> DataFrame:
    """Tumbling fold that keeps the first value and divides it by the count.

    What a reduce that keeps ``a.value`` and only sums counts reports as an
    "average": ``first(value by (ts, seq)) / count``.  Also returns max ts,
    count and the first of ``first_cols``.  ``min_by`` is a partial/final
    aggregate, so hot keys are combined map-side.
    """
    order = F.struct(ts, seq)
    aggs = [
        (F.min_by(value, order) / F.count(F.lit(1))).alias("first_over_count"),
        F.max(ts).alias("max_ts"),
        F.count(F.lit(1)).alias("cnt"),
    ] + [F.min_by(c, order).alias(f"first_{c}") for c in first_cols]
    return tumbling(df, keys, ts, size, aggs)
