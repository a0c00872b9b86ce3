"""Ordered folds as compositions of affine maps.

A fold that replaces an accumulator by ``a * acc + b`` per reading, with ``a``
and ``b`` of the reading, is not commutative, but composing two such maps is
associative: ``(a2, b2) after (a1, b1) = (a1 * a2, a2 * b1 + b2)``.  So a
group's readings are cut into sub-buckets along their order, each composes to
one row, and the few rows of a group are composed again:

- the halving fold ``(acc + v) / 2`` is ``a = 1/2, b = v / 2``;
- an exponential mean of weight ``w`` is ``a = 1 - w, b = w * v``;
- a decay by the time between readings has an ``a`` of its own per reading;
- a running sum is ``a = 1, b = v``.

The accumulator begins as the group's first reading, which maps of the mean
kind leave as it is.  Null readings are no readings: they neither count nor
move the accumulator nor come first.  A group without readings has a null fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def halving(value: str) -> tuple[Column, Column]:
    return F.lit(0.5), F.col(value) * 0.5


def exponential(value: str, weight: float) -> tuple[Column, Column]:
    if not 0 < weight <= 1:
        raise ValueError("weight must lie in (0, 1]")
    return F.lit(1.0 - weight), F.col(value) * weight


def _products(rows: DataFrame, part: Sequence[str], order: Sequence[Column], a: str, out: str) -> DataFrame:
    """Adds the product of ``a`` over the rows that follow in the order."""
    later = Window.partitionBy(*part).orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, F.coalesce(F.product(a).over(later), F.lit(1.0)))


def affine_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, step: tuple[Column, Column],
                sub_bucket: Column, out: str = "fold", first: Sequence[str] = ()) -> DataFrame:
    """Per group: ``keys``, the fold, cnt (of readings), the largest of the
    first order column as ``max_<name>``, and ``first_<name>`` of the first
    reading for ``first``.

    ``order`` must be total within a group, and ``sub_bucket`` must not fall
    along it; its size bounds what one task sorts."""
    keys, order = list(keys), list(order)
    is_reading = F.col(value).isNotNull()
    a, b = step
    rows = df.select(
        *keys, *[F.col(c) for c in order if c not in keys], sub_bucket.alias("tg_b"),
        F.when(is_reading, a).otherwise(1.0).cast("double").alias("tg_a"),
        F.when(is_reading, b).otherwise(0.0).cast("double").alias("tg_add"),
        F.col(value).cast("double").alias("tg_v"), *[F.col(c).alias(f"tg_f_{c}") for c in first])
    rows = _products(rows, [*keys, "tg_b"], [F.col(c) for c in order], "tg_a", "tg_w")
    head = F.struct(F.col("tg_v"), *[F.col(f"tg_f_{c}") for c in first])
    place = F.struct(*[F.col(c) for c in order])
    subs = rows.groupBy(*keys, "tg_b").agg(
        F.product("tg_a").alias("tg_a"), F.sum(F.col("tg_add") * F.col("tg_w")).alias("tg_add"),
        F.count("tg_v").alias("tg_n"), F.max(order[0]).alias("tg_max"),
        F.min_by(head, F.when(F.col("tg_v").isNotNull(), place)).alias("tg_first"))
    return compose(subs, keys, [F.col("tg_b")], out, f"max_{order[0]}", first)


def compose(subs: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, max_col: str,
            first: Sequence[str] = ()) -> DataFrame:
    """The folds of groups from their sub-buckets' compositions (columns
    ``tg_a``, ``tg_add``, ``tg_n``, ``tg_max``, ``tg_first``)."""
    subs = _products(subs, keys, order, "tg_a", "tg_w")
    has = F.col("tg_n") > 0
    g = subs.groupBy(*keys).agg(
        F.product("tg_a").alias("tg_a"), F.sum(F.col("tg_add") * F.col("tg_w")).alias("tg_add"),
        F.sum("tg_n").alias("cnt"), F.max("tg_max").alias(max_col),
        F.min_by("tg_first", F.when(has, F.struct(*order))).alias("tg_first"))
    return g.select(*keys, (F.col("tg_first.tg_v") * F.col("tg_a") + F.col("tg_add")).alias(out), "cnt", max_col,
                    *[F.col(f"tg_first.tg_f_{c}").alias(f"first_{c}") for c in first])
