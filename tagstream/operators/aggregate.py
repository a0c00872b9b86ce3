"""Keyed and global reductions without windows.

All are hash aggregates with a map-side partial step, so a key holding a
third of the rows is reduced inside each input task before the shuffle and
moves one row per task, not its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_sum(df: DataFrame, keys: Sequence[str], value: str | Column,
              out: str = "total", count_col: str | None = "cnt") -> DataFrame:
    """Final keyed sum (what a keyed reduce emits last in batch mode)."""
    v = F.col(value) if isinstance(value, str) else value
    aggs = [F.sum(v).alias(out)]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*keys).agg(*aggs)


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """``COUNT(*)`` as a one-row DataFrame (partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def ratio(num: str | Column, den: str | Column) -> Column:
    """Derived ratio after an aggregate (NULL when the denominator is 0)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.when(d != 0, n / d)
