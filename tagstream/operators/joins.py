"""Left-join reporting.

Broadcasting is only done behind a proof of size: ``bounded_broadcast``
checks the row count with a job that stops after ``max_rows + 1`` rows, and
leaves the join to the planner (sort-merge, or AQE's runtime broadcast from
measured shuffle sizes) when the side is larger.

``latest_report`` is the reading/oee/location report (3-table left join,
newest N).  Since a left join gives every reading at least one row and the
order is led by reading columns, the newest N output rows come from the
newest N readings.  So the N readings are taken first (per-task top-N, then a
merge of N rows per task), and only their matches are fetched: each big
table is scanned once, with an ``IN`` filter on at most N keys pushed into
the scan, and never shuffled whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagstream.operators.topk import top_n_per_key

DIM_MAX_ROWS = 200_000


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    ``take`` scans partitions incrementally and stops once it has
    ``max_rows + 1`` rows, and projecting a literal reads no columns, so a
    large table costs a few partitions' row counts, not a full scan."""
    return len(df.select(F.lit(1)).take(max_rows + 1)) <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DIM_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` if its size is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if fits(df, max_rows) else df


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              broadcast_max_rows: int | None = None, hot_right_keys: bool = False) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``.  Many matches fan
    out; unmatched left rows get NULLs.  With ``broadcast_max_rows`` the
    right side is broadcast when it is proven to be that small.

    ``hot_right_keys``: the right side may hold a key with a large share of
    its rows.  AQE can split skewed partitions only on the left side of a
    left outer join, so the join is computed as an inner join (AQE splits
    either side) plus the left rows whose key has no match -- found with an
    anti join against the right side's distinct keys, which are reduced
    map-side first -- padded with NULLs.  Same rows, no oversized task.
    """
    if broadcast_max_rows:
        right = bounded_broadcast(right, broadcast_max_rows)
    cond = left[left_key] == right[right_key]
    if not hot_right_keys:
        return left.join(right, cond, "left")
    matched = left.join(right, cond, "inner")
    keys = right.select(F.col(right_key).alias("_tg_rk")).where(F.col("_tg_rk").isNotNull()).distinct()
    lonely = left.join(keys, left[left_key] == keys["_tg_rk"], "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_report(
    readings: DataFrame, oee: DataFrame, locations: DataFrame,
    r_key: str, o_key: str, o_loc: str, l_key: str,
    reading_order: Sequence[Column], tie_order: Sequence[Column] = (), n: int = 6,
) -> DataFrame:
    """``readings LEFT JOIN oee ON r_key = o_key LEFT JOIN locations ON
    o_loc = l_key ORDER BY reading_order, tie_order LIMIT n``, computed
    with one scan of each input and no shuffle of the large ones.

    ``reading_order`` (reading columns only) must be a total order over
    readings; ``tie_order`` orders a reading's fanned-out rows (oee columns;
    all oee columns are appended as a final tie-break).  Locations are
    joined on their primary key.  Column names must be distinct.

    Steps, each bounded by ``n``: the newest ``n`` readings (per-task top-n,
    merged); their oee matches through an ``IN`` filter on ``n`` keys pushed
    into the scan, reduced to the first ``n`` per key (salted, so a hot key
    is spread); the first ``n`` joined rows; their locations by key.
    """
    spark = readings.sparkSession
    top = readings.orderBy(*reading_order).limit(n)
    top_rows = top.collect()  # at most n rows
    top_df = spark.createDataFrame(top_rows, top.schema)
    keys = sorted({r[r_key] for r in top_rows if r[r_key] is not None})
    orderable = [f.name for f in oee.schema.fields if not isinstance(f.dataType, T.MapType)]
    ties = [*tie_order, *[F.col(c).asc_nulls_first() for c in orderable]]
    if keys:
        hit = oee.where(F.col(o_key).isin(keys))
        best = top_n_per_key(hit, [o_key], ties, n)
        best_df = spark.createDataFrame(best.collect(), oee.schema)  # at most n * n rows
    else:
        best_df = spark.createDataFrame([], oee.schema)
    order = [*reading_order, *ties]
    rows = top_df.join(F.broadcast(best_df), top_df[r_key] == best_df[o_key], "left")
    rows = rows.orderBy(*order).limit(n)
    row_list = rows.collect()  # at most n rows
    rows = spark.createDataFrame(row_list, rows.schema)
    codes = sorted({r[o_loc] for r in row_list if r[o_loc] is not None})
    loc_hit = locations.where(F.col(l_key).isin(codes)) if codes else locations.limit(0)
    out = rows.join(loc_hit, rows[o_loc] == loc_hit[l_key], "left")
    return out.orderBy(*order).limit(n)
