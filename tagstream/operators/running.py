"""Running totals and order ranks that scale past one task per key.

A running total is a prefix sum over an order.  ``sum().over(partitionBy(k)
.orderBy(o))`` puts every row of a key into one task, and with no key at all
the whole table goes to one task.  Here the order is cut into buckets (a
column that never decreases along the order, e.g. ``seq div 65536`` or the
minute of ``ts``):

1. per (key, bucket) totals -- a partial/final hash aggregate, so a hot key
   is pre-aggregated map-side;
2. prefix of those totals over the buckets of a key -- a table with one row
   per bucket, tiny next to the input;
3. join the offsets back on (key, bucket) -- AQE broadcasts the offset table
   when its measured size allows it, else it is a shuffle join;
4. a running window inside each (key, bucket) -- tasks hold one bucket each.

Results equal the single-window formulation exactly for integer / decimal
sums; double sums may differ in the last bits because addition order differs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_tg_bucket"


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def bucketed_prefix(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    sums: Mapping[str, Column] | None = None,
    rank_col: str | None = "rn",
    total_col: str | None = None,
    coarse: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add running sums (inclusive of the row) and a 1-based rank per key.

    ``order`` must be a total order within a key (add a unique ``seq``), and
    ``bucket`` must be non-decreasing along it.  ``total_col`` adds the row
    count of the key (the rank of its last row).

    ``coarse`` maps the bucket column to a coarser, still non-decreasing
    bucket; the offsets over buckets are then computed by the same method
    one level up instead of in one window per key.  Use it when a key (or
    the whole table, with no keys) has too many buckets for one task.
    """
    sums = dict(sums or {})
    keys = list(keys)
    b = df.withColumn(_B, bucket)
    part_aggs = [F.count(F.lit(1)).alias("_tg_c")]
    part_aggs += [F.sum(e).alias(f"_tg_s_{i}") for i, e in enumerate(sums.values())]
    per_bucket = b.groupBy(*keys, _B).agg(*part_aggs)

    n_sums = len(sums)
    if coarse is None:
        before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
        off_cols = [F.coalesce(F.sum("_tg_c").over(before), F.lit(0)).alias("_tg_oc")]
        for i in range(n_sums):
            zero = F.lit(0).cast(per_bucket.schema[f"_tg_s_{i}"].dataType)
            off_cols.append(F.coalesce(F.sum(f"_tg_s_{i}").over(before), zero).alias(f"_tg_os_{i}"))
        if total_col:
            off_cols.append(F.sum("_tg_c").over(Window.partitionBy(*keys)).alias("_tg_n"))
        with_off = per_bucket.select(*keys, _B, *off_cols)
    else:
        # Offsets = inclusive prefix over buckets minus the bucket's own total,
        # computed by the same two-pass method on the (smaller) bucket table.
        level = per_bucket.withColumnRenamed(_B, "_tg_b1")
        inc = {"_tg_ic": F.col("_tg_c"), **{f"_tg_is_{i}": F.col(f"_tg_s_{i}") for i in range(n_sums)}}
        up = bucketed_prefix(level, keys, ["_tg_b1"], coarse(F.col("_tg_b1")), inc, rank_col=None)
        off_cols = [(F.col("_tg_ic") - F.col("_tg_c")).alias("_tg_oc")]
        off_cols += [(F.col(f"_tg_is_{i}") - F.col(f"_tg_s_{i}")).alias(f"_tg_os_{i}") for i in range(n_sums)]
        with_off = up.select(*keys, F.col("_tg_b1").alias(_B), *off_cols)
        if total_col:
            if keys:
                totals = per_bucket.groupBy(*keys).agg(F.sum("_tg_c").alias("_tg_n")).select(
                    *[F.col(k).alias(f"_tg_t{i}") for i, k in enumerate(keys)], "_tg_n")
                tcond = [with_off[k].eqNullSafe(totals[f"_tg_t{i}"]) for i, k in enumerate(keys)]
                with_off = with_off.join(totals, tcond, "inner").drop(
                    *[f"_tg_t{i}" for i in range(len(keys))])
            else:  # one number for the whole input
                n_all = per_bucket.agg(F.sum("_tg_c")).collect()[0][0] or 0
                with_off = with_off.withColumn("_tg_n", F.lit(n_all).cast("long"))
    renamed = [F.col(k).alias(f"_tg_k{i}") for i, k in enumerate(keys)]
    offsets = with_off.select(*renamed, F.col(_B).alias("_tg_kb"),
                              *[c for c in with_off.columns if c not in set(keys) | {_B}])

    cond = [b[k].eqNullSafe(offsets[f"_tg_k{i}"]) for i, k in enumerate(keys)]
    cond.append(b[_B].eqNullSafe(offsets["_tg_kb"]))  # a NULL order value keeps its rows
    joined = b.join(offsets, cond, "inner").drop(*[f"_tg_k{i}" for i in range(len(keys))], "_tg_kb")

    inside = Window.partitionBy(*keys, _B).orderBy(*_cols(order))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = joined
    if rank_col:
        out = out.withColumn(rank_col, F.col("_tg_oc") + F.row_number().over(inside))
    for i, (name, e) in enumerate(sums.items()):
        out = out.withColumn(name, F.col(f"_tg_os_{i}") + F.sum(e).over(running))
    if total_col:
        out = out.withColumnRenamed("_tg_n", total_col)
    drop = [_B, "_tg_oc"] + [f"_tg_os_{i}" for i in range(len(sums))]
    return out.drop(*drop)


def seq_bucket(seq: str | Column, width: int = 1 << 20) -> Column:
    """Bucket of a dense sequence number: ``seq div width``."""
    c = F.col(seq) if isinstance(seq, str) else seq
    return F.floor(c / F.lit(width)).cast("long")


def running_sum(df: DataFrame, keys: Sequence[str], value: str | Column,
                order: Sequence[str | Column], bucket: Column,
                out: str = "running_total",
                coarse: Callable[[Column], Column] | None = None) -> DataFrame:
    """Keyed running sum: one updated total per input row (a keyed reduce
    seen in streaming mode).  Batch form; see ``streaming.stateful`` for the
    per-record stream forms.  ``coarse`` as in ``bucketed_prefix``."""
    v = F.col(value) if isinstance(value, str) else value
    return bucketed_prefix(df, keys, order, bucket, {out: v}, rank_col=None, coarse=coarse)


def running_global_means(df: DataFrame, measures: Mapping[str, Column],
                         order: Sequence[str | Column], bucket: Column,
                         count_col: str = "n_lines",
                         coarse: Callable[[Column], Column] | None = None) -> DataFrame:
    """Global running fold of several measures: running sums, running count,
    and running means ``sum / count`` named ``avg_<measure>``.  With no key
    every bucket's offset comes from one prefix over all buckets, so pass
    ``coarse`` when the bucket count can be large."""
    sums = {f"sum_{k}": v for k, v in measures.items()}
    out = bucketed_prefix(df, [], order, bucket, sums, rank_col=count_col, coarse=coarse)
    for k in measures:
        out = out.withColumn(f"avg_{k}", F.col(f"sum_{k}") / F.col(count_col))
    return out
