"""Table maintenance and constraint checks on DataFrames.

``upsert`` (last write wins) and ``insert_if_absent`` (first write wins) are
the merge semantics of keyed tables, built from a keyed ``max_by``/``min_by``
(partial aggregation -- a hot key is reduced map-side) over the union of both
inputs, or with a ``left_anti`` join.  The result is a new table state; writing it is the sink's job
(``sinks.files.write_snapshot`` commits it as a whole; ``upsert_into``
rewrites only the touched partitions of a partitioned table).  Keys are
primary keys: non-NULL (``pk_violations`` finds rows that break this; such
rows are kept, never dropped).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pick(df: DataFrame, keys: Sequence[str], order: Column | str, last: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in set(keys)]
    o = F.col(order) if isinstance(order, str) else order
    pick = F.max_by if last else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*rest), o).alias("_tg_row")).select(*keys, "_tg_row.*")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (last write)."""
    return _pick(df, keys, order, last=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """One row per key: the one with the least ``order`` (first write)."""
    return _pick(df, keys, order, last=False)


def _with_order(batch: DataFrame, cols: Sequence[str], order: Column | str) -> DataFrame:
    o = F.col(order) if isinstance(order, str) else order
    return batch.select(*cols, o.alias("_tg_ord"))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE``: the batch's last row per
    key (by ``order``, e.g. input sequence) replaces the target's row.
    Re-applying the same batch gives the same table (idempotent).  One keyed
    aggregate over both inputs picks each key's row: one scan of each, one
    shuffle.  The target's keys are unique, as primary keys are; rows whose
    key has a NULL part all stay."""
    cols = target.columns
    new = _with_order(batch, cols, order)
    old = target.select(*cols, F.lit(None).cast(new.schema["_tg_ord"].dataType).alias("_tg_ord"))
    both = old.withColumn("_tg_new", F.lit(0)).unionByName(new.withColumn("_tg_new", F.lit(1)))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    # a key with a NULL part matches nothing: each such row is its own group
    both = both.withColumn("_tg_own", F.when(no_key, F.monotonically_increasing_id()))
    return last_per_key(both, [*keys, "_tg_own"], F.struct("_tg_new", "_tg_ord")).select(*cols)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                     order: Column | str) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING``: keys already in the
    target keep their row; new keys get the batch's first row."""
    cols = target.columns
    first = first_per_key(_with_order(batch, cols, order), keys, "_tg_ord").select(*cols)
    new = first.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new)


def stamp_batch(df: DataFrame, col: str, as_of) -> DataFrame:
    """Column default: fill NULLs of ``col`` with one batch-wide time (the
    transaction start), so one batch shares one stamp."""
    lit = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.withColumn(col, F.coalesce(F.col(col), lit))


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: duplicated (``n > 1``) or with a NULL
    part.  Returns ``keys..., n, has_null``."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    g = g.withColumn("has_null", has_null)
    return g.where((F.col("n") > 1) | F.col("has_null"))


def decimal_fit(x: Column | str, precision: int = 5, scale: int = 2) -> Column:
    """Round half-up to ``scale`` places and fit ``decimal(precision,
    scale)``; NULL when it does not fit (never raises).

    The range is checked on the number before any cast: a ``try_cast`` that
    overflows takes Spark's exception path, which is slow when most values
    do not fit.  Values below the bound are cast to one extra integer digit
    (so rounding up to the bound still fits), then bounded again."""
    c = F.col(x) if isinstance(x, str) else x
    bound = 10 ** (precision - scale)
    wide = F.when(F.abs(c) < F.lit(float(bound)), c.cast(T.DecimalType(precision + 1, scale)))
    return F.when(F.abs(wide) < F.lit(bound), wide.cast(T.DecimalType(precision, scale)))


def length_ok(x: Column | str, max_len: int) -> Column:
    """``VARCHAR(max_len)`` check (characters)."""
    c = F.col(x) if isinstance(x, str) else x
    return c.isNull() | (F.length(c) <= max_len)


def conform(df: DataFrame, table: Mapping) -> DataFrame:
    """Cast a DataFrame to a table definition (``schemas.TABLES[...]``) and
    add ``_valid``: key parts present, decimals fit, VARCHAR limits held."""
    schema: T.StructType = table["schema"]
    cols, ok = [], F.lit(True)
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c2 = decimal_fit(c, f.dataType.precision, f.dataType.scale)
            ok = ok & (c.isNull() | c2.isNotNull())
        else:
            c2 = c.cast(f.dataType)
        if f.name in table.get("varchar", {}):
            ok = ok & length_ok(c, table["varchar"][f.name])
        if f.name in table.get("key", []):
            ok = ok & c.isNotNull()
        cols.append(c2.alias(f.name))
    return df.select(*cols, ok.alias("_valid"))


def upsert_into(path: str, batch: DataFrame, keys: Sequence[str], order: Column | str,
                partition_col: str, max_partitions: int = 100_000) -> None:
    """Upsert a batch into a parquet table partitioned by ``partition_col``,
    rewriting only the partitions the batch touches.

    ``partition_col`` must be one of ``keys`` (a key lives in one
    partition).  The touched partitions' rows are merged with the batch
    (``upsert``), the result is staged in the shared folder (a table cannot
    be overwritten while it is read), then written back with dynamic
    partition overwrite, which replaces exactly those partitions.  Other
    partitions are neither read nor written.
    """
    from tagstream.operators.joins import bounded_broadcast
    from tagstream.session import path_exists, scratch_path

    if partition_col not in keys:
        raise ValueError("partition_col must be part of the key")
    spark = batch.sparkSession
    cols = [c for c in batch.columns if c not in ("_tg_ord", order if isinstance(order, str) else None)]
    current = spark.read.parquet(path) if path_exists(spark, path) else None
    if current is None:  # first write; an error of the store is raised above
        merged = last_per_key(_with_order(batch, cols, order), keys, "_tg_ord").select(*cols)
    else:
        target_cols = [c for c in current.columns]
        touched = bounded_broadcast(batch.select(partition_col).distinct(), max_partitions)
        current = current.join(touched, partition_col, "left_semi").select(*target_cols)
        merged = upsert(current, batch, keys, order)
    stage = scratch_path(spark, "upsert_stage")
    merged.write.parquet(stage)
    # Rebalance by partition value: few files per partition, while AQE still
    # splits a partition holding a large share of the rows over many tasks.
    (spark.read.parquet(stage).hint("rebalance", partition_col)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """A catalog table of ``df`` dealt by its keys into ``buckets``, sorted in
    each: joins on the keys read it without a shuffle."""
    (df.repartition(buckets, *keys).write.mode("errorifexists").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))


def upsert_bucketed(table: str, batch: DataFrame, keys: Sequence[str], order: Column | str, new_table: str, path: str,
                    buckets: int) -> DataFrame:
    """``upsert`` of a batch into a bucketed table, written as its next version
    ``new_table``.  Only the batch is shuffled, to the table's buckets; the
    table is scanned bucket by bucket and merged in place.  Its keys are unique
    and not null; rows of the batch whose key has a NULL part are rejected as a
    primary key rejects them."""
    spark = batch.sparkSession
    merged = bucketed_merge(spark.table(table), batch, keys, order, buckets)
    write_bucketed(merged, new_table, path, keys, buckets)
    return spark.table(new_table)


def bucketed_merge(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Column | str,
                   buckets: int) -> DataFrame:
    """The rows of ``target``, read by its ``buckets``, with the batch's last
    row per key put in."""
    cols, keys = target.columns, list(keys)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    new = last_per_key(_with_order(batch.where(complete), cols, order), keys, "_tg_ord")
    # dealt as the table is: fewer buckets than shuffle partitions would be dealt anew
    new = new.repartition(buckets, *keys).select(*keys, F.struct(*[c for c in cols if c not in keys]).alias("_tg_new"))
    both = target.join(new, keys, "full")
    return both.select(*[F.col(c) if c in keys else
                         F.when(F.col("_tg_new").isNotNull(), F.col(f"_tg_new.{c}")).otherwise(F.col(c)).alias(c)
                         for c in cols])
