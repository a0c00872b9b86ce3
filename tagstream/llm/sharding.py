"""Shards by sampled splitters, in DataFrame operations.

Law ``bytes``: shards are consecutive ranges of the key order whose sizes are
near equal (two shards differ by less than the two largest records).

1. Keys are drawn with a chance in proportion to their record's size (by a
   hash of key and seed, so a lost task draws the same again); quantiles of
   the sample are the splitters of many small ranges.
2. Ranges that turn out overfull are subdivided: by quantiles of all their
   keys, and where one key fills a range, by a hash of the row.
3. Range totals are summed up in order (one small row per range); inside a
   range, a running sum gives each record its place in the whole order of
   bytes and of rows.  The record's middle byte decides its shard.

Only key, size and checksum are shuffled, never a text.

Defined cases: a null text has no bytes (checksum 0); a null key sorts first;
rows that share a key, even a third of all rows, are cut between shards like
others, in the order of checksum, size and place in the input; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 24
#: Bytes that a record takes besides its text.
RECORD_BYTES = 8
#: Ranges that the sample is cut into.
RANGES = 512
#: Expected number of keys in the sample.
SAMPLE_KEYS = 16_384
#: A range of more than so many times the mean is subdivided.
OVERFULL = 4
_HASH_RANGE = float(1 << 32)
LEAST_KEY = -float(2 ** 64)


def records(docs: DataFrame, key_col: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col(key_col).cast("long").alias("doc_id"),
                       (F.octet_length(text).cast("long") + RECORD_BYTES).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("place"))


def quantiles(df: DataFrame, n: int) -> list[float]:
    """The ``n - 1`` keys that cut ``df`` evenly (one may come up often)."""
    row = df.agg(F.percentile_approx("key", [k / n for k in range(1, n)], 10 * n).alias("q")).first()
    return list(row["q"] or [])


def isolating(cuts: list[float]) -> list[float]:
    """Boundaries at the quantiles; one that comes up more than once is a key
    with many rows and gets a range of its own."""
    return [*cuts, *(math.nextafter(c, math.inf) for c, n in Counter(cuts).items() if n > 1)]


def with_range(df: DataFrame, bounds: list[float]) -> DataFrame:
    """``range``: how many boundaries lie at or under the key."""
    splits = [-math.inf, *bounds, math.inf]
    return Bucketizer(splits=splits, inputCol="key", outputCol="_range").transform(df).withColumn(
        "range", F.col("_range").cast("int")).drop("_range")


def shards(docs: DataFrame, n_shards: int = SHARDS, key_col: str = "doc_id", n_ranges: int = RANGES,
           sample_keys: int = SAMPLE_KEYS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    # the cast to double keeps the order; equal doubles share a range and are
    # ordered by the exact key inside it
    rows = records(docs, key_col).withColumn("key", F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf)))
    totals = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    empty = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"
    if not totals["rows"]:
        return spark.createDataFrame([], empty)
    total = totals["bytes"]
    drawn = F.abs(F.xxhash64("doc_id", "place", F.lit(17)) % (1 << 32)) / _HASH_RANGE
    sample = rows.where((drawn * total < F.col("size") * float(sample_keys)) & (F.col("key") >= LEAST_KEY))
    # rows without a key (minus infinity) have a range of their own
    bounds = sorted({LEAST_KEY, *isolating(quantiles(sample, n_ranges))})

    counted = with_range(rows, bounds).groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    limit = OVERFULL * max(1, totals["rows"] // n_ranges)
    full = [r["range"] for r in counted.where(F.col("n") > limit).collect()]  # at most OVERFULL-th of the ranges
    if full:
        crowded = with_range(rows, bounds).where(F.col("range").isin(full) & (F.col("key") >= LEAST_KEY))
        bounds = sorted({*bounds, *isolating(quantiles(crowded, n_ranges))})
    ranged = with_range(rows, bounds)
    counted = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    # where one key fills a range, several tasks share it by a hash of the row
    pieces = F.ceil(F.col("n") / F.lit(limit)).cast("int").alias("pieces")
    split = counted.where(F.col("n") > limit).select("range", pieces)
    ranged = ranged.join(F.broadcast(split), "range", "left")  # at most one row per range
    ranged = ranged.withColumn("piece", F.when(F.col("pieces").isNull(), 0).otherwise(
        F.pmod(F.xxhash64("place"), F.col("pieces"))).cast("int"))

    inside = Window.partitionBy("range", "piece").orderBy("doc_id", "text_crc32", "size", "place")
    ranged = ranged.withColumn("_sum", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    ranged = ranged.withColumn("_row", F.row_number().over(inside).cast("long") - 1)
    sums = ranged.groupBy("range", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # one row per range piece: at most a few times n_ranges rows
    before = Window.orderBy("range", "piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range", "piece", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_bytes"),
                       F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_rows"))
    placed = ranged.join(F.broadcast(sums), ["range", "piece"])
    middle = 2 * (F.col("_bytes") + F.col("_sum")) - F.col("size")
    placed = placed.select("doc_id", "size", "text_crc32", F.expr(f"{n_shards}L").alias("_n"), middle.alias("_mid"),
                           (F.col("_rows") + F.col("_row")).alias("_at"))
    placed = placed.withColumn("shard", F.least(F.expr(f"_mid * _n div {2 * total}L"), F.lit(n_shards - 1)).cast("int"))
    first = placed.groupBy("shard").agg(F.min("_at").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(  # n_shards rows
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_at") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
