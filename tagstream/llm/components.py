"""Connected components of a distributed edge list, in DataFrame operations.

Alternating large-star and small-star steps: every vertex's larger neighbours
are linked to the smallest vertex it sees, then its smaller ones are, until
nothing changes.  Each step is a map-side aggregated minimum per vertex and a
join with it; a hub is aggregated before the shuffle, and its rows in the join
are split by AQE's skew handling, so no task holds a hub's neighbours at once.
The lineage is cut after each round by a table in the shared folder; nothing
but a count comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.session import materialize


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One step over edges (u > v): link to the smallest neighbour."""
    if larger:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("_u"), F.least("m", "u").alias("m"))
    linked = both.join(least, both["u"] == least["_u"])
    if larger:
        pairs = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        pairs = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    return pairs.where(F.col("u") > F.col("v")).distinct()


def _mark(edges: DataFrame):
    """Order-free digest of an edge table."""
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex in ``edges`` (columns ``a``,
    ``b``): the smallest vertex it is connected with.  Vertices may be of any
    ordered type.  Null ends and loops are ignored; repeated edges and either
    direction are fine; no edges give no rows."""
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = materialize(e.distinct(), "cc-0")
    mark = _mark(e)
    before, k = None, 0
    while mark[0] and mark != before:  # every round brings vertices closer to their least one, so it ends
        before, k = mark, k + 1
        e = materialize(_star(_star(e, True), False), f"cc-{k}")
        mark = _mark(e)
    roots = e.select(F.col("v").alias("u"), "v").distinct()
    return e.select("u", "v").unionByName(roots).select(F.col("u").alias("vertex"), F.col("v").alias("component"))
