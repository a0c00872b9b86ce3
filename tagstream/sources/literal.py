"""Bounded literal rows with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """A small bounded collection (fixtures, lookup maps).  Dicts or tuples;
    the schema is always explicit, never inferred."""
    if rows and isinstance(rows[0], dict):
        names = schema.fieldNames() if isinstance(schema, T.StructType) else None
        if names:
            rows = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(rows, schema)
