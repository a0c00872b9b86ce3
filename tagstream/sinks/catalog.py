"""Table definitions in the session catalog (CREATE / DROP).

``create_table`` is ``CREATE TABLE IF NOT EXISTS ... USING parquet`` from a
``schemas.TABLES`` definition, optionally dropping first.  Keys and
VARCHAR limits are not enforced by the storage; ``operators.tables.conform``
and ``pk_violations`` check them before writing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def create_table(spark: SparkSession, name: str, table: Mapping, location: str | None = None,
                 drop: bool = False) -> None:
    if drop:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table["schema"].fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")
