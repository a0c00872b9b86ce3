"""Sort, limit and top-k.

A global ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task
keeps its own top n and only n rows per task reach the final merge, so no
full sort or shuffle of the input happens.  Orders must be total (add a
unique tie-break) for results to be deterministic.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows by ``order`` (a leaderboard)."""
    return df.orderBy(*order).limit(n)


def tail_n(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The last ``n`` rows by ascending ``order`` (e.g. the last lines)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                  salts: int = 32) -> DataFrame:
    """The first ``n`` rows of every key, exact, with hot keys split.

    Stage 1 keeps the top ``n`` of each (key, salt) slice, so a key with a
    third of the rows is sorted in ``salts`` tasks; stage 2 ranks the at most
    ``n * salts`` survivors per key.  ``order`` must be a total order.
    """
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    w1 = Window.partitionBy(*keys, "_tg_salt").orderBy(*order)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    stage1 = (df.withColumn("_tg_salt", salt)
              .withColumn("_tg_rn", F.row_number().over(w1)).where(F.col("_tg_rn") <= n))
    return (stage1.withColumn("_tg_rn", F.row_number().over(w2)).where(F.col("_tg_rn") <= n)
            .drop("_tg_rn", "_tg_salt"))


def sql_over_view(df: DataFrame, sql_template: str) -> DataFrame:
    """Run SQL over ``df`` registered as a temporary view.  The template
    names the view ``{view}``; the name is unique per call."""
    view = f"tg_view_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql_template.format(view=view))
