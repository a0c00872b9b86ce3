"""Line and word operators over a text column.

Tokenising is ``lower`` + split on whitespace runs + drop empty tokens: the
native equivalent of ``line.lower().split()``.  Everything runs inside the
scan stage; the only shuffle is the final keyed count, which is a
partial/final aggregate (a hot word is counted map-side first).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.functions.scalars import trim_all
from tagstream.schemas import LINE_CLASS_DEFAULT, LINE_CLASSES


def words(df: DataFrame, text_col: str = "line", keep: Sequence[str] = (),
          min_len: int = 0, with_pos: bool = False) -> DataFrame:
    """One row per lower-cased whitespace token (``word``), tokens longer
    than ``min_len`` characters only; ``keep`` columns are carried along.
    Empty tokens are dropped after the explode, inside generated code."""
    toks = F.split(F.lower(F.col(text_col)), r"\s+")
    if with_pos:
        # Trimmed first, so there is no leading empty token and positions
        # count real tokens (an all-blank text gives one empty token).
        toks = F.split(F.lower(trim_all(F.col(text_col))), r"\s+")
        out = df.select(*keep, F.posexplode(toks).alias("pos", "word")).where(F.col("word") != "")
    else:
        out = df.select(*keep, F.explode(toks).alias("word")).where(F.col("word") != "")
    if min_len:
        out = out.where(F.length("word") > min_len)
    return out


def drop_words(df: DataFrame, stop: Iterable[str], word_col: str = "word") -> DataFrame:
    """Remove tokens found in a stop list.  A short list is an ``IN`` filter
    fused into the scan stage; pass a DataFrame for a long list (anti join)."""
    if isinstance(stop, DataFrame):
        return df.join(stop.withColumnRenamed(stop.columns[0], word_col), word_col, "left_anti")
    stop = list(stop)
    return df.where(~F.col(word_col).isin(stop)) if stop else df


def word_count(df: DataFrame, word_col: str = "word") -> DataFrame:
    """Keyed count of words: ``word, cnt``."""
    return df.groupBy(word_col).agg(F.count(F.lit(1)).alias("cnt"))


def classify(text: str | Column, rules: Sequence[tuple[str, str]] = LINE_CLASSES,
             default: str = LINE_CLASS_DEFAULT) -> Column:
    """Ordered substring rules on the lower-cased text; first match wins.
    Substring, not token, match: ``tools`` contains ``ls``."""
    t = F.lower(F.col(text) if isinstance(text, str) else text)
    expr = None
    for needle, label in rules:
        cond = t.contains(needle)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def line_metrics(df: DataFrame, text_col: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """Per line: characters and words (``n_chars``, ``n_words``)."""
    t = trim_all(F.col(text_col))
    n_words = F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))
    return df.select(*keep, F.length(text_col).alias("n_chars"), n_words.alias("n_words"))


def global_line_stats(metrics: DataFrame) -> DataFrame:
    """Whole-input fold: average characters and words per line, line count.
    A key-less aggregate: partial sums per task, one tiny final merge."""
    return metrics.agg(
        (F.sum("n_chars") / F.count(F.lit(1))).alias("avg_chars"),
        (F.sum("n_words") / F.count(F.lit(1))).alias("avg_words"),
        F.count(F.lit(1)).alias("n_lines"),
    )


def clean_lines(df: DataFrame, text_col: str = "line") -> DataFrame:
    """Strip each line and drop blank ones (what a file follower emits)."""
    return df.withColumn(text_col, trim_all(F.col(text_col))).where(F.col(text_col) != "")


def distinct_lines(df: DataFrame, text_col: str = "line") -> DataFrame:
    """Each distinct stripped, non-blank line once (exact, batch).  On a
    stream use ``streaming.dedupe.distinct_lines_stream`` (bounded state)."""
    return clean_lines(df, text_col).select(text_col).dropDuplicates([text_col])
