"""The corpus pipeline: quality rules, near-dedup, decontamination, redaction
of personal data, BPE encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagstream.llm import bpe, decontaminate, neardup, pii, quality
from tagstream.llm.queries import TOKENIZER
from tagstream.session import materialize
from tagstream.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (shingles of five
    words, similarity of 0.8 or more)."""
    return neardup.keep_one(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced."""
    return pii.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of ids and decoded text."""
    return bpe.encode(docs, str(public_tokenizers.path(TOKENIZER)))


STAGES = [("quality", quality_stage), ("neardup", neardup_stage), ("decontamination", decontamination_stage),
          ("pii", pii_stage), ("bpe", bpe_stage)]

#: The quality, near-dedup and BPE stages are not expressible in SQL; tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
