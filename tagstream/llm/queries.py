"""Thin queries over the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagstream.llm import (bpe, conversations, decontaminate, html_text, neardup, phrases, pii, quality, repeats,
                           sharding, token_files, urls, warc)
from tagstream.sources.tables import read_table

TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archive(read_table(spark, sf_dir, "pages"))
    return warc.read_records(spark, folder)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read_table(spark, sf_dir, "pages"))


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(read_table(spark, sf_dir, "documents"), words=2, percent=80)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = token_files.write_tokens(docs, str(public_tokenizers.path(TOKENIZER)))
    return token_files.read_tokens(spark, folder)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination(read_table(spark, sf_dir, "documents"),
                                         read_table(spark, sf_dir, "benchmark"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), str(public_tokenizers.path(TOKENIZER)), with_ids=False)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(read_table(spark, sf_dir, "conversations"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"), with_text=False)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_pii, op2_url_filter, op3_warc, op4_html_text, op5_neardup, op6_token_files, op7_sharding,
    op8_decontaminate, op9_bpe, op10_quality, op11_phrases, op12_conversations,
    op13_repeats)}
