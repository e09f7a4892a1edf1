"""Registered queries of the corpus operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollstone.llm import (
    bpe,
    brown_lm,
    chat_format,
    decision_list,
    hard_negatives,
    list_join,
    maxscore,
    merkle,
    packing,
    page_diff,
    pivot_neardup,
    sharding,
    suffix_dedup,
)
from pollstone.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.dedup_substrings(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op3_brown_lm(spark: SparkSession, folder: str) -> DataFrame:
    return brown_lm.score_documents(table(spark, folder, "documents"))


def op4_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.search_every(table(spark, folder, "embeddings"))


def op5_page_diff(spark: SparkSession, folder: str) -> DataFrame:
    return page_diff.extract(table(spark, folder, "pages"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, folder, "documents"), path).drop("bucket", "body")


def op7_simhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    found = pivot_neardup.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return decision_list.quality_rows(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return list_join.verdicts(list_join.captures_of(pages), list_join.entries_of(pages), fetched="fetched_on")


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.formatted_digests(table(spark, folder, "conversations"))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audit(table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine_every(table(spark, folder, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_sharding,
        op3_brown_lm,
        op4_maxscore,
        op5_page_diff,
        op6_packing,
        op7_simhash_neardup,
        op8_quality_rules,
        op9_url_lists,
        op10_bpe,
        op11_chat_format,
        op12_merkle,
        op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op2_sharding": sharding.ORACLE,
    "op4_maxscore": maxscore.ORACLE,
    "op9_url_lists": list_join.ORACLE,
    "op11_chat_format": chat_format.ORACLE,
    "op12_merkle": merkle.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
