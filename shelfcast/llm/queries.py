"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    decontaminate,
    lexical,
    line_dedup,
    packing,
    pieces,
    pii,
    quality,
    secrets,
    sharding,
    simhash,
    topk,
    url_rules,
    whitening,
)
from shelfcast.llm.common import read

TOKENIZERS = os.environ.get("SHELFCAST_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the free id behind the ranks.
END_OF_TEXT = 50256
# The rules of the query contract.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.report(read(spark, d, "documents"))


def op2_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return pieces.encode(read(spark, d, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model", verify=True)


def op3_packing(spark: SparkSession, d: str) -> DataFrame:
    encoder = packing.RankEncoder(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return packing.pack(read(spark, d, "documents"), encoder, end=END_OF_TEXT)


def op4_url_filters(spark: SparkSession, d: str) -> DataFrame:
    return url_rules.judge(read(spark, d, "pages"), url_rules.rules_from(spark, URL_RULES))


def op5_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard(read(spark, d, "documents"))


def op6_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, d, "documents"))


def op7_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.leaks(read(spark, d, "documents"), read(spark, d, "benchmark")).drop("_th")


def op8_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(read(spark, d, "documents"))


def op9_secret_scans(spark: SparkSession, d: str) -> DataFrame:
    found, _ = secrets.scan(read(spark, d, "documents"))
    return secrets.digest(found)


def op10_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.digest(pii.scan(read(spark, d, "documents")))


def op11_top_k_search(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(read(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    return lexical.rank(read(spark, d, "documents"), read(spark, d, "benchmark"))


def op13_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(read(spark, d, "embeddings"))


REGISTERED = [
    op1_line_dedup, op2_sentencepiece, op3_packing, op4_url_filters, op5_sharding, op6_simhash,
    op7_decontamination, op8_quality_rules, op9_secret_scans, op10_pii, op11_top_k_search,
    op12_lexical_search, op13_whitening,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in REGISTERED}
