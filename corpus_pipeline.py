"""The corpus pipeline: documents in, token ids of the good and distinct ones out.

Each stage takes (spark, docs, sf_dir) and calls one operator of ``shelfcast.llm``. Its result is written
as Parquet and read again as the next stage's documents. All stages but the last return the columns of
``documents``. What goes: documents that the quality rules reject; lines that repeat an earlier line, or
are a word away from one; all but one document of a group of near-duplicates; documents that
show a benchmark item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import decontaminate, line_dedup, pieces, quality, simhash
from shelfcast.llm.common import read, stage
from shelfcast.llm.queries import TOKENIZERS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, f"{TOKENIZERS}/piece_bpe_32k.model", verify=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", sentencepiece),
]

# Fingerprints and tokenisation have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
