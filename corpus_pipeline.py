"""A corpus pipeline: known languages, no repeated lines, no near-duplicates, packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of docs. Null and empty texts go at the first stage, which also needs a letter in each text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sketchloom.llm.common import table, written
from sketchloom.llm.language_id import language_stage
from sketchloom.llm.line_dedup import line_dedup_stage
from sketchloom.llm.minhash import near_dedup_stage
from sketchloom.llm.packing import pack


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_stage(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup_stage(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup_stage(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", known_language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("packing", packing)]

#: Context trees, weighted signatures and a tokenizer have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each stage's rows are written before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
