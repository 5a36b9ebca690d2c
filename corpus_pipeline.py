"""Corpus pipeline: the documents in stages, each of them one operator of ``trustmart.llm``.

Each stage reads what the one before has written and returns the columns of ``documents``; the last
returns packed pieces. Null texts, empty tables and repeated rows are treated as each operator says.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trustmart.llm import language_id, line_dedup, mixing, ngram_join, packing  # noqa: E402
from trustmart.llm.common import crc_remainder, scratch, table  # noqa: E402
from trustmart.llm.queries import tokenizer_path  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known; the model learns from rows it was not held out of."""
    model = language_id.train(docs, crc_remainder("doc_id", 4) != 2)
    found = language_id.identify(docs, model)
    return found.filter(~F.col("__language.rejected")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes long lines of five documents or more out of all but one."""
    return line_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies: five-word shingles, a similarity of 0.8 or
    more. The three words and 0.9 of ``op7`` bind that query only."""
    return ngram_join.without_copies(docs, size=5, threshold=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops, keeps or repeats whole documents so that sources come near their targets."""
    return mixing.mixed(docs, whole=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return packing.packing_digest(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language identification and tokenizing have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
