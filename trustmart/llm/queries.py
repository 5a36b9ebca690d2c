"""The registered queries: each operator over its whole table, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustmart.llm import (
    ann,
    circulant_minhash,
    divergence,
    fingerprint,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    sql,
    surrogates,
    token_rollup,
)
from trustmart.llm.common import crc_remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_remainder("doc_id", 5) == 0
    model = quality.train(docs, labels, ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.score_column(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.full_totals(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The key of these queries; a user of the operator brings a secret one.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(docs, b"key of the registered query").withColumnRenamed("__replaced", "n_replaced")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_digest(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 4) == 2
    model = language_id.train(docs, ~held_out)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("__language.lang").alias("lang_pred"),
        F.col("__language.score").alias("score"),
        F.col("__language.rejected").alias("rejected"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_report(table(spark, sf_dir, "conversations"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_pii": op4_pii,
    "op5_packing": op5_packing,
    "op6_ann": op6_ann,
    "op7_ngram_join": op7_ngram_join,
    "op8_fingerprint": op8_fingerprint,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_minhash": op12_minhash,
    "op13_divergence": op13_divergence,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": sql.OP2,
    "op7_ngram_join": sql.OP7,
    "op9_mixing": sql.OP9,
    "op11_prefix_trie": sql.OP11,
    "op12_minhash": sql.OP12,
    "op13_divergence": sql.OP13,
}
