"""Token counts as delta-maintained rollups.

Totals of documents and tokens by source, language and tokenizer version are never counted anew:
each batch of changes becomes a few signed rows that are added to them. An insert adds its counts, a
delete takes them away, a revision takes the old ones away and adds the new ones, under another
source, language or version if those have changed.

A batch has an id. Its summed rows are written under that id, and the batch counts from the moment
its folder is complete; a batch that is committed again, or again after a lost job, changes nothing
more. ``compact`` folds committed batches into one base of the next version.

Changes with a null kind or an unknown one are an error; null sources and languages are keys of their
own; null counts are 0; repeated rows count each time; an empty batch is committed without rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustmart.llm import packing
from trustmart.llm.common import scratch, ship, stored, text_of
from trustmart.llm.mixing import n_words

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, documents bigint, tokens bigint"


def signed(changes: DataFrame) -> DataFrame:
    """The rows of ``DELTA`` for changes (kind, source, lang, tokenizer, tokens, and for revisions
    old_source, old_lang, old_tokenizer, old_tokens), before they are summed."""
    kind = F.col("kind")
    known = F.coalesce(kind.isin("insert", "delete", "revise"), F.lit(False))
    kind = F.when(known, kind).otherwise(F.raise_error(F.lit("a change must be insert, delete or revise")))

    def row(sign: int, prefix: str):
        tokens = F.coalesce(F.col(f"{prefix}tokens").cast("bigint"), F.lit(0))
        return F.struct(
            *[F.col(f"{prefix}{k}").cast("string").alias(k) for k in KEYS],
            F.lit(sign).cast("bigint").alias("documents"),
            (sign * tokens).alias("tokens"),
        )

    rows = (
        F.when(kind == "insert", F.array(row(1, "")))
        .when(kind == "delete", F.array(row(-1, "")))
        .otherwise(F.array(row(1, ""), row(-1, "old_")))
    )
    for column in [f"old_{k}" for k in [*KEYS, "tokens"]]:
        if column not in changes.columns:
            changes = changes.withColumn(column, F.lit(None).cast("string"))
    return changes.select(F.explode(rows).alias("d")).select("d.*")


def summed(deltas: DataFrame) -> DataFrame:
    """Summed by key before the shuffle, so a hot source is a few rows."""
    return deltas.groupBy(*KEYS).agg(
        F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
    )


class TokenRollup:
    """Totals under one root folder. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = lambda *parts: path("/".join([self.root, *parts]))
        self._fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _folders(self, kind: str) -> list[str]:
        """Names of the complete folders of a kind."""
        if not self._fs.exists(self._path(kind)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(kind))]
        return sorted(n for n in names if self._fs.exists(self._path(kind, n, "_SUCCESS")))

    def _base(self) -> tuple[str | None, set[str]]:
        """Newest base and the batches it holds."""
        bases = self._folders("held")
        if not bases:
            return None, set()
        held = self.spark.read.schema("batch string").json(f"{self.root}/held/{bases[-1]}").collect()
        return bases[-1], {r["batch"] for r in held}

    def committed(self) -> set[str]:
        return self._base()[1] | set(self._folders("batches"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch; False if it was there already."""
        if not batch or "/" in batch or batch.startswith(("_", ".")):
            raise ValueError(f"not usable as a batch id: {batch!r}")
        if batch in self.committed():
            return False
        # Overwriting clears what a lost job has left under this id.
        summed(signed(changes)).write.mode("overwrite").parquet(f"{self.root}/batches/{batch}")
        return True

    def totals(self) -> DataFrame:
        """Totals of all committed batches; keys without a document or token are left out."""
        base, held = self._base()
        parts = [f"{self.root}/batches/{b}" for b in self._folders("batches") if b not in held]
        if base:
            parts.append(f"{self.root}/bases/{base}")
        if not parts:
            return self.spark.createDataFrame([], DELTA)
        rows = summed(self.spark.read.schema(DELTA).parquet(*parts))
        return rows.filter("documents <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Folds all committed batches into a new base, which counts once its list is written."""
        base, _ = self._base()
        name = f"{int(base or 0) + 1:012d}"
        batches = sorted(self.committed())
        self.totals().write.mode("overwrite").parquet(f"{self.root}/bases/{name}")
        held = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        held.coalesce(1).write.mode("overwrite").json(f"{self.root}/held/{name}")


def counted(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, source, lang, words, tokens, h1, h2): counts and two hashes of each text (null for a
    null text), in one pass; the texts themselves are not kept."""
    ship(docs.sparkSession)
    names = ["doc_id", "source", "lang", "words", "h1", "h2"]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("source", pa.string()), ("lang", pa.string())]
        + [(n, pa.int64()) for n in ("words", "h1", "h2", "tokens")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = packing.coder(tokenizer_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(6).to_pylist()]
            tokens = pa.array([len(ids) // 4 for ids in coder.encode(texts)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], tokens], schema=schema)

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        n_words(text_of()).alias("words"),
        # A null text repeats no other; a hash of null is the seed, the same for all of them.
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("h1"),
        F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(9176), "text")).alias("h2"),
        F.col("text").cast("string").alias("text"),
    )
    kinds = {"doc_id": "bigint", "source": "string", "lang": "string"}
    ddl = ", ".join(f"{n} {kinds.get(n, 'bigint')}" for n in [*names, "tokens"])
    return narrow.mapInArrow(run, ddl)


def corpus_totals(docs: DataFrame, tokenizer_path: str, name: str = "word_bpe_49k") -> DataFrame:
    """Totals in which each text counts once, for the document with the smallest id that has it,
    under the versions "words:1" (words between white space) and ``name``:1."""
    versions = {"words": "words:1", "tokens": f"{name}:1"}
    return _maintained(docs, tokenizer_path, f"{name}:estimate", {}, versions)


def full_totals(docs: DataFrame, tokenizer_path: str, name: str = "word_bpe_49k") -> DataFrame:
    """Totals over all rows under "words:1" and ``name``:1. The totals in which each text counts once
    stand beside them, under versions of their own: "words:1:distinct" and ``name``:1:distinct."""
    versions = {"words": "words:1", "tokens": f"{name}:1"}
    distinct = {kind: f"{version}:distinct" for kind, version in versions.items()}
    return _maintained(docs, tokenizer_path, f"{name}:estimate", versions, distinct)


def _maintained(
    docs: DataFrame, tokenizer_path: str, estimate: str, full: dict[str, str], distinct: dict[str, str]
) -> DataFrame:
    """Totals maintained through three batches. ``full`` and ``distinct`` name the versions of the
    counts "words" and "tokens".

    ``load`` inserts each document with its words and, as an estimate by the number of words, under
    the version ``estimate``; ``revise`` replaces the estimates by the tokenizer's own counts under
    its final version; ``copies`` deletes from the versions ``distinct`` the documents that repeat
    the text of a document with a smaller id.
    """
    spark = docs.sparkSession
    counts = stored(counted(docs, tokenizer_path), "counts")
    rollup = TokenRollup(spark, scratch(spark, "rollup"))
    kinds = [of for of in (full, distinct) if of]

    def under(*rows: tuple[str, str]):
        return F.explode(F.array(*[F.struct(F.lit(v).alias("tokenizer"), F.col(c).alias("tokens")) for v, c in rows]))

    # Estimates of the two kinds of totals are one version, of which each row takes its own away.
    versions = under(*[row for of in kinds for row in ((of["words"], "words"), (estimate, "words"))])
    load = counts.select("source", "lang", versions.alias("v")).select("source", "lang", "v.*")
    rollup.commit("load", load.withColumn("kind", F.lit("insert")))
    revise = counts.select(
        F.lit("revise").alias("kind"),
        "source",
        "lang",
        F.explode(F.array(*[F.lit(of["tokens"]) for of in kinds])).alias("tokenizer"),
        "tokens",
        F.col("source").alias("old_source"),
        F.col("lang").alias("old_lang"),
        F.lit(estimate).alias("old_tokenizer"),
        F.col("words").alias("old_tokens"),
    )
    rollup.commit("revise", revise)
    # The smallest id of each text is found by sums before the shuffle; a text of very many copies is
    # one row there, and the join back can be split. Rows that share the smallest id all stay.
    texts = counts.filter("h1 is not null")
    first = texts.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    copies = texts.join(first.filter("n > 1"), ["h1", "h2"]).filter("doc_id <> first")
    gone = copies.select(
        F.lit("delete").alias("kind"),
        "source",
        "lang",
        under((distinct["words"], "words"), (distinct["tokens"], "tokens")).alias("v"),
    )
    rollup.commit("copies", gone.select("kind", "source", "lang", "v.*"))
    rollup.compact()
    return rollup.totals()
