"""Line de-duplication over levelled sorted runs of line hashes.

A run is a Parquet folder of rows (h1, h2, n_docs, keeper), sorted by hash inside each file and dealt
by hash over its files: for each line key, in how many documents of its batches it was found and the
largest id among them. A batch adds one run to level 0; as soon as a level holds ``fanout`` runs they
are merged into one run of the next level, so that n batches cost O(n log n) row copies and at most
``fanout - 1`` runs per level are read. Counts add up and ids take the maximum, so the order of
batches and merges changes nothing.

Line keys are held as two 64-bit hashes. Keys shorter than ``min_chars`` code points are never
dropped. Null texts are one empty line; rows with the same id are one document; an empty table gives
an empty result; other columns are carried along by :func:`mark_lines` untouched.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustmart.llm.common import SPACE, scratch, stored, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "h1 bigint, h2 bigint, n_docs bigint, keeper bigint"


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(SPACE)), UPPER, LOWER)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(40503), key)


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h1, h2): one row for each line whose key is long enough."""
    lines = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.explode(F.split(text_of(), "\n", -1)).alias("line"),
    )
    # Trimming only shortens a line, so most short lines go before their key is made.
    keys = lines.filter(F.length("line") >= min_chars).select("doc_id", line_key(F.col("line")).alias("key"))
    h1, h2 = _hashes(F.col("key"))
    return keys.filter(F.length("key") >= min_chars).select("doc_id", h1.alias("h1"), h2.alias("h2"))


def run_of(lines: DataFrame) -> DataFrame:
    """A batch's own run. A key of very many documents is summed before it is shuffled."""
    return lines.groupBy("h1", "h2").agg(
        F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper")
    )


class LineRuns:
    """The levels of runs under one root folder; any session can go on where another stopped.

    ``manifest`` lists the live runs. It is itself a small table of which each change writes a new
    version, so a lost job leaves the former version in force.
    """

    def __init__(self, spark: SparkSession, root: str, fanout: int = 4):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout

    def _path(self, *parts: object) -> str:
        return "/".join([self.root, *map(str, parts)])

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def manifest(self) -> tuple[int, list[tuple[int, str]]]:
        """Newest version and its live runs as (level, name)."""
        version = 0
        while self._exists(self._path("manifest", version + 1, "_SUCCESS")):
            version += 1
        if not version:
            return 0, []
        rows = self.spark.read.schema("level int, name string").json(self._path("manifest", version)).collect()
        return version, sorted((r.level, r.name) for r in rows)

    def _publish(self, version: int, runs: list[tuple[int, str]]) -> None:
        rows = self.spark.createDataFrame(runs, "level int, name string").coalesce(1)
        rows.write.mode("overwrite").json(self._path("manifest", version))

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(*[self._path("runs", n) for n in names])

    def _write(self, name: str, run: DataFrame) -> None:
        run.sortWithinPartitions("h1", "h2").write.mode("overwrite").parquet(self._path("runs", name))

    @staticmethod
    def _merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy("h1", "h2").agg(
            F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper")
        )

    def totals(self) -> DataFrame:
        """All runs merged: one row for each key seen so far."""
        _, live = self.manifest()
        if not live:
            return self.spark.createDataFrame([], RUN)
        return self._merged(self._read([name for _, name in live]))

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The lines of a new batch whose key is in no run: a merge anti join of sorted runs."""
        return lines.join(self.totals().select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")

    def add(self, lines: DataFrame) -> None:
        """Adds a batch's own run, then merges every level that is full."""
        version, live = self.manifest()
        name = f"v{version + 1}-l0"
        self._write(name, run_of(lines))
        levels: dict[int, list[str]] = defaultdict(list)
        for level, run in [*live, (0, name)]:
            levels[level].append(run)
        level = 0
        while len(levels[level]) >= self.fanout:
            merged = f"v{version + 1}-l{level + 1}"
            self._write(merged, self._merged(self._read(levels.pop(level))))
            level += 1
            levels[level].append(merged)
        self._publish(version + 1, [(k, n) for k, names in sorted(levels.items()) for n in names])

    def process(self, batch: DataFrame, min_chars: int = 40) -> DataFrame:
        """Incremental use: the batch's long lines that no earlier batch had, as (doc_id, h1, h2).

        They are settled before the batch adds its own keys.
        """
        lines = stored(long_lines(batch, min_chars), "batch-lines")
        fresh = stored(self.unseen(lines), "fresh-lines")
        self.add(lines)
        return fresh


def mark_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 4
) -> DataFrame:
    """``docs`` with ``__lines`` (all lines) and ``__kept`` (those that stay).

    A key of at least ``min_chars`` code points that ``min_docs`` documents or more hold stays in the
    largest ``doc_id`` holding it and loses its lines everywhere else. The documents go through the
    runs in ``batches``; a document is in one batch as a whole, so counts add up. Texts are read
    twice and shuffled once, to meet their own dropped keys.
    """
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    staged = scratch(spark, "lines")
    long_lines(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(staged)
    lines = spark.read.schema("doc_id bigint, h1 bigint, h2 bigint, batch int").parquet(staged)
    runs = LineRuns(spark, scratch(spark, "runs"), fanout)
    for number in range(batches):
        runs.add(lines.filter(F.col("batch") == number).drop("batch"))
    repeated = runs.totals().filter(F.col("n_docs") >= min_docs)
    drops = (
        lines.drop("batch")
        .join(repeated, ["h1", "h2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("__drop"))
        .withColumnRenamed("doc_id", "__doc")
    )
    marked = docs.join(drops, F.col("doc_id").cast("bigint") == F.col("__doc"), "left")

    def stays(line: Column) -> Column:
        h1, h2 = _hashes(line_key(line))
        short = F.length(line) < min_chars
        return short | ~F.array_contains("__drop", F.struct(h1.alias("h1"), h2.alias("h2")))

    lines_of = F.split(text_of(), "\n", -1)
    return (
        marked.withColumn("__lines", lines_of)
        .withColumn(
            "__kept",
            F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(F.filter("__lines", stays)),
        )
        .drop("__drop", "__doc")
    )


def deduplicated(docs: DataFrame, **settings: int) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` and ``n_chars`` counted anew."""
    columns = docs.columns
    clean = mark_lines(docs, **settings).withColumn(
        "text", F.when(F.col("text").isNotNull(), F.array_join("__kept", "\n"))
    )
    if "n_chars" in columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*columns)


def line_digest(docs: DataFrame, **settings: int) -> DataFrame:
    """Counts of lines and the hash of the kept text of each document."""
    return mark_lines(docs.select("doc_id", "text"), **settings).select(
        "doc_id",
        F.size("__lines").cast("bigint").alias("n_lines"),
        (F.size("__lines") - F.size("__kept")).cast("bigint").alias("n_dropped"),
        F.sha2(F.array_join("__kept", "\n").cast("binary"), 256).alias("kept_sha256"),
    )
