"""Incremental de-duplication: the winning row of each key, kept in buckets and merged batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustmart.operators.dedupe import asc_last
from trustmart.operators.staging import Rule
from trustmart.sources.versions import StaleCommit, VersionFiles

__all__ = ["KeyedWinners", "StaleCommit", "merged_in_batches"]

BUCKET, PART = "__bucket", "__part"
#: Rows that a batch may have in its fullest bucket above the mean of all buckets and still be dealt by bucket.
MOST_ROWS = 5_000_000


class KeyedWinners:
    """The rows that win under ``rule`` among all rows of all committed batches.

    Keys are hashed into ``buckets``. A commit reads the buckets that its batch touches, merges them
    with the batch and writes these buckets anew into a folder of its own; the others stay where they
    are. A manifest, one small file for each commit, names the folder of each bucket and every batch
    that is in; it is created only if nobody else has created that version, so of two commits at once
    one raises ``StaleCommit`` and leaves nothing behind that anyone reads. A batch that is in already
    changes nothing.

    The rule's order is made total by the remaining columns, so batches in any order, cut in any way,
    give the rows of one run over everything, and a batch may hold copies. Rows are shuffled once, to
    the task that merges their part of a bucket and writes it; a bucket has as many parts as give every
    shuffle partition of the session a task. Where a key has so many rows that the fullest bucket of a
    batch lies more than ``most_rows`` above the mean, rows are shuffled by key instead, of which each
    task sends one row a key at most, and once more into files of their bucket, split by size.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema, rule: Rule, buckets: int = 64, most_rows: int = MOST_ROWS
    ):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.rule, self.buckets, self.most_rows = rule, buckets, most_rows
        self.manifest = VersionFiles(spark, f"{self.root}/manifest")

    # --- manifest ---

    def version(self) -> int:
        return self.manifest.newest()[0]

    def state(self) -> tuple[int, dict[int, int], list[str]]:
        """Newest version; the version whose folder holds each bucket; the batches that are in. A commit
        that is being written is waited for.

        As many entries as there are buckets and batches reach the driver.
        """
        return self._state(to_write=True)

    def _state(self, to_write: bool) -> tuple[int, dict[int, int], list[str]]:
        version, text = self.manifest.newest(to_write)
        where, batches = {}, []
        for line in (text or "").splitlines():
            kind, _, rest = line.partition(" ")
            if kind == "bucket":
                bucket, _, at = rest.partition(" ")
                where[int(bucket)] = int(at)
            else:
                batches.append(rest)
        return version, where, batches

    def _publish(self, version: int, where: dict[int, int], batches: list[str]) -> None:
        lines = [f"bucket {b} {v}" for b, v in sorted(where.items())] + [f"batch {b}" for b in batches]
        self.manifest.create(version, "\n".join(lines))

    # --- rows ---

    def _read(self, where: dict[int, int]) -> DataFrame:
        if not where:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/rows/v{v:09d}/{BUCKET}={b}" for b, v in sorted(where.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rows(self) -> DataFrame:
        """The winners of all batches so far."""
        return self._read(self._state(to_write=False)[1])

    def commit(self, batch_id: str, batch: DataFrame) -> bool:
        """Merges a batch of rows of ``schema``; False if a batch of that name is in already."""
        if "\n" in batch_id:
            raise ValueError("a batch's name is one line")
        version, where, batches = self.state()
        if batch_id in batches:
            return False
        bucket = F.pmod(F.xxhash64(*self.rule.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)
        own = batch.select(*self.schema.names)
        # At most ``buckets`` rows reach the driver.
        counted = own.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).collect()
        touched = sorted(r[BUCKET] for r in counted)
        if touched:
            known = self._read({b: where[b] for b in touched if b in where})
            extra = max(r["n"] for r in counted) - sum(r["n"] for r in counted) // self.buckets
            merged = (self._by_bucket if extra <= self.most_rows else self._by_key)(known.unionByName(own), bucket)
            folder = f"{self.root}/rows/v{version + 1:09d}"
            # A folder that a lost or beaten commit has left is written over.
            merged.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        self._publish(version + 1, {**where, **dict.fromkeys(touched, version + 1)}, [*batches, batch_id])
        return True


    def _winners(self, rows: DataFrame, *also: str) -> DataFrame:
        order = lambda: [*self.rule.order(), *[asc_last(c) for c in self.schema.names]]
        return Rule((*self.rule.keys, *also), order).winners(rows)

    def _by_key(self, rows: DataFrame, bucket: Column) -> DataFrame:
        return self._winners(rows).select("*", bucket).hint("rebalance", BUCKET)

    def _by_bucket(self, rows: DataFrame, bucket: Column) -> DataFrame:
        parts = -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        part = F.pmod(F.xxhash64(F.lit(PART), *self.rule.keys), F.lit(parts)).cast("int")
        placed = rows.select("*", bucket).withColumn(PART, F.col(BUCKET) * parts + part)
        # A key lies in one part, so the part beside it changes no group, and Spark shuffles no more.
        dealt = placed.repartitionById(self.buckets * parts, F.col(PART))
        return self._winners(dealt, PART).drop(PART)


def merged_in_batches(winners: KeyedWinners, batches: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The winners after all of ``batches``, each under its name."""
    for name, rows in batches:
        winners.commit(name, rows)
    return winners.rows()
