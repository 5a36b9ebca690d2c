"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns the unit vectors by a pseudo-rotation (three rounds of random signs and a fast
Hadamard transform) and gives a vector the nearest signed axis as its bucket. A query looks at the
buckets of its nearest axes in every table (multiprobe); everything found there is ranked by exact
Euclidean distance of the original vectors in double precision.

Vectors need not have unit length: they are lifted onto a sphere by one more component, which is
left out when all lengths agree. Equal vectors are one entry that keeps the ``neighbours + 1``
smallest ids, all that can ever be asked for. Buckets are cut into blocks of rows and of queries, so
a bucket that holds a third of all rows is many tasks; nothing in it is left out. A block hands on
its best entries only.

Rows whose vector is null, empty, all zero or holds null or non-finite components take no part, nor
do rows without an id. Vectors are compared with those of the same dimension. Repeated rows count
once. Fewer candidates than asked for give fewer rows; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustmart.llm.common import ship, stored


#: Queries by which the number of probes is measured, and the share of neighbours to be found.
SAMPLE, RECALL, MOST_PROBES = 64, 0.96, 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows; their number of columns is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        x = x.reshape(len(x), -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, table: int, hash_no: int, seed: int) -> np.ndarray:
    """Pseudo-rotation number (table, hash_no) of the rows, filled up to a power of two."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), size))
    y[:, : x.shape[1]] = x
    rng = np.random.default_rng([seed, table, hash_no, size])
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], size))
    return y


def lifted(x: np.ndarray, radius: float, even: bool) -> np.ndarray:
    """Rows on the unit sphere: divided by ``radius``, with the component that is missing."""
    if even:
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    scaled = x / radius
    rest = np.sqrt(np.clip(1 - (scaled**2).sum(axis=1, keepdims=True), 0, None))
    return np.concatenate([scaled, rest], axis=1)


def axes_by_nearness(y: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``probes`` nearest signed axes of each row, and how much each is farther than the first."""
    both = np.concatenate([y, -y], axis=1)
    probes = min(probes, both.shape[1])
    order = np.argsort(-both, axis=1, kind="stable")[:, :probes]
    values = np.take_along_axis(both, order, axis=1)
    return order, (values[:, :1] - values) ** 2


def buckets(x: np.ndarray, table: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """Bucket numbers of each row in one table, the own bucket first."""
    order, loss = axes_by_nearness(rotated(x, table, 0, seed), probes)
    for hash_no in range(1, hashes):
        y = rotated(x, table, hash_no, seed)
        more, extra = axes_by_nearness(y, probes)
        codes = order[:, :, None] * (2 * y.shape[1]) + more[:, None, :]
        total = (loss[:, :, None] + extra[:, None, :]).reshape(len(x), -1)
        best = np.argsort(total, axis=1, kind="stable")[:, :probes]
        order = np.take_along_axis(codes.reshape(len(x), -1), best, axis=1)
        loss = np.take_along_axis(total, best, axis=1)
    return order


def fit(embedding: Column) -> Column:
    """True for vectors that take part."""
    x = embedding.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def measured_probes(
    entries: DataFrame,
    asking: DataFrame,
    neighbours: int,
    tables: int,
    hashes: int,
    seed: int,
    radius: float,
    even: bool,
) -> int:
    """The least number of probes that finds ``RECALL`` of the exact neighbours of a few queries.

    ``SAMPLE`` queries are sent to all tasks; a task hands on its best entries for each of them.
    """
    sample = [
        (r["entry"], np.array(r["embedding"]))
        for r in asking.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).collect()
    ]

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, list] = {i: [] for i in range(len(sample))}
        for batch in batches:
            sizes = batch["embedding"].map(len).to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = np.stack(batch["embedding"].iloc[at].tolist())
                ids = batch["entry"].to_numpy()[at]
                for i, (own, v) in enumerate(sample):
                    if len(v) != size:
                        continue
                    d = np.sqrt(((x - v) ** 2).sum(axis=1))
                    near = np.argsort(d, kind="stable")[: neighbours + 1]
                    some = [(d[j], ids[j], x[j]) for j in near if ids[j] != own]
                    best[i] = sorted(best[i] + some, key=lambda e: e[:2])[:neighbours]
        rows = [(i, e[1], e[0], e[2]) for i, own in best.items() for e in own]
        yield pd.DataFrame(rows, columns=["q", "entry", "score", "embedding"])

    nth = F.row_number().over(W.partitionBy("q").orderBy("score", "entry"))
    found = (
        entries.select("entry", "embedding")
        .mapInPandas(exact, "q int, entry bigint, score double, embedding array<double>")
        .withColumn("nth", nth)
        .filter(F.col("nth") <= neighbours)
        .collect()
    )
    if not found:
        return 1
    needed = np.full(len(found), MOST_PROBES)
    sizes = np.array([len(r["embedding"]) for r in found])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        here = lifted(np.array([found[j]["embedding"] for j in rows]), radius, even)
        asks = lifted(np.stack([sample[found[j]["q"]][1] for j in rows]), radius, even)
        for t in range(tables):
            order = buckets(asks, t, hashes, MOST_PROBES, seed)
            hit = order == buckets(here, t, hashes, 1, seed)
            place = np.where(hit.any(axis=1), hit.argmax(axis=1) + 1, MOST_PROBES)
            needed[rows] = np.minimum(needed[rows], place)
    return int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))])


def nearest(
    vectors: DataFrame,
    is_query: Column,
    neighbours: int = 10,
    tables: int = 16,
    probes: int | None = None,
    hashes: int = 1,
    block_rows: int = 8192,
    block_queries: int = 2048,
    seed: int = 17,
) -> DataFrame:
    """The nearest rows of each query row: query_id, rank, vec_id, score (Euclidean distance).

    ``probes`` buckets are looked at in each table. Without it, their number is measured: the exact
    neighbours of ``SAMPLE`` queries are found by one pass over all entries, and the smallest number
    that finds the share ``RECALL`` of them is taken.
    """
    ship(vectors.sparkSession)
    rows = (
        vectors.filter(F.col("vec_id").isNotNull() & fit(F.col("embedding")))
        .select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
            is_query.alias("query"),
        )
        .distinct()
    )
    # Spark limits the ranks before it shuffles, so the copies of a vector never meet in one task.
    by_vector = W.partitionBy("embedding").orderBy("vec_id")
    entries = stored(
        rows.select("vec_id", "embedding")
        .withColumn("nth", F.row_number().over(by_vector))
        .filter(F.col("nth") <= neighbours + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")),
        "entries",
    ).withColumn("entry", F.col("ids")[0])
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v))
    span = entries.agg(F.max(norm).alias("most"), F.min(norm).alias("least")).first()
    radius, even = span["most"], not span["most"] or span["most"] - span["least"] < 1e-3 * span["most"]
    asking = rows.filter("query").select("embedding").distinct().join(
        entries.select("embedding", "entry"), "embedding"
    )

    if probes is None:
        probes = measured_probes(entries, asking, neighbours, tables, hashes, seed, radius, even)

    def dealt(frame: DataFrame, count: int) -> DataFrame:
        """One row for each table and probed bucket."""

        @F.pandas_udf("array<array<bigint>>")
        def spots(embeddings: pd.Series) -> pd.Series:
            out: list = [None] * len(embeddings)
            sizes = embeddings.map(len).to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = lifted(np.stack(embeddings.iloc[at].tolist()), radius, even)
                own = np.stack([buckets(x, t, hashes, count, seed) for t in range(tables)], axis=1)
                for i, spot in zip(at, own, strict=True):
                    out[i] = spot.tolist()
            return pd.Series(out)

        return (
            frame.withColumn("dim", F.size("embedding"))
            .select("*", F.posexplode(spots("embedding")).alias("tab", "spots"))
            .withColumn("bucket", F.explode("spots"))
            .drop("spots")
        )

    key = ["dim", "tab", "bucket"]
    cell = [*key, "row_block", "query_block"]
    stock = stored(dealt(entries.select("embedding", "entry"), 1), "buckets")
    probe = stored(dealt(asking, probes), "probes")
    # Blocks in each bucket, by what it holds: one row for each bucket.
    sizes = stock.groupBy(*key).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("row_blocks"))
    asked = probe.groupBy(*key).agg(F.ceil(F.count("*") / block_queries).cast("int").alias("query_blocks"))
    blocks = sizes.join(asked, key)
    place = F.xxhash64("entry")
    left = (
        stock.join(blocks, key)
        .withColumn("row_block", F.pmod(place, F.col("row_blocks")).cast("int"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select(*cell, "entry", "embedding")
    )
    right = (
        probe.join(blocks, key)
        .withColumn("query_block", F.pmod(place, F.col("query_blocks")).cast("int"))
        .withColumn("row_block", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
        .select(*cell, "entry", "embedding")
    )
    schema = T.StructType.fromDDL("asks bigint, entry bigint, score double")

    def best(stock: pd.DataFrame, probe: pd.DataFrame) -> pd.DataFrame:
        asks, found, scores = [], [], []
        if len(stock) and len(probe):
            x = np.stack(stock["embedding"].tolist())
            ids = stock["entry"].to_numpy()
            for q, v in zip(probe["entry"], probe["embedding"], strict=True):
                d = np.sqrt(((x - v) ** 2).sum(axis=1))
                if len(d) > neighbours + 1:
                    # All that are as near as the last one wanted; ties are settled by id below.
                    limit = np.partition(d, neighbours)[neighbours]
                    near = np.flatnonzero(d <= limit)
                else:
                    near = np.arange(len(d))
                near = near[np.lexsort((ids[near], d[near]))][: neighbours + 1]
                asks += [q] * len(near)
                found += ids[near].tolist()
                scores += d[near].tolist()
        return pd.DataFrame({"asks": asks, "entry": found, "score": scores}).astype(
            {"asks": "int64", "entry": "int64", "score": "float64"}
        )

    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(best, schema)
    # The query's own entry may be among the best, so one more is kept until ids are known.
    near = W.partitionBy("asks").orderBy("score", "entry")
    found = (
        found.groupBy("asks", "entry")
        .agg(F.min("score").alias("score"))
        .withColumn("nth", F.row_number().over(near))
        .filter(F.col("nth") <= neighbours + 1)
        .join(entries.select("entry", "ids"), "entry")
        .select("asks", "score", F.explode("ids").alias("vec_id"))
        .withColumn("nth", F.row_number().over(W.partitionBy("asks").orderBy("score", "vec_id")))
        .filter(F.col("nth") <= neighbours + 1)
        .groupBy("asks")
        .agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near"))
    )
    queries = (
        rows.filter("query")
        .join(entries.select("embedding", F.col("entry").alias("asks")), "embedding")
        .select(F.col("vec_id").alias("query_id"), "asks")
    )
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, neighbours)
    return (
        queries.join(found, "asks")
        .select("query_id", F.posexplode(others).alias("at", "x"))
        .select(
            "query_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("x.vec_id").alias("vec_id"),
            F.col("x.score").alias("score"),
        )
    )
