"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its distinct word shingles, as 64-bit hashes. Two permutations give all
``COORDINATES`` of its signature: the first spreads a hash over a circle of ``CIRCLE`` places, the
second, shifted round the circle by k, ranks the places for coordinate k. What a shingle at place p has
to say to all coordinates is therefore one stretch of the second permutation that ends at p, and a
signature is the least of such stretches, place by place.

Coordinates are cut into ``BANDS`` bands. Classes of equal sets go on as their smallest document;
classes that agree in a band share a bucket:

1. each bucket links its documents to one of them; pairs whose signatures are far from the threshold
   go, the others are compared by their whole sets;
2. what is linked is one component. Documents of a bucket that still holds several are written as what
   they differ in from a pivot, the shingles that most of a few of them have. Two sets that link and are far
   from the pivot differ from it in common shingles; how many is known from sizes, so documents of
   different components meet at shingles early in one order of the differences. Documents so near the
   pivot that nothing need be common all link to the nearest of them. Any set could be the pivot; with
   a good one fewer documents meet;
3. what met is verified, too, and the components put together.

A cloud of near copies, each with edits of its own, so costs rows as there are documents and not as
there are pairs: the edits come first in the order, and no other document has them.

No bucket is capped and no pair of different components that share a bucket is left out. Links are
exact, since they are taken from whole sets; a pair at a similarity of just 0.85 is missed by all bands
with a chance below 1e-6, a more similar one less often still.

Null and empty texts have no shingle and are linked with nothing; fewer words than a shingle are one
shingle; texts of any length count as a whole. Rows with the same id are one document, which is linked
with what any of its texts is linked with; each row gives the size of its own set. A row without id
has the component of rows with an equal set, or null. An empty table gives an empty result. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trustmart.llm.common import ship, stored
from trustmart.llm.components import components
from trustmart.llm.ngram_join import identity, mix, shingles
from trustmart.operators.joins import lookup

BANDS, WIDTH = 32, 6
COORDINATES = BANDS * WIDTH
#: Places of the circle: a power of two.
CIRCLE_BITS = 21
CIRCLE = 1 << CIRCLE_BITS
#: Shingles whose stretches are held at once.
AT_ONCE = 2048
#: A pair goes to verification if at least this share of the coordinates agrees. At a similarity of
#: 0.85 the share spreads by 0.026, so 0.70 is more than five times that below.
SLACK = 0.15
#: Documents from which a pivot is made. No link depends on it.
VOTERS = 9


@cache
def _second() -> np.ndarray:
    """The second permutation, lengthened so that a stretch may go past the end of the circle."""
    ranks = np.random.Generator(np.random.PCG64(20_231)).permutation(CIRCLE).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate((ranks, ranks[:COORDINATES])), COORDINATES)


def signature(x: np.ndarray) -> np.ndarray:
    """The coordinates of a set of hashes that is not empty.

    The stretch that begins at place p holds what the shingle there ranks under each shift.
    """
    place = np.unique(mix(x ^ np.uint64(0x6A09E667F3BCC909)) >> np.uint64(64 - CIRCLE_BITS)).astype(np.int64)
    stretches = _second()
    least = np.full(COORDINATES, CIRCLE, dtype=np.uint32)
    for at in range(0, len(place), AT_ONCE):
        np.minimum(least, stretches[place[at : at + AT_ONCE]].min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band; the band's number goes in."""
    rows = least.reshape(BANDS, WIDTH).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in rows.T:
        key = mix(key ^ column) * np.uint64(0x9E3779B97F4A7C15)
    return key.view(np.int64)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _per_document(docs: DataFrame, size: int, names: dict[str, pa.DataType], row) -> DataFrame:
    """One row for each document: its id and what ``row`` makes of its shingles. Texts are taken a few
    at a time, so that a task holds the results of few documents."""
    schema = pa.schema([("doc_id", pa.int64()), *names.items()])
    spelled = {"int64": "bigint", "list<item: int64>": "array<bigint>", "binary": "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                rows = [
                    (doc_id, *row(shingles(text or "", size)))
                    for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True)
                ]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

    ddl = ", ".join(f"{f.name} {spelled[str(f.type)]}" for f in schema)
    return _narrow(docs).mapInArrow(run, ddl)


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, f1, f2, keys): size and identity of each document's set and its bands."""

    def row(x: np.ndarray) -> tuple:
        return len(x), *identity(x), bands(signature(x)) if len(x) else None

    big = pa.int64()
    return _per_document(docs, size, {"n": big, "f1": big, "f2": big, "keys": pa.list_(big)}, row)


def whole_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, tokens, least): all shingles of each document, and its signature."""

    def row(x: np.ndarray) -> tuple:
        return x.view(np.int64), signature(x).astype("<u4").tobytes() if len(x) else None

    return _per_document(docs, size, {"tokens": pa.list_(pa.int64()), "least": pa.binary()}, row)


def _agreeing(pairs: DataFrame, share: float) -> DataFrame:
    """Pairs of which at least ``share`` of the coordinates agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype="<u4").reshape(-1, COORDINATES) for i in (2, 3)
            )
            near = (x == y).sum(axis=1) >= share * COORDINATES
            yield batch.select([0, 1]).filter(pa.array(near))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    for name, at in (("a", "x"), ("b", "y")):
        pairs = pairs.join(sets.select(F.col("doc_id").alias(name), F.col(column).alias(at)), name)
    return pairs.select("a", "b", "x", "y")


def sets_of(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Whole sets of the documents of these pairs, one row for each text of an id."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("__node")).distinct()
    nodes = stored(nodes, "pair-nodes")
    texts = _narrow(docs).join(nodes, F.col("doc_id") == F.col("__node"), "left_semi")
    return stored(whole_sets(texts.distinct(), size), "whole-sets")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of a written table that link by their whole sets. Sets move for pairs with like
    signatures only."""
    near = _agreeing(_sides(pairs, sets, "least"), threshold / 100 - SLACK).distinct()
    near = stored(near, "near-pairs")
    both = _sides(near, sets, "tokens")
    shared = F.size(F.array_intersect("x", "y"))
    alike = 100 * shared >= threshold * (F.size("x") + F.size("y") - shared)
    return both.filter(alike).select("a", "b").distinct()


def consensus(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """(__pivot, y): shingles that more than half of at most ``VOTERS`` documents of a pivot have."""
    schema = pa.schema([("__pivot", pa.int64()), ("y", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = []
            for voters in batch.column(1):
                found, votes = np.unique(voters.values.flatten().to_numpy(), return_counts=True)
                most.append(found[2 * votes > len(voters)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(most, schema[1].type)], schema=schema)

    # Spark limits the ranks before it shuffles.
    by_chance = F.row_number().over(W.partitionBy("pivot").orderBy(F.xxhash64("node"), "node"))
    voters = placed.select("pivot", "node").distinct().withColumn("nth", by_chance).filter(F.col("nth") <= VOTERS)
    # An id with several texts votes with one of them.
    x = sets.select(F.col("doc_id").alias("node"), F.col("tokens"))
    voters = voters.join(x, "node").groupBy("pivot", "node").agg(F.max("tokens").alias("x"))
    return voters.groupBy("pivot").agg(F.collect_list("x")).mapInArrow(run, "__pivot bigint, y array<bigint>")


def differences(placed: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(pivot, node, component, top, n, s, rank, first) for rows (pivot, node, component, top): n is the
    size of the node's set, s how many shingles are in only one of it and the pivot's.

    ``rank`` is (100 + threshold) * s - (100 - threshold) * n: two documents whose ranks sum to no more
    than 0 link whatever they differ in. ``first`` holds the first of these shingles, as many as any
    link can need: the document's own ones by value, then those it lacks.
    """
    at = ["pivot", "node", "component", "top"]
    big = pa.int64()
    schema = pa.schema([*((c, big) for c in at), ("n", big), ("s", big), ("rank", big), ("first", pa.list_(big))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for *keys, x, y in zip(*(batch.column(i) for i in range(6)), strict=True):
                own, pivot = (np.sort(v.values.to_numpy()) for v in (x, y))
                more, less = np.setdiff1d(own, pivot, True), np.setdiff1d(pivot, own, True)
                n, s = len(own), len(more) + len(less)
                first = np.concatenate((more, less))[: n * (100 - threshold) // threshold + 1]
                rank = (100 + threshold) * s - (100 - threshold) * n
                rows.append((*(k.as_py() for k in keys), n, s, rank, first))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
                )

    pivots = stored(consensus(placed, sets), "consensus")
    own = sets.filter(F.size("tokens") > 0).select(F.col("doc_id").alias("node"), F.col("tokens").alias("x"))
    both = lookup(placed.join(own, "node"), pivots, "pivot", "__pivot", "inner").select(*at, "x", "y")
    ddl = ", ".join(f"{c} bigint" for c in (*at, "n", "s", "rank"))
    return both.mapInArrow(run, f"{ddl}, first array<bigint>")


def meeting(differing: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of different components that may link: all that do and share a pivot are among
    them, or are joined by others that are. ``differing`` is a written table of :func:`differences`."""
    nearest = differing.groupBy("pivot").agg(F.min(F.struct("rank", "node", "component")).alias("m"))
    sure = lookup(differing, nearest.withColumnRenamed("pivot", "__pivot"), "pivot", "__pivot", "inner")
    sure = sure.filter((F.col("rank") + F.col("m.rank") <= 0) & (F.col("component") != F.col("m.component")))
    sure = sure.select(*_pair("node", "m.node"))

    shingle = differing.select("*", F.posexplode("first").alias("place", "shingle")).drop("first")
    x, y = shingle.filter("component <> top").alias("x"), shingle.alias("y")
    both = F.col("x.rank") + F.col("y.rank")
    common = F.ceil(both / (2 * (100 + threshold)))
    # A pair of two strangers comes up from both sides; one of them is enough.
    once = (F.col("y.component") == F.col("y.top")) | (F.col("x.node") < F.col("y.node"))
    met = x.join(
        y,
        (F.col("x.pivot") == F.col("y.pivot"))
        & (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.component") != F.col("y.component"))
        & once
        & (both > 0)
        & (F.col("x.place") <= F.col("x.s") - common)
        & (F.col("y.place") <= F.col("y.s") - common)
        & (threshold * F.col("x.n") <= 100 * F.col("y.n"))
        & (threshold * F.col("y.n") <= 100 * F.col("x.n")),
    )
    return met.select(*_pair("x.node", "y.node")).unionByName(sure).distinct()


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (whether the row
    is that document)."""
    ship(docs.sparkSession)
    sets = stored(sketched(docs, size), "sketched")
    whole = ["f1", "f2", "n"]
    # A class has the bands of any of its documents; one row for each class goes on.
    classes = sets.filter("n > 0 and doc_id is not null").groupBy(*whole)
    classes = stored(classes.agg(F.min("doc_id").alias("node"), F.any_value("keys").alias("keys")), "classes")
    places = classes.select("node", F.explode("keys").alias("key"))
    shared = places.groupBy("key").agg(F.count("*").alias("found"), F.min("node").alias("centre"))
    shared = shared.filter("found > 1").select(F.col("key").alias("__key"), "centre")
    buckets = stored(lookup(places, shared, "key", "__key", "inner"), "buckets")

    # An id with several texts links the classes of all of them.
    full = sets.filter("n > 0 and doc_id is not null")
    ids = full.groupBy("doc_id").agg(*[f(F.struct(*whole)).alias(f.__name__) for f in (F.min, F.max)])
    ids = full.join(ids.filter("min <> max").select("doc_id"), "doc_id", "left_semi")
    own = ids.join(classes.select("node", *whole), whole).select(*_pair("node", "doc_id")).distinct()

    stars = buckets.filter("node <> centre").select(*_pair("node", "centre")).distinct()
    stars = stored(stars, "star-pairs")
    whole_ones = sets_of(stars, docs, size)
    links = stored(verified(stars, whole_ones, threshold).unionByName(own), "star-links")
    joined = stored(components(links), "joined")

    component = F.coalesce("component", "node").alias("component")
    buckets = stored(buckets.join(joined, "node", "left").select("key", "node", component), "bucket-components")
    # Of each bucket: the largest of its components, if it has more than one.
    counted = buckets.groupBy("key", "component").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    largest = counted.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("top"))
    mixed = largest.filter("parts > 1").select(F.col("key").alias("__key"), F.col("top.component").alias("top"))
    # Buckets with the same largest component share a pivot, so that they are gone through once.
    pivots = counted.groupBy(F.col("component").alias("__top")).agg(F.min("node").alias("pivot"))
    mixed = lookup(buckets, mixed, "key", "__key", "inner").select("node", "component", "top").distinct()
    placed = stored(lookup(mixed, pivots, "top", "__top", "inner"), "placed")
    differing = stored(differences(placed, whole_ones, threshold), "differing")
    rest = meeting(differing, threshold).join(stars, ["a", "b"], "left_anti")
    more = stored(verified(stored(rest, "rest"), whole_ones, threshold), "more-links")
    final = stored(components(links.unionByName(more)), "final")

    labels = classes.drop("keys").join(final, "node", "left").select(*whole, component)
    found = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    rows = sets.select("doc_id", *whole).join(labels, whole, "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), found.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
