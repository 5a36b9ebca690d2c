"""Similarity join of documents on word shingles, filtered under several global token orders.

A document is the set of its distinct ``words`` word shingles, as 64-bit hashes. Two documents link
when 100 * intersection >= threshold * union. If two sets are that alike, then under any order of all
tokens the first token they share stands early in both: where ``i`` and ``j`` tokens stand before it,
``i + j`` is at most (100 - t) / (100 + t) of the two sizes. The join goes

1. equal sets become one class, known by its smallest document;
2. under a first order, classes that share an early token are candidates; the order puts tokens that
   fill hot hash buckets last, so that a passage of many documents hardly ever leads;
3. a candidate's parity sketches must not differ in more places than a link allows, first in small
   sketches of equal length, then in sketches that are as long as their sets are large;
4. candidates must share early tokens under ``ORDERS - 1`` further orders, too, and differ in few;
5. what is left is compared by its whole sets.

Not all pairs of a token are emitted. Each token first links its documents to one of them (a star);
what these links have joined is one component, and only pairs of different components that share a
token are looked at afterwards. No such pair is left out, so components are exact, but for equal
64-bit hashes of different shingles.

Null and empty texts have no shingle and are linked with nothing; a text with fewer words than a
shingle is one shingle. Rows with the same id are one document; a row without id has the component
of rows with an equal set, or null. An empty table gives an empty result. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustmart.llm.common import ship, stored, words
from trustmart.llm.components import components

#: Token orders: the first makes candidates, the others filter them.
ORDERS = 3
FURTHER = [f"p{i}" for i in range(1, ORDERS)]
#: Numbers of 64 bits in a sketch.
SKETCH = 8
SKETCHES = [f"s{i}" for i in range(SKETCH)]
#: Hash buckets in which the tokens of all documents are counted.
BUCKET_BITS = 17
#: Ids that may be sent to every task, 8 bytes each.
SENT_IDS = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted."""
    import xxhash

    found = words(text)
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), dtype=np.uint64, count=len(found))
    size = min(size, len(h))
    # The number of words goes in, so a short text is no shingle of a longer one.
    x = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for at in range(size):
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h[at : len(h) - size + 1 + at])
    return np.unique(x)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sum(x: np.ndarray) -> int:
    return int(_signed(np.array([x.sum(dtype=np.uint64)]))[0])


def identity(x: np.ndarray) -> tuple[int, int]:
    """128 bits that tell one set from another."""
    return _sum(mix(x + np.uint64(1))), _sum(mix(x ^ np.uint64(0x5851F42D4C957F2D)))


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, f1, f2) of each document, and (bucket, tokens): how full each task found each
    hash bucket. One pass over the texts gives both."""
    names = ["doc_id", "n", "f1", "f2", "bucket", "tokens"]
    schema = pa.schema([(name, pa.int64()) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = shingles(text or "", size)
                full += np.bincount(x >> np.uint64(64 - BUCKET_BITS), minlength=len(full))
                rows.append((doc_id, len(x), *identity(x), None, None))
            yield _batch(rows, schema)
        at = np.flatnonzero(full)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([none] * 4 + [pa.array(at), pa.array(full[at])], schema=schema)

    return _narrow(docs).mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def hot_levels(sets: DataFrame) -> np.ndarray:
    """For each hash bucket how far it is filled beyond what chance explains: 0 for nearly all.

    As many numbers as there are buckets reach the driver and go to every task.
    """
    counts = np.zeros(1 << BUCKET_BITS)
    sums = sets.filter("bucket is not null").groupBy("bucket").agg(F.sum("tokens").alias("n"))
    for r in sums.collect():
        counts[r["bucket"]] = r["n"]
    usual = np.median(counts)
    limit = usual + 6 * np.sqrt(usual) + 6
    return np.where(counts > limit, np.ceil(np.log2(np.maximum(counts - usual, 2))), 0).astype(np.uint64)


def in_order(x: np.ndarray, order: int, levels: np.ndarray, most: int) -> np.ndarray:
    """The ranks of the first ``most`` tokens of a set under a global order, ascending.

    A rank holds the level of the token's bucket and 56 bits of its hash for this order.
    """
    level = levels[(x >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
    rank = (mix(x + np.uint64(order * 7919 + 13)) >> np.uint64(8)) | (level << np.uint64(56))
    if most < len(x):
        rank = np.partition(rank, most - 1)[:most]
    return np.sort(rank)


def sketch(x: np.ndarray) -> list[int]:
    """Parities of the tokens over ``SKETCH`` times 64 places. Where two sketches differ, at least
    one token is in only one of the sets, so their distance never exceeds that of the sets."""
    place = (mix(x ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)) % np.uint64(64 * SKETCH)
    odd = np.bincount(place.astype(np.int64), minlength=64 * SKETCH).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).tolist()


def long_sketch(x: np.ndarray) -> np.ndarray:
    """Parities of the tokens over a power of two of places, between half and all of their number,
    but 64 at least. Its halves, one over the other, are the sketch over half as many places."""
    places = max(64, (1 << (len(x) - 1).bit_length()) // 2)
    place = (mix(x ^ np.uint64(0x9FB21C651E98DF25)) >> np.uint64(16)) & np.uint64(places - 1)
    odd = np.bincount(place.astype(np.int64), minlength=places).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def prefixes(docs: DataFrame, size: int, threshold: int, levels: np.ndarray) -> DataFrame:
    """(doc_id, f1, f2, n, s0, s1, ..., first): sketch and, under the first order, the ranks of the
    tokens that can be the first shared one."""
    names = ["doc_id", "f1", "f2", "n", *SKETCHES]
    schema = pa.schema([(name, pa.int64()) for name in names] + [("first", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = shingles(text or "", size)
                if doc_id is None or not len(x):
                    continue
                first = _signed(in_order(x, 0, levels, prefix_length(len(x), threshold)))
                rows.append((doc_id, *identity(x), len(x), *sketch(x), first))
            yield _batch(rows, schema)

    return _narrow(docs).mapInArrow(run, ", ".join(f"{n} bigint" for n in names) + ", first array<bigint>")


def prefix_length(n: int, threshold: int) -> int:
    return n - -(-threshold * n // 100) + 1


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, columns), strict=True)), schema=schema)


def long_sketches(docs: DataFrame, size: int) -> DataFrame:
    """(node, n, parities) of each document: its number of tokens and its long sketch."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("parities", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = shingles(text or "", size)
                if len(x):
                    rows.append((node, len(x), long_sketch(x)))
            yield _batch(rows, schema)

    return _narrow(docs).mapInArrow(run, "node bigint, n bigint, parities array<bigint>")


def whole_sets(docs: DataFrame, size: int, threshold: int, levels: np.ndarray) -> DataFrame:
    """(node, tokens, p1, p2, ...) of each document: all its tokens, and the ranks of the first ones
    under each further order."""
    names = ["tokens", *FURTHER]
    schema = pa.schema([("node", pa.int64())] + [(name, pa.list_(pa.int64())) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = shingles(text or "", size)
                most = prefix_length(len(x), threshold)
                first = [_signed(in_order(x, i, levels, most)) for i in range(1, ORDERS)]
                rows.append((node, _signed(x), *first))
            yield _batch(rows, schema)

    return _narrow(docs).mapInArrow(run, "node bigint" + "".join(f", {n} array<bigint>" for n in names))


def _early(i: str, j: str, n: str, m: str, t: int) -> str:
    """Whether two sizes and two places of a shared token leave room for a link."""
    return (
        f"({i} + {j}) * {100 + t} <= ({n} + {m}) * {100 - t}"
        f" and 100 * least({n}, {m}) >= {t} * greatest({n}, {m})"
    )


def _only(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is among the ids ``node`` of a written table; up to ``SENT_IDS`` of them are
    sent to every task, so that nothing else is shuffled."""
    if wanted.count() <= SENT_IDS:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, F.col(key) == F.col("node"), "left_semi")


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "pair-nodes")


def _both(pairs: DataFrame, sides: DataFrame) -> DataFrame:
    """Pairs (a, b) with the columns of their two nodes as structs x and y."""
    columns = F.struct(*[c for c in sides.columns if c != "node"])
    for name, at in (("a", "x"), ("b", "y")):
        pairs = pairs.join(sides.select(F.col("node").alias(name), columns.alias(at)), name)
    return pairs


def _near(x: str, y: str, threshold: int) -> str:
    """Whether the sketches of two nodes leave room for a link."""
    apart = " + ".join(f"bit_count({x}.{s} ^ {y}.{s})" for s in SKETCHES)
    return f"({apart}) * {100 + threshold} <= ({x}.n + {y}.n) * {100 - threshold}"


def _folded(x: str, y: str) -> str:
    """The long sketch of x over as many places as that of y, if it has more."""
    turned = f"aggregate(sequence(k, size({x}) - 1, size({y})), 0L, (s, j) -> s ^ {x}[j])"
    return f"if(size({x}) <= size({y}), {x}, transform(sequence(0, size({y}) - 1), k -> {turned}))"


def _near_in_full(threshold: int) -> str:
    """Whether the long sketches of x and y leave room for a link."""
    x, y = _folded("x.parities", "y.parities"), _folded("y.parities", "x.parities")
    apart = f"aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p ^ q)), 0, (s, c) -> s + c)"
    return f"{apart} * {100 + threshold}L <= (x.n + y.n) * {100 - threshold}"


def _verified(
    pairs: DataFrame, docs: DataFrame, size: int, threshold: int, levels: np.ndarray
) -> DataFrame:
    """Pairs (a, b) of a written table that pass the long sketches and the further orders and are
    alike as whole sets. Ranks and sets are worked out for the documents of near sketches only.

    Up to the smaller of two last ranks both prefixes are complete, so the tokens that only one of
    them has up to there are tokens that only one of the sets has.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = _only(narrow, "doc_id", _nodes_of(pairs))
    sketches = stored(long_sketches(texts, size), "long-sketches")
    near = _both(pairs, sketches).filter(_near_in_full(threshold))
    pairs = stored(near.select("a", "b").distinct(), "near-pairs")
    texts = _only(narrow, "doc_id", _nodes_of(pairs))
    sets = stored(whole_sets(texts, size, threshold, levels), "whole-sets")
    both = _both(pairs, sets.select("node", F.size("tokens").alias("n"), *FURTHER))
    for name in FURTHER:
        p, q = F.col(f"x.{name}"), F.col(f"y.{name}")
        last = F.least(F.element_at(p, -1), F.element_at(q, -1))
        p, q = F.filter(p, lambda r: r <= last), F.filter(q, lambda r: r <= last)
        common = F.size(F.array_intersect(p, q))
        apart = F.size(p) + F.size(q) - 2 * common
        room = apart * (100 + threshold) <= (F.col("x.n") + F.col("y.n")) * (100 - threshold)
        both = both.filter((common > 0) & room)
    # Whole sets move for what is left only.
    both = _both(stored(both.select("a", "b"), "candidates"), sets.select("node", "tokens"))
    x, y = F.col("x.tokens"), F.col("y.tokens")
    shared = F.size(F.array_intersect(x, y))
    alike = 100 * shared >= threshold * (F.size(x) + F.size(y) - shared)
    return both.filter(alike).select("a", "b").distinct()


def linked(docs: DataFrame, size: int = 3, threshold: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of each row: the smallest doc_id reachable by links."""
    spark = docs.sparkSession
    ship(spark)
    sets = stored(sets_of(docs, size), "sets")
    rows = sets.filter("bucket is null").select("doc_id", "n", "f1", "f2")
    classes = stored(
        rows.filter("n > 0 and doc_id is not null").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("node")),
        "classes",
    )
    levels = hot_levels(sets)
    firsts = prefixes(docs, size, threshold, levels).withColumnRenamed("doc_id", "node")
    nodes = stored(firsts.join(classes, ["node", "f1", "f2", "n"], "left_semi"), "nodes")
    sketches = nodes.select("node", "n", *SKETCHES)

    # Candidates under the first order. A token is of use if one of its documents has it early.
    heavy = F.col("i") * (100 + threshold) > F.col("n") * (100 - threshold)
    postings = nodes.select("node", "n", F.posexplode("first").alias("i", "token")).withColumn("heavy", heavy)
    centres = (
        postings.groupBy("token")
        .agg(F.count("*").alias("found"), F.min(F.struct("heavy", "node", "n", "i")).alias("c"))
        .filter("found > 1 and not c.heavy")
        .select("token", F.col("c.node").alias("c"), F.col("c.n").alias("cn"), F.col("c.i").alias("ci"))
    )
    shared = stored(postings.join(centres, "token"), "shared")

    def pairs_of(left: str, right: str) -> list:
        return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]

    stars = shared.filter("node <> c").filter(_early("i", "ci", "n", "cn", threshold))
    stars = stored(stars.select(*pairs_of("node", "c")).distinct(), "star-pairs")
    some = _only(sketches.withColumnRenamed("node", "id"), "id", _nodes_of(stars))
    stars = _both(stars, some.withColumnRenamed("id", "node")).filter(_near("x", "y", threshold))
    stars = stored(stars.select("a", "b"), "stars")
    links = stored(_verified(stars, docs, size, threshold, levels), "star-links")
    joined = stored(components(links), "joined")

    # Tokens whose documents are not in one component yet.
    component = F.coalesce("component", "node").alias("component")
    places = shared.join(joined, "node", "left").select("token", "node", "n", "i", "heavy", component)
    places = stored(places, "places")
    mixed = places.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    places = places.join(mixed.filter("x < y").select("token"), "token", "left_semi")
    places = stored(places.join(sketches.drop("n"), "node"), "mixed")
    left, right = places.filter("not heavy").alias("l"), places.alias("r")
    rest = left.join(
        right,
        (F.col("l.token") == F.col("r.token"))
        & (F.col("l.component") != F.col("r.component"))
        & F.expr(_early("l.i", "r.i", "l.n", "r.n", threshold))
        & F.expr(_near("l", "r", threshold)),
    )
    rest = rest.select(*pairs_of("l.node", "r.node")).distinct().join(stars, ["a", "b"], "left_anti")
    more = stored(_verified(stored(rest, "rest"), docs, size, threshold, levels), "more-links")
    final = stored(components(links.unionByName(more)), "final")

    labels = classes.join(final, "node", "left").select("f1", "f2", "n", component)
    return (
        rows.join(labels, ["f1", "f2", "n"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def without_copies(docs: DataFrame, **settings: int) -> DataFrame:
    """``docs`` with one document of each group of linked ones, that with the smallest id.

    All rows of that id stay; rows without id stay if no row has an equal set.
    """
    groups = linked(docs, **settings)
    gone = groups.filter("doc_id is not null and doc_id <> component_id").select("doc_id").distinct()
    key = F.col("doc_id").cast("bigint") == F.col("__gone")
    return docs.join(gone.withColumnRenamed("doc_id", "__gone"), key, "left_anti")
