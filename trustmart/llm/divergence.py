"""Audit of how far the sources of a language diverge in their use of words.

Counts are made by single-pass in-memory indexing:

1. a task reads its documents once and builds a block of postings (language, source, term) in memory;
   when the block is full it is sorted by term and spilled as a run, cut by hash of language and term
   into shards and into chunks;
2. each shard merges its chunks with a heap: chunks come in order of their first term, and only those
   that have begun are held; terms in enough documents of their language go on as frequencies;
3. a term's share in a group is ``1 + floor(10^9 * (count + 5) / (N + 5 * V))``. For two sources of a
   language the shares' differences add up as if no term occurred in either, corrected for the terms
   that one of them has (running sums over its counts) and, streamed term by term, for those that both
   have. Pairs of sources without a common term cost nothing per term.

All sums are of integers, so results do not depend on the order of tasks. A task holds one block, or
one chunk of each run, or ``TILES`` tiles of pair sums; per term no more than its sources are gathered.

Null text, language and source count as ''. A very long text is taken in pieces. Repeated rows are
documents of their own, whatever their id, which is not read; nor are further columns. Sources without
a kept term have the share of no occurrence; a language without kept terms has pairs of value 0. Equal
values are ranked by item. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trustmart.llm.common import ship, stored

#: Letters A-Z become small; bytes that are no letter and not part of a further character are blank.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: Bytes of a block of postings in memory, and of one posting, as estimated; postings of a chunk; bytes
#: of text at once.
BLOCK_BYTES, POSTING_BYTES = 96_000_000, 300
CHUNK = 4096
PIECE = 1 << 20
#: Pair sums that a task holds: tiles of so many sources by as many.
TILE, TILES = 256, 48
SCALE, PRIOR = 1_000_000_000, 5


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, a long one in pieces."""
    data = text.encode("utf-8").translate(LETTERS)
    at = 0
    while at < len(data):
        end = len(data) if at + PIECE >= len(data) else data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


#: A chunk of a run: distinct terms in order (a term holds no line break), how many postings each has,
#: the chunk's sources, and by posting: number of the source, occurrences, documents.
RUN = "shard int, lang string, first string, terms string, sizes binary, sources array<string>, postings binary"
RUN_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()),
        ("lang", pa.string()),
        ("first", pa.string()),
        ("terms", pa.string()),
        ("sizes", pa.binary()),
        ("sources", pa.list_(pa.string())),
        ("postings", pa.binary()),
    ]
)


def chunks_of(lang: str, groups: dict[str, tuple[Counter, Counter]], shards: int) -> Iterator[tuple]:
    """A language's part of a block, {source: (occurrences, documents) of each term}, as chunks."""
    cut: dict[int, list[tuple]] = defaultdict(list)
    seed = zlib.crc32(lang.encode())
    for source, (counts, docs) in groups.items():
        for term, n in counts.items():
            cut[zlib.crc32(term, seed) % shards].append((term, source, n, docs[term]))
    for shard, flat in sorted(cut.items()):
        flat.sort()
        for at in range(0, len(flat), CHUNK):
            terms, sources, counts, docs = zip(*flat[at : at + CHUNK], strict=True)
            sizes = Counter(terms)
            number = {s: i for i, s in enumerate(dict.fromkeys(sources))}
            postings = np.array([[number[s] for s in sources], counts, docs], dtype="<i8")
            yield (
                shard,
                lang,
                terms[0].decode(),
                b"\n".join(sizes).decode(),
                np.fromiter(sizes.values(), dtype="<i4", count=len(sizes)).tobytes(),
                list(number),
                postings.tobytes(),
            )


def runs_of(docs: DataFrame, shards: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Chunks of the term-sorted runs that the tasks spill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict[str, dict[str, tuple[Counter, Counter]]] = defaultdict(dict)
        size = 0

        def spilled() -> Iterator[pa.RecordBatch]:
            for lang, groups in block.items():
                for row in chunks_of(lang, groups, shards):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c], f.type) for c, f in zip(row, RUN_SCHEMA, strict=True)], schema=RUN_SCHEMA
                    )
            block.clear()

        for batch in batches:
            # A few texts at a time become Python objects.
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for lang, source, text in zip(*[c.to_pylist() for c in some.columns], strict=True):
                    own = block[lang].get(source)
                    if own is None:
                        own = block[lang][source] = Counter(), Counter()
                    counts, found = own
                    known = len(counts)
                    distinct: set[bytes] = set()
                    for terms in terms_of(text):
                        counts.update(terms)
                        distinct.update(terms)
                    found.update(distinct)
                    size += POSTING_BYTES * (len(counts) - known)
                    if size > block_bytes:
                        yield from spilled()
                        size = 0
        yield from spilled()

    return docs.select("lang", "source", "text").mapInArrow(run, RUN)


class Chunk:
    """A chunk that a merge has begun."""

    def __init__(self, terms: str, sizes: bytes, sources: list[str], postings: bytes):
        self.terms, self.sources = terms.split("\n"), sources
        self.ends = np.cumsum(np.frombuffer(sizes, dtype="<i4"))
        self.source, self.counts, docs = np.frombuffer(postings, dtype="<i8").reshape(3, -1)
        self.docs = np.add.reduceat(docs, self.ends - np.frombuffer(sizes, dtype="<i4")).tolist()

    def add_to(self, own: dict[str, int], at: int) -> None:
        """Adds the occurrences of a term."""
        begin = self.ends[at - 1] if at else 0
        for s, n in zip(self.source[begin : self.ends[at]].tolist(), self.counts[begin : self.ends[at]].tolist(), strict=True):
            own[self.sources[s]] = own.get(self.sources[s], 0) + n


FREQUENCY = "lang string, term string, total bigint, sources array<string>, counts array<bigint>"


def merged(runs: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """The frequencies of the terms in at least ``min_docs`` documents of their language: occurrences
    in the language and in each source, from a heap merge of each shard's chunks."""
    schema = pa.schema(
        [("lang", pa.string()), ("term", pa.string()), ("total", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
    )
    dealt = runs.repartition(shards, "shard").sortWithinPartitions("shard", "lang", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Heap of (term, number of the chunk, place in it).
        heap: list[tuple[str, int, int]] = []
        chunks: dict[int, Chunk] = {}
        done: list[tuple] = []
        # The term in hand: in how many documents so far, and where its postings are.
        term: str | None = None
        found = 0
        parts: list[tuple[Chunk, int]] = []
        here: tuple | None = None

        def settle() -> None:
            nonlocal term, parts, found
            if term is not None and found >= min_docs:
                own: dict[str, int] = {}
                for chunk, at in parts:
                    chunk.add_to(own, at)
                done.append((here[1], term, sum(own.values()), list(own), list(own.values())))
            term, parts, found = None, [], 0

        def merge(before: str | None) -> None:
            """Takes terms from the heap, those ahead of ``before`` only."""
            nonlocal term, found
            while heap and (before is None or heap[0][0] < before):
                t, number, at = heap[0]
                if t != term:
                    settle()
                    term = t
                chunk = chunks[number]
                found += chunk.docs[at]
                parts.append((chunk, at))
                at += 1
                if at < len(chunk.terms):
                    heapq.heapreplace(heap, (chunk.terms[at], number, at))
                else:
                    heapq.heappop(heap)
                    del chunks[number]

        def taken() -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[]] * len(schema)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )
            done.clear()
            return batch

        number = 0
        for batch in batches:
            for i in range(batch.num_rows):
                shard, lang, first, *rest = (c[i].as_py() for c in batch.columns)
                if here != (shard, lang):
                    merge(None)
                    settle()
                    here = (shard, lang)
                merge(first)
                number += 1
                chunks[number] = Chunk(*rest)
                heapq.heappush(heap, (first, number, 0))
                if len(done) >= 4096:
                    yield taken()
        merge(None)
        settle()
        yield taken()

    return dealt.mapInArrow(run, FREQUENCY)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * kept)), exactly; 0 where nothing is kept."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)")
    below = (total + PRIOR * kept).cast("decimal(20,0)")
    zero = F.lit(0).cast("bigint")
    return F.when(kept > 0, 1 + F.call_function("div", above, below)).otherwise(zero)


def common_terms(shares: DataFrame, tile: int = TILE, most_tiles: int = TILES) -> DataFrame:
    """(lang, source, item, amount): for two sources of a language, what the terms that both have add
    to their difference beyond what each of them adds alone.

    ``shares`` has a row for each term: lang and lists (source, its share p, its share p0 of no
    occurrence). Terms are streamed; sums are held by tiles of ``tile`` sources by as many and given out
    when there are more than ``most_tiles``.
    """
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("amount", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, dict[str, int]] = defaultdict(dict)
        names: dict[str, list[str]] = defaultdict(list)
        tiles: dict[tuple[str, int, int], np.ndarray] = {}

        def taken() -> Iterator[pa.RecordBatch]:
            for (lang, i, j), sums in tiles.items():
                x, y = np.nonzero(sums)
                known = names[lang]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(x), pa.string()),
                        pa.array([known[i * tile + a] for a in x.tolist()], pa.string()),
                        pa.array([known[j * tile + b] for b in y.tolist()], pa.string()),
                        pa.array(sums[x, y], pa.int64()),
                    ],
                    schema=schema,
                )
            tiles.clear()

        for batch in batches:
            for lang, sources, p, p0 in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                number, known = numbers[lang], names[lang]
                for s in sources:
                    if s not in number:
                        number[s] = len(known)
                        known.append(s)
                at = np.array([number[s] for s in sources])
                order = np.argsort(at)
                at, p, p0 = at[order], np.array(p)[order], np.array(p0)[order]
                cuts = np.flatnonzero(np.diff(at // tile)) + 1
                parts = list(zip(np.split(at, cuts), np.split(p, cuts), np.split(p0, cuts), strict=True))
                for a, pa_, za in parts:
                    for b, pb, zb in parts:
                        key = (lang, int(a[0]) // tile, int(b[0]) // tile)
                        sums = tiles.get(key)
                        if sums is None:
                            if len(tiles) >= most_tiles:
                                yield from taken()
                            sums = tiles[key] = np.zeros((tile, tile), dtype=np.int64)
                        x, x0, y, y0 = pa_[:, None], za[:, None], pb[None, :], zb[None, :]
                        amount = abs(x - y) - abs(x - y0) - abs(x0 - y) + abs(x0 - y0)
                        sums[np.ix_(a % tile, b % tile)] += amount
        yield from taken()

    return shares.mapInArrow(run, "lang string, source string, item string, amount bigint").filter("source <> item")


def divergence(
    docs: DataFrame,
    min_docs: int = 30,
    most_terms: int = 50,
    shards: int | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs from every other one of its
    language (``pair``), and the terms it uses most beyond its language's share (``term``)."""
    spark = docs.sparkSession
    ship(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    runs = stored(runs_of(named, shards, block_bytes), "runs")
    kept = stored(merged(runs, shards, min_docs), "frequencies")

    group = ["lang", "source"]
    flat = kept.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    flat = flat.select("lang", "term", "total", F.col("x.sources").alias("source"), F.col("x.counts").alias("count"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    own = flat.groupBy(*group).agg(F.sum("count").alias("n"), F.count("*").alias("n_terms"))
    groups = named.select(*group).distinct().join(own, group, "left").join(langs, "lang", "left").fillna(0)
    groups = stored(groups.withColumn("p0", share(F.lit(0), F.col("n"), F.col("v"))), "groups")
    flat = flat.join(groups, group).select(
        *group, "term", "count", "p0", share(F.col("count"), F.col("n"), F.col("v")).alias("p"), share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q")
    )
    flat = stored(flat, "shares")

    # Of each source: its terms by their share, and the shares of no occurrence of all other sources
    # placed among them. As many rows as a source has different counts and its language has sources.
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("item_p0"))
    pairs = groups.join(other, "lang").filter("source <> item")
    base = F.col("v") * F.abs(F.col("p0") - F.col("item_p0"))
    held = flat.groupBy(*group, "p").agg(F.count("*").alias("k"))
    none = F.lit(None).cast("string")
    placed = held.select(*group, F.col("p").alias("x"), "k", none.alias("item")).unionByName(
        pairs.select(*group, F.col("item_p0").alias("x"), F.lit(0).cast("bigint").alias("k"), "item")
    )
    whole = W.partitionBy(*group)
    below = whole.orderBy("x").rangeBetween(W.unboundedPreceding, W.currentRow)
    sums = placed.withColumns(
        {
            "k_below": F.sum("k").over(below),
            "x_below": F.sum(F.col("k") * F.col("x")).over(below),
            "k_all": F.sum("k").over(whole),
            "x_all": F.sum(F.col("k") * F.col("x")).over(whole),
        }
    ).filter("item is not null")
    far = F.expr("x * (2 * k_below - k_all) + x_all - 2 * x_below")
    alone = sums.select(*group, "item", "k_all", far.alias("far")).join(pairs.select(*group, "item", "p0", "item_p0"), [*group, "item"])
    alone = alone.select(*group, "item", (F.col("far") - F.col("k_all") * F.abs(F.col("p0") - F.col("item_p0"))).alias("amount"))

    shares = flat.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("l"))
    both = common_terms(shares.filter(F.size("l") > 1).select("lang", "l.source", "l.p", "l.p0"))
    amounts = (
        pairs.select(*group, "item", base.alias("amount"))
        .unionByName(alone)
        .unionByName(alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "amount"))
        .unionByName(both)
    )
    pair = amounts.groupBy(*group, "item").agg(F.sum("amount").alias("value"))
    best = [F.col("value").desc(), F.col("item")]
    pair = pair.select(*group, F.lit("pair").alias("part"), "item", "value", F.row_number().over(whole.orderBy(*best)).alias("rank"))
    term = flat.filter("p > q").select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    term = term.withColumn("rank", F.row_number().over(whole.orderBy(*best))).filter(F.col("rank") <= most_terms)
    return pair.unionByName(term)
