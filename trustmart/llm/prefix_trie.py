"""Prefix trie of conversations, built by burst tries.

A conversation is a sequence of turns. A turn is known by 128 bits of its role and text and of its
depth; a prefix by the sum (xor) of its turns' bits, which is its node's id and can be worked out by a
running total over rows, so no conversation is gathered whole. The trie is built from containers:

1. conversations are cut every ``BLOCK`` turns; a piece is a suffix in the container of its head, the
   node at which it begins; equal pieces are one row that counts them;
2. a container of more than ``most_turns`` turns bursts: the first turns of its suffixes become nodes,
   each the head of a container of what follows; this goes on until no container is too full;
3. the rest are dealt by head, sorted within, and swept in one run over each task's rows, which opens
   and closes nodes as neighbouring suffixes part; a task holds one path of ``BLOCK`` nodes at most.

Leaf counts and subtree sums follow from paths: each leaf has a conversation of its own whose path is
laid over the nodes, and a node's amount is entered once, on the path of the smallest leaf below it.

Null roles and texts count as empty; a null turn comes first; rows of one conversation and turn stand
in the order of the hash of role and text, repeated rows each count as a turn; rows without
``conv_id`` take no part. Texts are hashed where they are read and never move, however long. An empty
table has no node, not even a root. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.llm.common import WORD, ship, stored
from trustmart.llm.scan import scan
from trustmart.operators.joins import lookup

#: Turns of a piece.
BLOCK = 64
#: Turns of a container that is swept as it is.
MOST_TURNS = 20_000
#: Conversations of one family take their first turns from its first member.
FAMILY = 20


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, nth, id, words): each conversation's turns in order, from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    known = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").isNotNull().alias("has_turn"),
        "turn",
        F.md5(known.cast("binary")).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        # Tells repeated rows apart, so that very many of them are dealt to many tasks.
        F.monotonically_increasing_id().alias("copy"),
    )
    order = [F.col("has_turn"), F.col("turn"), F.col("id"), F.col("copy")]
    return scan(rows, "conv_id", order, name="turns").select(
        "conv_id", F.col("__nth").alias("nth"), F.unhex("id").alias("id"), "words"
    )


def borrowed_turns(conv_id: str = "conv_id") -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return F.pmod(F.crc32(F.col(conv_id).cast("string").cast("binary")), F.lit(4))


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, d, id, words): the first turns of the family's first conversation, as many as
    ``borrowed_turns`` says and it has, then the own turns after so many."""
    plan = convs.select(
        "conv_id", borrowed_turns().alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    )
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    plan = plan.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0))))
    plan = stored(plan.select("conv_id", "base", "h", "taken"), "families")
    firsts = turns.filter("nth <= 3").withColumnRenamed("conv_id", "base")
    first = plan.filter("taken > 0").join(firsts, "base").filter("nth <= taken")
    late = plan.filter("taken < h").select(F.col("conv_id").alias("__conv"), (F.col("h") - F.col("taken")).alias("less"))
    own = lookup(turns.filter(F.col("nth") > borrowed_turns()), late, "conv_id", "__conv")
    return first.select("conv_id", F.col("nth").alias("d"), "id", "words").unionByName(
        own.select("conv_id", (F.col("nth") - F.coalesce("less", F.lit(0))).alias("d"), "id", "words")
    )


def paths_of(sequences: DataFrame) -> DataFrame:
    """(conv_id, d, words, e1, e2, h1, h2): each turn with the bits of it at its depth, and the node
    that the conversation has reached with it."""
    rows = sequences.select(
        "conv_id",
        "d",
        "words",
        F.xxhash64("id", "d").alias("e1"),
        F.xxhash64(F.lit(40503), "id", "d").alias("e2"),
    )
    found = scan(rows, "conv_id", [F.col("d")], xors=["e1", "e2"], name="paths")
    return found.select("conv_id", "d", "words", "e1", "e2", F.col("__run_e1").alias("h1"), F.col("__run_e2").alias("h2"))


def suffixes(paths: DataFrame) -> DataFrame:
    """(h1, h2, depth, suffix, n, conv_id): each distinct piece with its head, how many conversations
    hold it and the smallest of them."""
    block = F.floor((F.col("d") - 1) / BLOCK).cast("bigint")
    before = F.struct(F.col("h1").bitwiseXOR(F.col("e1")).alias("h1"), F.col("h2").bitwiseXOR(F.col("e2")).alias("h2"))
    turn = F.struct("d", "e1", "e2", "words")
    pieces = paths.groupBy("conv_id", block.alias("block")).agg(
        F.min_by(before, "d").alias("head"),
        F.max_by(F.struct("h1", "h2"), "d").alias("end"),
        F.sort_array(F.collect_list(turn)).alias("suffix"),
    )
    distinct = pieces.groupBy("head", "end", "block").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.any_value("suffix").alias("suffix")
    )
    turns = F.transform("suffix", lambda t: F.struct(t.e1.alias("e1"), t.e2.alias("e2"), t.words.alias("words")))
    depth = (F.col("block") * BLOCK).alias("depth")
    return distinct.select("head.h1", "head.h2", depth, turns.alias("suffix"), "n", "conv_id")


NODE = "h1 bigint, h2 bigint, depth bigint, p1 bigint, p2 bigint, n_convs bigint, conv_id bigint, words bigint"


def burst(containers: DataFrame, most_turns: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Bursts containers until none holds more than ``most_turns`` turns in two suffixes or more;
    gives the nodes that came of it and what is left to sweep. A container bursts ``BLOCK`` times at
    most, as its suffixes are no longer."""
    nodes, calm = [], []
    while True:
        containers = stored(containers, "containers")
        fill = containers.groupBy("h1", "h2").agg(F.sum(F.size("suffix")).alias("turns"), F.count("*").alias("found"))
        full = fill.filter((F.col("turns") > most_turns) & (F.col("found") > 1))
        full = stored(full.select(F.concat_ws(":", "h1", "h2").alias("__box")), "full")
        if full.isEmpty():
            return nodes, [*calm, containers]
        named = containers.withColumn("box", F.concat_ws(":", "h1", "h2"))
        calm.append(lookup(named, full, "box", "__box", "left_anti").drop("box"))
        first = F.col("suffix")[0]
        moved = lookup(named, full, "box", "__box", "left_semi").select(
            F.col("h1").alias("p1"),
            F.col("h2").alias("p2"),
            F.col("h1").bitwiseXOR(first.e1).alias("h1"),
            F.col("h2").bitwiseXOR(first.e2).alias("h2"),
            (F.col("depth") + 1).alias("depth"),
            F.slice("suffix", 2, BLOCK).alias("suffix"),
            first.words.alias("words"),
            "n",
            "conv_id",
        )
        moved = stored(moved, "burst")
        found = moved.groupBy("h1", "h2", "depth", "p1", "p2").agg(
            F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words")
        )
        nodes.append(found)
        containers = moved.filter(F.size("suffix") > 0).select("h1", "h2", "depth", "suffix", "n", "conv_id")


def sweep(containers: DataFrame) -> DataFrame:
    """The nodes of sorted containers, without their heads."""
    names = [c.split()[0] for c in NODE.split(", ")]
    schema = pa.schema([(c, pa.int64()) for c in names])
    rows = (
        containers.repartition("h1", "h2")
        .sortWithinPartitions("h1", "h2", "suffix")
        .select("h1", "h2", "depth", "n", "conv_id", "suffix.e1", "suffix.e2", "suffix.words")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: tuple | None = None
        # Open nodes from the head down: [h1, h2, depth, p1, p2, n, conv_id, words], and their turns.
        stack: list[list] = []
        turns: list[tuple] = []
        done: list[list] = []

        def close(down_to: int) -> None:
            while len(stack) > down_to:
                node = stack.pop()
                if stack:
                    stack[-1][5] += node[5]
                    stack[-1][6] = min(stack[-1][6], node[6])
                done.append(node)
            del turns[down_to:]

        def taken() -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[]] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=schema)
            done.clear()
            return batch

        for batch in batches:
            for h1, h2, depth, n, conv, e1, e2, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if head != (h1, h2):
                    close(0)
                    head = (h1, h2)
                own = list(zip(e1, e2, strict=True))
                common = 0
                for a, b in zip(own, turns, strict=False):
                    if a != b:
                        break
                    common += 1
                close(common)
                for at in range(common, len(own)):
                    p1, p2 = stack[-1][:2] if stack else head
                    stack.append([p1 ^ e1[at], p2 ^ e2[at], depth + at + 1, p1, p2, 0, conv, words[at]])
                turns.extend(own[common:])
                stack[-1][5] += n
                stack[-1][6] = min(stack[-1][6], conv)
                if len(done) >= 10_000:
                    yield taken()
        close(0)
        yield taken()

    return rows.mapInArrow(run, NODE)


def digests(endings: DataFrame) -> DataFrame:
    """(h1, h2, ends_sha256) of (h1, h2, conv_id): the hash of a node's ids, ascending, put together
    with commas. Ids are sorted and written out by ranges, a node of very many ids in many tasks; only
    the hash itself, which is one run over the bytes, is left to one task, a chunk at a time."""
    order = ["h1", "h2", "conv_id"]
    chunk = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("conv_id", pa.int64()), ("ids", pa.binary())])
    hashed = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("ends_sha256", pa.string())])
    most = 8192

    def written_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            node, ids = None, []
            for h1, h2, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if node != (h1, h2) or len(ids) == most:
                    if ids:
                        rows.append((*node, ids[0], ",".join(map(str, ids)).encode()))
                    node, ids = (h1, h2), []
                ids.append(conv)
            if ids:
                rows.append((*node, ids[0], ",".join(map(str, ids)).encode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(chunk)], schema=chunk
            )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        rows: list[tuple] = []
        for batch in batches:
            for h1, h2, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if node == (h1, h2):
                    state.update(b",")
                else:
                    if node:
                        rows.append((*node, state.hexdigest()))
                    node, state = (h1, h2), hashlib.sha256()
                state.update(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(hashed)], schema=hashed
            )
            rows = []
        if node:
            rows.append((*node, state.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(hashed)], schema=hashed
        )

    sorted_ids = endings.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = sorted_ids.mapInArrow(written_out, "h1 bigint, h2 bigint, conv_id bigint, ids binary")
    dealt = chunks.repartition("h1", "h2").sortWithinPartitions(*order)
    return dealt.mapInArrow(summed, "h1 bigint, h2 bigint, ends_sha256 string")


def trie(paths: DataFrame, convs: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """Every node (h1, h2, depth, p1, p2, n_convs, conv_id, words) of the paths, with the root."""
    burst_nodes, calm = burst(suffixes(paths), most_turns)
    rest = calm[0]
    for more in calm[1:]:
        rest = rest.unionByName(more)
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    none = F.lit(None).cast("bigint")
    zero = F.lit(0).cast("bigint")
    nodes = root.select(
        zero.alias("h1"), zero.alias("h2"), zero.alias("depth"), none.alias("p1"), none.alias("p2"), "n_convs", "conv_id", zero.alias("words")
    )
    for found in [*burst_nodes, sweep(rest)]:
        nodes = nodes.unionByName(found)
    return stored(nodes, "nodes")


def trie_report(conversations: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    ship(spark)
    turns = turns_of(conversations)
    convs = stored(turns.groupBy("conv_id").agg(F.max("nth").alias("turns")), "conversations")
    paths = paths_of(rebuilt(turns, convs))
    nodes = trie(paths, convs, most_turns)
    here = ["h1", "h2"]
    kids = nodes.filter("p1 is not null").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2"))
    nodes = nodes.join(kids.agg(F.count("*").alias("n_children")), here, "left").fillna(0, ["n_children"])
    nodes = stored(nodes, "nodes-children")

    # Each leaf has a conversation that no other leaf has: the smallest that ends there.
    leaves = nodes.filter("n_children = 0").select(F.col("conv_id").alias("__leaf"))
    lines = lookup(paths.select("conv_id", "d", *here), leaves, "conv_id", "__leaf", "left_semi")
    zero = F.lit(0).cast("bigint")
    tops = leaves.select(F.col("__leaf").alias("conv_id"), zero.alias("d"), zero.alias("h1"), zero.alias("h2"))
    lines = stored(lines.unionByName(tops), "leaf-paths")
    below = lines.groupBy(*here).agg(F.count("*").alias("n_leaves"), F.min("conv_id").alias("owner"))
    nodes = stored(nodes.join(below, here), "nodes-leaves")
    amounts = nodes.select(*here, "owner", ((F.col("n_convs") - 1) * F.col("words")).alias("amount"))
    entered = lines.join(amounts, here).select(
        "conv_id", "d", *here, F.when(F.col("owner") == F.col("conv_id"), F.col("amount")).otherwise(zero).alias("amount")
    )
    # What is entered on a path at a depth or further down.
    sums = scan(entered, "conv_id", [F.col("d").desc()], sums=["amount"], name="subtrees")
    saved = sums.groupBy(*here).agg(F.sum("__run_amount").alias("saved_tokens"))

    last = paths.groupBy("conv_id").agg(F.max(F.struct("d", *here)).alias("end"))
    endings = convs.select("conv_id").join(last, "conv_id", "left")
    endings = endings.select("conv_id", *[F.coalesce(f"end.{c}", zero).alias(c) for c in here])
    parents = nodes.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(saved, here)
        .join(digests(endings), here, "left")
        .join(parents, ["p1", "p2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
