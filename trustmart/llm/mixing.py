"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources. Documents are summed by membership pattern (the set of
sources they belong to), so the flow problem has one node per pattern and one per source, however
many documents there are. Token capacity flows from patterns to the quotas of the sources. The k-th
pass over a pattern costs more than the one before (convex repetition costs), so no text is repeated
while an unused one can fill the same quota. The passes that a pattern gets are then dealt to its
documents: full passes to all, the rest along a seeded order.

The flow runs on the driver over at most ``max_patterns`` patterns (an error beyond); documents never
leave the executors. Within a pattern the seeded order is cut into hash buckets: bucket sums are
added up first and only rows of one bucket are ever ordered together, so a pattern that holds a third
of all rows is no single task.

Null and empty texts have size 0 and are never taken; rows without any source form a source of their
own; repeated rows are separate documents, ordered by their id and then by their size; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trustmart.llm.common import WORD, stored, text_of

MAX_REPEATS = 3
#: Cost of a word in its first, second and third pass.
REPEAT_COSTS = (1, 3, 7)
#: Hex digits of the seeded order that name a bucket: 4096 buckets for each pattern.
BUCKET_DIGITS = 3


class Share(NamedTuple):
    """A source's weight, all words in it, and the words the mix shall take from it."""

    weight: float
    size: int
    target: float


def shares(sizes: Sequence[int], weights: Sequence[float], limit: int = MAX_REPEATS) -> list[Share]:
    """Targets in proportion to the weights that add up to all sizes, none above ``limit`` times its
    source's size; what a full source leaves over is shared by weight among the others."""
    total, weight_left = float(sum(sizes)), float(sum(weights))
    targets: dict[int, float] = {}
    # Sources fill up in the order of capacity per weight; after the first that doesn't, none does.
    for i in sorted(range(len(sizes)), key=lambda i: limit * sizes[i] / weights[i]):
        full = float(limit * sizes[i])
        if full > total * weights[i] / weight_left:
            break
        targets[i] = full
        total -= full
        weight_left -= weights[i]
    for i, weight in enumerate(weights):
        if i not in targets:
            targets[i] = total * weight / weight_left
    return [Share(*x) for x in zip(weights, sizes, (targets[i] for i in range(len(sizes))), strict=True)]


def min_cost_flow(
    capacity: Mapping[str, int], members: Mapping[str, Sequence[str]], quota: Mapping[str, int]
) -> dict[tuple[str, str], int]:
    """Words that flow from each pattern to each source: as many as fit, at the least total cost.

    Successive cheapest paths with potentials over the graph root -> pattern (one arc for each pass)
    -> source -> sink. All quantities are whole words.
    """
    names = ["", *[f"p{p}" for p in capacity], *[f"s{s}" for s in quota], "sink"]
    number = {n: i for i, n in enumerate(names)}
    sink = len(names) - 1
    to: list[int] = []
    room: list[int] = []
    cost: list[int] = []
    out: list[list[int]] = [[] for _ in names]

    def arc(a: int, b: int, words: int, price: int) -> int:
        for x, y, free, c in ((a, b, words, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y)
            room.append(free)
            cost.append(c)
        return len(to) - 2

    arcs = {}
    for p, words in capacity.items():
        for price in REPEAT_COSTS:
            arc(0, number[f"p{p}"], words, price)
        for s in members[p]:
            arcs[p, s] = arc(number[f"p{p}"], number[f"s{s}"], words * MAX_REPEATS, 0)
    for s, words in quota.items():
        arc(number[f"s{s}"], sink, words, 0)

    potential = [0] * len(names)
    while True:
        far = [float("inf")] * len(names)
        by = [-1] * len(names)
        far[0] = 0
        queue: list[tuple[float, int]] = [(0, 0)]
        while queue:
            d, at = heapq.heappop(queue)
            if d > far[at]:
                continue
            for e in out[at]:
                if room[e] and (there := d + cost[e] + potential[at] - potential[to[e]]) < far[to[e]]:
                    far[to[e]], by[to[e]] = there, e
                    heapq.heappush(queue, (there, to[e]))
        if by[sink] < 0:
            break
        reach = far[sink]
        potential = [p + int(min(d, reach)) for p, d in zip(potential, far, strict=True)]
        path, at = [], sink
        while at:
            path.append(by[at])
            at = to[by[at] ^ 1]
        words = min(room[e] for e in path)
        for e in path:
            room[e] -= words
            room[e ^ 1] += words
    return {key: room[e ^ 1] for key, e in arcs.items() if room[e ^ 1]}


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def seeded_order(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def take(
    docs: DataFrame,
    sources: Column,
    weights: Mapping[str, float] | None = None,
    size: Column | None = None,
    seed: str = "mix",
    max_patterns: int = 100_000,
) -> DataFrame:
    """``docs`` with ``__size``, ``__source_size``, ``__target`` and ``__taken``.

    ``sources``: array of names of each document; null or empty: the unnamed source, the last one.
    ``weights``: by source name, the unnamed one as None; without it sources weigh 1, 2, 3, 1, ... by
    code point. ``size``: words of a document, those of ``text`` by default. ``__source_size`` and ``__target`` add up the sources of the document. ``__taken`` is
    a number of words, at most ``MAX_REPEATS`` times the size: whole passes and, for the one document
    in each pattern where the quota ends, a part of a pass.
    """
    spark = docs.sparkSession
    pattern = F.array_sort(F.array_distinct(F.filter(sources, lambda s: s.isNotNull())))
    # Names are length-prefixed in a pattern's key, so no two patterns share a key.
    key = F.array_join(F.transform(pattern, lambda s: F.concat(F.length(s).cast("string"), F.lit(":"), s)), ",")
    # Only the sum of each pattern reaches the driver.
    sized = docs.withColumn("__size", n_words(text_of()) if size is None else size).withColumn(
        "__pattern", F.coalesce(key, F.lit(""))
    )
    patterns = (
        sized.groupBy("__pattern")
        .agg(F.sum("__size").alias("size"), F.first(pattern).alias("sources"))
        .limit(max_patterns + 1)
        .collect()
    )
    if len(patterns) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; merge rare ones first")
    members = {r["__pattern"]: [*(r["sources"] or [None])] for r in patterns}
    capacity = {r["__pattern"]: r["size"] for r in patterns}
    # Python orders strings by code point.
    named = sorted({s for of in members.values() for s in of if s is not None})
    every = named + [None] * any(None in of for of in members.values())
    sizes = [sum(capacity[p] for p, of in members.items() if s in of) for s in every]
    weigh = [float(weights[s]) if weights else i % 3 + 1 for i, s in enumerate(every)]
    share = dict(zip(every, shares(sizes, weigh), strict=True))
    quota = {str(i): round(share[s].target) for i, s in enumerate(every)}
    number = {s: str(i) for i, s in enumerate(every)}
    flow = min_cost_flow(capacity, {p: [number[s] for s in of] for p, of in members.items()}, quota)
    routed = dict.fromkeys(members, 0)
    for (p, _), amount in flow.items():
        routed[p] += amount
    plan = spark.createDataFrame(
        [
            (
                p,
                sum(share[s].size for s in of),
                float(sum(share[s].target for s in of)),
                routed[p] // max(1, capacity[p]),
                routed[p] % max(1, capacity[p]),
            )
            for p, of in members.items()
        ],
        "__pattern string, __source_size bigint, __target double, __passes bigint, __rest bigint",
    )

    # The plan has at most max_patterns short rows.
    placed = sized.join(F.broadcast(plan), "__pattern").withColumn(
        "__order", seeded_order(F.col("doc_id"), seed)
    )
    placed = placed.withColumn("__bucket", F.substring("__order", 1, BUCKET_DIGITS))
    # Bucket sums: at most 4096 for each pattern, so a window over one pattern's buckets is small.
    before = W.partitionBy("__pattern").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("__pattern", "__bucket")
        .agg(F.sum("__size").alias("words"))
        .select(
            "__pattern", "__bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("__start")
        )
    )
    inside = W.partitionBy("__pattern", "__bucket").orderBy("__order", "doc_id", "__size")
    inside = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.col("__start") + F.sum("__size").over(inside)
    # Of the pass that is not complete, a document gets what lies between its begin and the rest.
    part = F.greatest(F.lit(0), F.least(F.col("__size"), F.col("__rest") - (F.col("__end") - F.col("__size"))))
    return (
        placed.join(starts, ["__pattern", "__bucket"])
        .withColumn("__end", end)
        .withColumn("__taken", (F.col("__size") * F.col("__passes") + part).cast("bigint"))
        .drop("__pattern", "__passes", "__rest", "__order", "__bucket", "__start", "__end")
    )


def mix_report(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """What the mix takes of each document when each source is one column ``source``."""
    # Texts are counted once; after that only ids and sizes move.
    narrow = stored(docs.select("doc_id", "source", n_words(text_of()).alias("words")), "sizes")
    return take(narrow, F.array("source"), size=F.col("words"), seed=seed).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__taken").alias("taken"),
    )


def mixed(docs: DataFrame, seed: str = "mix", whole: bool = False) -> DataFrame:
    """The mix itself: each document as often as whole passes take it, and the document at which a
    quota ends once more, cut after the last word that fits. With ``whole`` no text is cut: that last
    copy is whole if half of its words or more fit, else it is left out. Columns stay those of
    ``docs``."""
    columns = docs.columns
    rows = take(docs, F.array("source"), seed=seed).filter(F.col("__taken") > 0)
    if whole:
        copies = F.expr("cast(__taken div __size + int(2 * (__taken % __size) >= __size) as int)")
        return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.nullif(copies, F.lit(0))))).select(*columns)
    rest = F.col("__taken") % F.col("__size")
    # One copy for each whole pass (null: the whole text), one for the part.
    passes = F.array_repeat(F.lit(None).cast("bigint"), F.expr("cast(__taken div __size as int)"))
    part = F.filter(F.array(rest), lambda r: r > 0)
    rows = rows.withColumn("__cut", F.explode(F.concat(passes, part)))
    # Split behind each word, so that the pieces put together are the text again.
    pieces = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("__cut").cast("int")), "")
    whole = F.col("__cut").isNull()
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn(
            "n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length(cut).cast(kind))
        )
    return rows.withColumn("text", F.when(whole, F.col("text")).otherwise(cut)).select(*columns)
