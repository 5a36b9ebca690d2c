"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustmart.llm import prefix_trie
from trustmart.llm.scan import scan

TURN = "conv_id bigint, turn int, role string, text string"


def expected(rows) -> set:
    """Nodes by brute force; rows are (conv_id, turn, role, text)."""

    def turn_id(role, text):
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()

    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, turn_id(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    lines = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lines[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, line in lines.items():
        for d in range(len(line) + 1):
            members[line[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
    return {
        (
            min(ids),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(ids),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(c for c in ids if lines[c] == node))).encode()).hexdigest(),
        )
        for node, ids in members.items()
    }


def found(df) -> set:
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def conversations(seed: int, n: int, turns: int, texts: int) -> list:
    rng = np.random.default_rng(seed)
    return [
        (int(c), t, ("user", "assistant")[t % 2], f"text {rng.integers(texts)} of\ttwo")
        for c in range(n)
        for t in range(int(rng.integers(1, turns)))
    ]


@pytest.mark.parametrize("most_turns", [40, 20_000])
def test_nodes_are_those_of_brute_force_however_containers_burst(spark, most_turns):
    rows = conversations(1, 70, 9, 3)
    # Long ones that part beyond a piece's length, copies of them, and a base with one turn only.
    rows += [(c, t, "user", f"t{t if t < 130 or c % 2 else -c}") for c in range(200, 206) for t in range(140)]
    rows += [(300, 0, "user", "alone"), *[(c, t, "user", f"x{t}") for c in (301, 302, 303, -40, -41) for t in range(5)]]
    frame = spark.createDataFrame(rows, TURN).repartition(5)
    assert found(prefix_trie.trie_report(frame, most_turns)) == expected(rows)


def test_odd_rows_have_their_defined_place(spark):
    rows = [
        (1, None, None, None),
        (1, 2, "user", "second"),
        (1, 1, "user", "first"),
        (1, 1, "user", "first"),
        (1, 1, "user", "other of the same turn"),
        (2, None, "", ""),
        (20, 3, "user", "  "),
        (21, 1, "user", "word " * 50_000),
        (None, 1, "user", "nobody's"),
        (25, 0, "user", "only turn"),
    ]
    frame = spark.createDataFrame(rows, TURN)
    clashing = frame.withColumns({c: F.lit("x") for c in ("nth", "d", "id", "words", "h1", "block", "depth", "n")})
    assert found(prefix_trie.trie_report(clashing)) == expected(rows)


def test_no_conversation_no_node(spark):
    assert prefix_trie.trie_report(spark.createDataFrame([], TURN)).collect() == []


def test_conversations_without_turns_end_at_the_root(spark):
    turnless = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 4 and c % 20][:4]
    rows = [(c, 0, "user", "taken away") for c in turnless]
    result = found(prefix_trie.trie_report(spark.createDataFrame(rows, TURN)))
    assert result == expected(rows) and [r[1:7] for r in result] == [(0, None, 4, 0, 1, 0)]


def test_scan_goes_on_over_tasks(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(i), int(v)) for i, (k, v) in enumerate(zip(rng.choice([1, 7, 7, 7, 9], 4000), rng.integers(-99, 99, 4000), strict=True))]
    frame = spark.createDataFrame(rows, "k bigint, i bigint, v bigint").withColumn("x", F.xxhash64("i"))
    frame = frame.repartition(11)
    seen = {(r.k, r.i): (r["__nth"], r["__run_v"], r["__run_x"]) for r in scan(frame, "k", [F.col("i")], ["v"], ["x"]).collect()}
    hashes = {r.i: r.x for r in frame.collect()}
    state = defaultdict(lambda: (0, 0, 0))
    for k, i, v in rows:
        nth, total, bits = state[k]
        state[k] = (nth + 1, total + v, bits ^ hashes[i])
        assert seen[k, i] == state[k]
