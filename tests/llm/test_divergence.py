"""The source audit against a plain count of everything."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustmart.llm import divergence as op

DOC = "doc_id bigint, text string, lang string, source string"


def expected(rows, min_docs, most_terms=50) -> set:
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        own = {s: c for (g, s), c in groups.items() if g == lang}
        whole = sum(own.values(), Counter())

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return [1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept]

        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s in own:
            pairs = [(sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True)), o) for o in own if o != s]
            terms = [(a - b, t) for t, a, b in zip(kept, p[s], q, strict=True) if own[s][t] and a > b]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, most_terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found[:most])}
    return out


def corpus(seed: int, n: int, sources: int) -> list:
    rng = np.random.default_rng(seed)
    vocabulary = [f"{a}{b}" for a in "aé日zß" for b in ("x", "Yy", "ö", "q", "abc", "")]
    rows = []
    for i in range(n):
        words = rng.choice(vocabulary, int(rng.integers(0, 12)))
        marks = rng.choice([" ", "\n", "1", "-", "\x00", "\x7f", "  [", "_"], len(words))
        text = "".join(w + m for w, m in zip(words, marks, strict=True))
        # The first source holds a third of all rows.
        source = f"s{0 if i % 3 == 0 else rng.integers(sources)}"
        rows.append((i, text, ("en", "de", None)[i % 5 % 3], source))
    return rows


def found(df) -> set:
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize(("block_bytes", "shards"), [(2000, 3), (10**8, 7)])
def test_audit_is_that_of_plain_counts(spark, block_bytes, shards):
    rows = corpus(1, 400, 9)
    rows += [(1, None, "en", "s1"), (1, "", None, None), (1, rows[3][1], "en", "s1"), (1, rows[3][1], "en", "s1")]
    rows += [(2, "word " * 60_000 + "ax", "en", "long"), (3, "12 34", "de", "textless"), (4, "rare", "fr", "a"), (5, "", "fr", "b")]
    frame = spark.createDataFrame(rows, DOC).repartition(5)
    clashing = frame.withColumns({c: F.lit(1) for c in ("term", "n", "p", "q", "item", "value", "rank", "shard", "v", "x")})
    got = op.divergence(clashing, min_docs=6, most_terms=7, shards=shards, block_bytes=block_bytes)
    assert found(got) == expected(rows, 6, 7)
    assert {"fr"} == {r[0] for r in found(got) if r[2] == "pair" and r[4] == 0 and r[0] == "fr"}


def test_many_sources_and_small_tiles_agree(spark):
    rng = np.random.default_rng(2)
    terms = [(f"t{i}", sorted(rng.choice(9, int(rng.integers(2, 9)), replace=False).tolist())) for i in range(40)]
    rows = [("en", [f"s{s}" for s in own], [100 + s * i for s in own], [7 + s for s in own]) for i, (_, own) in enumerate(terms)]
    frame = spark.createDataFrame(rows, "lang string, source array<string>, p array<bigint>, p0 array<bigint>")

    def sums(**settings):
        parts = op.common_terms(frame, **settings).groupBy("source", "item").agg(F.sum("amount").alias("n"))
        return {(r.source, r.item): r.n for r in parts.collect() if r.n}

    want = Counter()
    for _, own, p, p0 in rows:
        for s, a, a0 in zip(own, p, p0, strict=True):
            for o, b, b0 in zip(own, p, p0, strict=True):
                if s != o:
                    want[s, o] += abs(a - b) - abs(a - b0) - abs(a0 - b) + abs(a0 - b0)
    assert sums() == sums(tile=2, most_tiles=2) == {k: v for k, v in want.items() if v}


def test_a_long_text_in_pieces_has_the_same_terms(monkeypatch):
    text = "Ab cd " * 500 + "x" * 300 + " é1é" * 200
    (terms,) = op.terms_of(text)
    whole = Counter(terms)
    monkeypatch.setattr(op, "PIECE", 64)
    pieces = list(op.terms_of(text))
    assert len(pieces) > 9 and sum(map(Counter, pieces), Counter()) == whole and whole[b"ab"] == 500 and whole["é".encode()] == 400


def test_empty_table(spark):
    assert op.divergence(spark.createDataFrame([], DOC)).collect() == []
