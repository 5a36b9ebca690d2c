"""Circulant MinHash: the estimate, and whole results against all pairs."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustmart.llm import circulant_minhash as op
from trustmart.llm.ngram_join import shingles

DOC = "doc_id bigint, text string"


def expected(rows, size=5, threshold=85) -> dict:
    """doc_id -> (size of its set, component) from all pairs."""
    sets = {}
    for doc_id, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        k = min(size, len(w))
        sets[doc_id] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def words(rng, n) -> list:
    return [f"w{rng.integers(3000)}" for _ in range(n)]


def edited(rng, text, n) -> list:
    text = list(text)
    for _ in range(n):
        text[rng.integers(len(text))] = f"e{rng.integers(10**6)}"
    return text


@pytest.fixture(scope="module")
def corpus():
    """Families of copies at similarities around the limit, a large family, strangers that share half
    of its passage, and odd texts."""
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(12):
        base = words(rng, int(rng.integers(60, 400)))
        texts += [edited(rng, base, int(e)) for e in rng.integers(0, 7, 5)]
    base = words(rng, 200)
    texts += [edited(rng, base, 1) for _ in range(60)] + [base] * 20
    texts += [base[:100] + words(rng, 100) for _ in range(6)] + [base[:185] + words(rng, 15) for _ in range(6)]
    texts += [words(rng, n) for n in (1, 4, 5, 6, 20_000)]
    rows = [(int(i), " ".join(t).upper() if i % 7 == 0 else "\n".join(t)) for i, t in enumerate(texts)]
    odd = [None, "", " \t\x0b", "a", "A ", "one two three", "ein Wort Ünd", "EIN wort Ünd", "ein wort ünd"]
    return rows + [(10_000 + i, t) for i, t in enumerate(odd)]


def test_components_are_those_of_all_pairs(spark, corpus):
    df = spark.createDataFrame(corpus, DOC).repartition(6)
    clashing = df.withColumns({c: F.lit(1) for c in ("n", "node", "key", "keys", "component", "a", "b", "f1", "least")})
    rows = op.near_duplicates(clashing).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected(corpus)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(corpus)


def test_other_settings(spark, corpus):
    rows = op.near_duplicates(spark.createDataFrame(corpus, DOC), size=3, threshold=70).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected(corpus, 3, 70)


@pytest.fixture(scope="module")
def cloud():
    """Edits of one passage, most of them too many for two of them to link, and a few with fewer."""
    rng = np.random.default_rng(11)
    base = words(rng, 300)
    texts = [edited(rng, base, int(rng.choice([2, 4, 5, 6, 7, 8]))) for _ in range(160)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_a_cloud_of_near_copies(spark, cloud):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in op.near_duplicates(spark.createDataFrame(cloud, DOC)).collect()}
    assert found == expected(cloud) and 10 < len({c for _, c in found.values()}) < 150


@pytest.mark.parametrize("pivot", [None, 0, 159, 1000])
def test_few_pairs_of_a_cloud_meet_and_none_that_links_is_lost(spark, cloud, pivot, monkeypatch):
    """No component is known. Also with one of the documents, or a stranger, as the pivot."""
    rows = [*cloud, (1000, " ".join(f"x{i}" for i in range(250)))]
    sets = {d: set(shingles(t, 5).tolist()) for d, t in rows}
    docs = spark.createDataFrame(rows, DOC)
    table = op.whole_sets(docs, 5).cache()
    if pivot is not None:
        one = table.filter(F.col("doc_id") == pivot).select(F.lit(0).cast("bigint").alias("__pivot"), F.col("tokens").alias("y"))
        monkeypatch.setattr(op, "consensus", lambda *_: one)
    placed = docs.select(
        F.lit(0).cast("bigint").alias("pivot"),
        F.col("doc_id").alias("node"),
        F.col("doc_id").alias("component"),
        F.lit(-1).cast("bigint").alias("top"),
    )
    met = {(r.a, r.b) for r in op.meeting(op.differences(placed, table, 85).cache(), 85).collect()}

    def parts(links) -> list:
        root = list(range(1001))
        for a, b in links:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
        return root

    pairs = [(a, b) for a in sets for b in sets if a < b]
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert links and parts(links) == parts([p for p in links if p in met])
    if pivot is None:
        assert len(met) < len(links) + 0.05 * len(pairs)


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.2, 0.5, 0.8, 0.95):
        for _ in range(10):
            x = rng.integers(0, 2**63, 1000).astype(np.uint64)
            y = np.concatenate((x[: int(1000 * share)], rng.integers(0, 2**63, 1000 - int(1000 * share)).astype(np.uint64)))
            agree = (op.signature(x) == op.signature(y)).mean()
            errors.append(agree - len(np.intersect1d(x, y)) / len(np.union1d(x, y)))
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.15
    # The circle is one permutation seen from each place: neighbours share all but one rank.
    assert (op._second()[1][:-1] == op._second()[0][1:]).all()
    assert len(set(op.bands(op.signature(shingles("a b c d e f g", 5))).tolist())) == op.BANDS


def test_repeated_rows_and_null_ids(spark):
    text = "one two three four five six seven"
    rows = [(3, text), (3, text), (None, text), (8, text.upper()), (4, "other words are here in this one"), (9, "Other words are here in this one"), (4, text), (None, "alone")]
    found = op.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(((r.doc_id or -1), r.n_shingles, r.component_id or -1, r.kept) for r in found) == [
        (-1, 1, -1, False),
        (-1, 3, 3, False),
        (3, 3, 3, True),
        (3, 3, 3, True),
        (4, 3, 3, False),
        (4, 3, 3, False),
        (8, 3, 3, False),
        (9, 3, 3, False),
    ]


def test_empty_table(spark):
    assert op.near_duplicates(spark.createDataFrame([], DOC)).collect() == []
