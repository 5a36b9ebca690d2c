"""Each operator on small hand-made tables: brute force, round trips and odd input."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustmart.llm import (
    ann,
    fingerprint,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality,
    queries,
    surrogates,
    token_rollup,
)
from trustmart.llm.common import scratch
from trustmart.llm.components import components

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LINE = "This boilerplate line is longer than forty code points."
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def text_of(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS) + str(rng.integers(50)) for _ in range(n))


def documents(spark, texts, **columns):
    rows = [
        (i, t, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["s"] * len(texts))[i], len(t or ""))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, a long one, null ids, languages and sources, repeated rows, and extra
    columns whose names clash with inner ones."""
    long = "\n".join(text_of(i, 40) for i in range(300))
    texts = [None, "", "a", "two words", long, text_of(1, 60), text_of(1, 60), LINE, "Über Größe", "12 34 !!"]
    rows = [(i, t, None if i == 3 else "en", None if i % 4 == 1 else f"s{i % 3}", 1) for i, t in enumerate(texts)]
    rows += [rows[5], (None, text_of(1, 60), "en", "s0", 1)]
    frame = spark.createDataFrame(rows, DOC)
    return frame.withColumns({c: F.lit(1) for c in ("lines", "size", "node", "part", "score", "key", "n")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def test_lines_of_five_documents_stay_in_the_largest_id(spark):
    texts = [f"head {i}\n \t{LINE.upper() if i % 2 else LINE} \nshort" for i in range(6)] + [None, "short"]
    rows = {r.doc_id: r for r in line_dedup.line_digest(documents(spark, texts)).collect()}
    assert [rows[i].n_dropped for i in range(8)] == [1, 1, 1, 1, 1, 0, 0, 0]
    assert [rows[i].n_lines for i in (0, 6)] == [3, 1]
    assert rows[0].kept_sha256 == hashlib.sha256(b"head 0\nshort").hexdigest()
    assert rows[6].kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_four_documents_keep_their_lines(spark):
    rows = line_dedup.line_digest(documents(spark, [LINE] * 4)).collect()
    assert {r.n_dropped for r in rows} == {0}


def test_runs_go_on_in_levels_and_agree_with_one_count(spark):
    root = scratch(spark, "test-runs")
    batches = [documents(spark, [f"{LINE} {i % 3}", LINE]).withColumn("doc_id", F.col("doc_id") + 10 * i) for i in range(7)]
    fresh = [line_dedup.LineRuns(spark, root, fanout=2).process(b).count() for b in batches]
    assert fresh == [2, 1, 1, 0, 0, 0, 0]
    runs = line_dedup.LineRuns(spark, root, fanout=2)
    assert sorted(level for level, _ in runs.manifest()[1]) == [0, 1, 2]
    totals = sorted((r.n_docs, r.keeper) for r in runs.totals().collect())
    assert totals == [(2, 40), (2, 50), (3, 60), (7, 61)]


def test_token_rollup_is_idempotent_and_signed(spark):
    rollup = token_rollup.TokenRollup(spark, scratch(spark, "test-rollup"))
    kinds = "kind string, source string, lang string, tokenizer string, tokens bigint, old_source string, old_lang string, old_tokenizer string, old_tokens bigint"
    load = spark.createDataFrame(
        [("insert", "a", "en", "t", 5, None, None, None, None), ("insert", "a", "en", "t", 7, None, None, None, None), ("insert", None, None, "t", None, None, None, None, None)],
        kinds,
    )
    assert rollup.commit("one", load) and not rollup.commit("one", load)
    moved = spark.createDataFrame([("revise", "b", "en", "t", 8, "a", "en", "t", 7), ("delete", "a", "en", "t", 5, None, None, None, None)], kinds)
    rollup.commit("two", moved)
    rollup.compact()
    assert not rollup.commit("two", moved)
    rollup.commit("none", moved.limit(0))
    found = {(r.source, r.lang): (r.documents, r.tokens) for r in rollup.totals().collect()}
    assert found == {("b", "en"): (1, 8), (None, None): (1, 0)}
    with pytest.raises(Exception, match="must be insert"):
        rollup.commit("bad", load.withColumn("kind", F.lit("?")))


def test_corpus_totals_count_each_text_once(spark, odd):
    rows = token_rollup.corpus_totals(odd, queries.tokenizer_path()).collect()
    words = sum(r.tokens for r in rows if r.tokenizer == "words:1")
    texts = {(r.doc_id, r.text) for r in odd.collect() if r.doc_id != 6}
    # The repeated row shares the smallest id, so both of its rows stay.
    assert words == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in texts) + 60
    assert {r.tokenizer for r in rows} == {"words:1", "word_bpe_49k:1"}


def test_full_totals_hold_every_row(spark, tmp_path):
    import duckdb

    texts = ["one two", None, "one two", "three", None, "", "One two", None]
    docs = documents(spark, texts, source=["a", "a", "b", "b", None, "b", "b", "c"])
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op3_token_counts(spark, str(tmp_path)).collect()
    found = {(r.source, r.lang, r.documents, r.tokens) for r in rows if r.tokenizer == "words:1"}
    plain = r"""SELECT source, lang, count(*), sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))
        FROM '{}/documents.parquet/*.parquet' GROUP BY source, lang"""
    assert found == set(duckdb.sql(plain.format(tmp_path)).fetchall())
    count = {v: sum(r.documents for r in rows if r.tokenizer == v) for v in {r.tokenizer for r in rows}}
    # One copy is withdrawn from the distinct totals; null texts are copies of nothing.
    assert count == {"words:1": 8, "word_bpe_49k:1": 8, "words:1:distinct": 7, "word_bpe_49k:1:distinct": 7}


def test_surrogates_keep_kind_format_and_coreference(spark):
    texts = [
        "Mail ann.b7@mail.test.org or ANN.B7@MAIL.TEST.ORG, call +1 (415) 555-1234.",
        "Card 4111 1111 1111 1111 and 4111111111111111 at 10.20.30.40; order 4111111111111112.",
        "Mary Wilkins met John Wilkins. Wilkins told Mary.",
        "Мария Петрова и Иван Петров",
        None,
        "",
    ]
    docs = documents(spark, texts).withColumn("kind", F.lit("x"))
    rows = {r.doc_id: r for r in surrogates.replaced(docs, b"k").collect()}
    again = {r.doc_id: r.text for r in surrogates.replaced(docs.repartition(3), b"k").collect()}
    assert {i: r.text for i, r in rows.items()} == again
    mails = re.findall(r"\S+@[\w.]+\w", rows[0].text)
    assert mails[0].upper() == mails[1] and "test" not in rows[0].text
    assert re.search(r"\+1 \(\d{3}\) 555-\d{4}\.", rows[0].text) and "1234" not in rows[0].text
    spaced, plain = re.search(r"Card ([\d ]{19}) and (\d{16}) ", rows[1].text).groups()
    assert spaced.replace(" ", "") == plain and surrogates.luhn(plain) and plain != "4" + "1" * 15
    assert rows[1].text.endswith("order 4111111111111112.")
    one = re.fullmatch(r"(\w+) (\w+) met (\w+) \2\. \2 told \1\.", rows[2].text)
    assert one and one[1] in surrogates.GIVEN["latin", "f"] and one[3] in surrogates.GIVEN["latin", "m"]
    assert re.fullmatch("[А-Яа-я]+ [А-Яа-я]+ и [А-Яа-я]+ [А-Яа-я]+", rows[3].text) and rows[3].text != texts[3]
    assert (rows[4].text, rows[5].text, rows[5]["__replaced"]) == (None, "", 0)


def test_surrogates_draw_again_until_distinct(spark):
    values = [(f"{a}.{b}.{c}.{d}",) for a in range(1, 9) for b in range(1, 6) for c in range(1, 6) for d in range(1, 6)]
    entities = spark.createDataFrame(values, "value string").select(F.lit("ip").alias("kind"), "value")
    rows = surrogates.assigned(entities, b"k").collect()
    assert len(rows) == len(values) == len({r.substitute for r in rows})
    assert not {r.substitute for r in rows} & {v for (v,) in values}


def test_packing_is_a_round_trip(spark, odd):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(queries.tokenizer_path())
    strange = ["It's NAÏVE—don't x́y <|endoftext|>tail 3.14!?\r\nİ ǅ ﬁ 日本語 é", "a'S b's\x1cc"]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(strange)], "doc_id bigint, text string"))
    docs = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    pieces = packing.pack(docs, queries.tokenizer_path(), max_length=64).collect()
    for doc_id, text in texts.items():
        own = sorted((p for p in pieces if p.doc_id == doc_id), key=lambda p: p.start)
        ids = [i for p in own for i in p.ids]
        assert ids == [*coder.encode(text, add_special_tokens=False).ids, 2]
        assert all(p.length & (p.length - 1) == 0 and p.length == len(p.ids) and p.offset == 0 for p in own)
        assert all(zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 for p in own)
    assert sorted(p.sequence_id for p in pieces) == list(range(len(pieces)))
    assert packing.packing_digest(odd.limit(0), queries.tokenizer_path()).count() == 0


def test_packing_lower_cases_each_character_alone():
    texts = ["ΟΔΟΣ", "ΟΔΟΣ, ΌΛΟΣ! οδος οδοσ ΣΑΣ Σ aΣ", "İSTANBUL ΣİΣ ẞ Ǆ K Å"]
    coder = packing.coder(queries.tokenizer_path())
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    capitals = [chr(c) for c in range(0x110000) if chr(c).isalpha() and chr(c) != chr(c).lower()]
    assert all(packing.lowered(f"a{c}") == "a" + c.lower() for c in capitals)


def test_nearest_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 24)) * rng.uniform(0.5, 2, size=(600, 1))
    x[50] = x[0]
    x[51] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 24), (1002, [float("nan")] * 24), (1003, [None] * 24), (1100, [1.0, 2.0]), rows[7]]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit(1))
    found = ann.nearest(vectors, F.col("vec_id") % 100 == 0).collect()
    hits = total = 0
    for q in range(0, 600, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(600), d))[:10]
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11))
        assert all(abs(r.score - d[r.vec_id]) < 1e-12 for r in own)
        hits, total = hits + len({r.vec_id for r in own} & set(best.tolist())), total + 10
    assert [r.vec_id for r in sorted((r for r in found if r.query_id == 0), key=lambda r: r.rank)][:2] == [50, 51]
    assert hits / total >= 0.9
    assert {r.query_id for r in found} == set(range(0, 600, 100))
    assert ann.nearest(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def brute_components(texts, size=3, threshold=90):
    sets = {}
    for i, t in texts.items():
        w = [x.lower() for x in (t or "").encode().split()]
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    label = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                x, y = sets[a], sets[b]
                if x and y and 100 * len(x & y) >= threshold * len(x | y) and label[a] < label[b]:
                    label[b], changed = label[a], True
    return {i: (len(sets[i]), label[i]) for i in texts}


def test_similarity_join_against_brute_force(spark):
    rng = np.random.default_rng(8)
    texts = []
    for family in range(12):
        base = text_of(family, int(rng.integers(20, 300))).split()
        for _ in range(int(rng.integers(1, 9))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 1 + len(base) // 40))):
                copy[int(rng.integers(len(copy)))] = f"new{rng.integers(1000)}"
            texts.append(" ".join(copy))
    texts += [None, "", "one", "ONE", "one two", "one  two", "one two three"]
    texts = dict(enumerate(texts))
    rows = ngram_join.linked(documents(spark, list(texts.values()))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts)
    kept = ngram_join.without_copies(documents(spark, list(texts.values()))).collect()
    assert {r.doc_id for r in kept} == {i for i, (_, c) in brute_components(texts).items() if c == i}


def test_pipeline_drops_near_copies_of_five_words_and_four_fifths(spark):
    import corpus_pipeline

    rng = np.random.default_rng(21)
    texts = []
    for family in range(14):
        base = text_of(500 + family, int(rng.integers(60, 300))).split()
        texts.append(" ".join(base))
        for changed in (1, 2, 3, 4):
            copy = list(base)
            for at in rng.choice(len(copy), max(1, changed * len(copy) // 150), replace=False):
                copy[int(at)] = f"new{rng.integers(1000)}"
            texts.append(" ".join(copy))
    texts += [None, "", "one", "ONE", "one two three four", "one two three four five"]
    strict, wide = brute_components(dict(enumerate(texts))), brute_components(dict(enumerate(texts)), 5, 80)
    # Copies between the two limits are there.
    assert sum(c == i for i, (_, c) in wide.items()) < sum(c == i for i, (_, c) in strict.items())
    docs = documents(spark, texts)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert {r.doc_id for r in kept} == {i for i, (_, c) in wide.items() if c == i}
    found = {r.doc_id: r.component_id for r in ngram_join.linked(docs, size=5, threshold=80).collect()}
    assert found == {i: c for i, (_, c) in wide.items()}


def test_similarity_join_of_odd_rows(spark, odd, empty):
    rows = ngram_join.linked(odd).collect()
    assert len(rows) == 12
    assert {r.component_id for r in rows if r.n_shingles == 58} == {5}
    assert ngram_join.linked(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(8, 60)]
    rows = components(spark.createDataFrame(chain + star, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in rows} == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 60)}}


def test_fingerprints_follow_the_next_document(spark):
    texts = [text_of(i, 30 + 7 * i) for i in range(40)] + [None, "x", "é" * 9]
    docs = documents(spark, texts)
    rows = {r.doc_id: r for r in fingerprint.edit_digest(docs, parts=7).collect()}
    for i, text in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(text) // 2
        edited = (text[: len(text) - half] + after[:half]).encode()
        assert rows[i].edited_sha256 == hashlib.sha256(edited).hexdigest()
        assert rows[i].fingerprint == fingerprint.digest(text.encode())
        assert rows[i].n_chars == len(text)
        assert rows[i].near_edited == fingerprint.likeness([rows[i].fingerprint], [rows[i].edited_fingerprint])[0]
    assert np.mean([rows[i].near_edited for i in range(40)]) > np.mean([rows[i].near_next for i in range(40)]) - 0.05
    assert fingerprint.likeness([rows[0].fingerprint], [rows[0].fingerprint])[0] == 1


def test_fingerprints_of_odd_rows(spark, odd, empty):
    assert fingerprint.edit_digest(odd).count() == 12
    assert fingerprint.edit_digest(odd.limit(1)).count() == 1
    assert fingerprint.edit_digest(empty).count() == 0


def test_shares_fill_up_and_pass_on():
    found = [s.target for s in mixing.shares([10, 100, 0, 1000], [3, 1, 2, 1])]
    assert found[0] == 30 and found[2] == 0 and sum(found) == pytest.approx(1110)
    assert found[1] == 300 and found[3] == pytest.approx(780)


def test_flow_prefers_what_is_not_repeated():
    flow = mixing.min_cost_flow({"a": 10, "ab": 10, "b": 10}, {"a": ["A"], "ab": ["A", "B"], "b": ["B"]}, {"A": 20, "B": 10})
    assert flow == {("a", "A"): 10, ("ab", "A"): 10, ("b", "B"): 10}
    flow = mixing.min_cost_flow({"a": 10, "ab": 10}, {"a": ["A"], "ab": ["A", "B"]}, {"A": 0, "B": 100})
    assert flow == {("ab", "B"): 30}


def test_mix_reaches_its_targets(spark, odd, empty):
    texts = [text_of(i, 5 + i % 17) for i in range(200)]
    docs = documents(spark, texts, source=[f"s{i % 3}" if i % 10 else None for i in range(200)])
    rows = mixing.mix_report(docs).collect()
    assert rows and sorted(rows) == sorted(mixing.mix_report(docs.repartition(5)).collect())
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        source = None if r.doc_id % 10 == 0 else r.doc_id % 3
        by.setdefault((source, r.target), []).append(r.taken)
    # Two sources have the same weight and so the same target.
    assert len(by) == 4 and all(abs(sum(v) - target) <= 1 for (_, target), v in by.items())
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = sum(len(r.text.split()) for r in mixed.collect())
    assert words == sum(r.taken for r in rows)
    assert len(mixing.mix_report(odd).collect()) == 12 and mixing.mixed(odd).columns == odd.columns
    assert mixing.mix_report(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_pipeline_mixes_whole_documents(spark, odd, empty):
    import corpus_pipeline

    texts = [text_of(700 + i, 5 + 3 * (i % 17)) for i in range(120)]
    docs = documents(spark, texts, source=[f"s{i % 3}" for i in range(120)])
    report = {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    assert any(r.taken % r.size for r in report.values())
    rows = corpus_pipeline.mix_sources(spark, docs, "").collect()
    assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in rows)
    copies = {i: sum(r.doc_id == i for r in rows) for i in report}
    assert copies == {i: r.taken // r.size + (2 * (r.taken % r.size) >= r.size) for i, r in report.items()}
    assert corpus_pipeline.mix_sources(spark, odd, "").columns == odd.columns
    assert corpus_pipeline.mix_sources(spark, empty, "").count() == 0


def test_quality_tells_marks_from_prose(spark, odd, empty):
    good = [text_of(i, 80) for i in range(60)]
    bad = [" ".join(w.upper() + "!!" for w in text_of(i, 60).split()) for i in range(60)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(5, None, 0), (999, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.train(docs, labels, F.col("doc_id") % 4 != 0)
    scores = {r.doc_id: r.s for r in docs.select("doc_id", quality.score_column(F.col("text"), model).alias("s")).collect()}
    assert min(scores[i] for i in range(0, 60, 4)) > 0.5 > max(scores[i] for i in range(60, 120, 4))
    assert all(0 <= r.s <= 1 for r in odd.select(quality.score_column(F.col("text"), model).alias("s")).collect())
    blank = quality.train(empty, labels.limit(0), F.lit(True))
    assert blank.score("anything") == 0.5


def test_quality_gradients_are_right():
    rng = np.random.default_rng(0)
    model = quality.new_model()
    model.weights = {k: np.array(v + 0.1 * rng.normal(size=v.shape), dtype=np.float64) for k, v in model.weights.items()}
    x, starts, y = rng.normal(size=(9, quality.FEATURES)) / 10, np.array([0, 2, 5]), np.array([1.0, 0.0, 1.0])

    def loss():
        s = model.forward(x, starts)["s"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    for name, grad in model.gradients(x, starts, y).items():
        w = model.weights[name]
        at = (0,) * w.ndim
        before = w[at].copy()
        w[at] = before + 1e-5
        up = loss()
        w[at] = before - 1e-5
        down = loss()
        w[at] = before
        assert np.asarray(grad)[at] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-8)


def test_language_of_held_out_texts(spark, odd, empty):
    kinds = {"aa": "tion the ing and of with".split(), "bb": "keit ung der die schön über".split()}
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(kinds["aa" if i % 2 else "bb"], 30)) for i in range(80)]
    docs = documents(spark, texts, lang=["aa" if i % 2 else "bb" for i in range(80)])
    model = language_id.train(docs, F.col("doc_id") % 5 != 0)
    rows = language_id.identify(docs, model).collect()
    assert all(r["__language"].lang == r.lang and not r["__language"].rejected for r in rows)
    found = {r.doc_id: r["__language"] for r in language_id.identify(odd, model).collect()}
    assert {found[i].lang for i in (0, 1, 9)} == {"und"} and found[9].score == 0 and found[0].rejected
    none = language_id.train(empty, F.lit(True))
    assert {r["__language"].lang for r in language_id.identify(docs, none).collect()} == {"und"}
