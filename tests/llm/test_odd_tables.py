"""Every registered query and the pipeline over odd tables and over empty ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trustmart.llm import language_id, queries
from trustmart.llm.common import crc_remainder

CLASHING = ("lines", "size", "node", "part", "score", "key", "n", "shard", "value", "component", "depth", "batch")
QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
#: Rows of one id are one document, or ids are handed on as they are: rows out for rows of documents.
PER_DOCUMENT = {f"op{n}_" for n in (1, 2, 7, 8, 9, 10, 12)}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Two folders of tables: null, empty and very long values, repeated rows, ties, null ids and
    columns with the names of inner ones; and the same tables without a row."""
    rng = np.random.default_rng(0)
    prose = [" ".join(rng.choice(["the", "house", "und", "le", "chat", "noch", "a", "line"], 50)) for _ in range(20)]
    texts = [None, "", " ", "a", "12 34 !!", "word " * 40_000, "\n".join(prose), "x" * 100_000, *prose, *prose[:6]]
    docs = [(i, t, None if i % 5 == 0 else ("en", "fr")[i % 2], None if i % 7 == 0 else f"s{i % 3}", 1) for i, t in enumerate(texts)]
    docs += [docs[9], docs[9], (None, prose[0], "en", "s0", 1), (None, None, None, None, None), (9, "other text", "en", "s1", None)]
    vectors = [(i, None if i == 3 else [float("nan")] * 8 if i == 4 else [0.0] * 8 if i == 5 else rng.normal(size=8).tolist()) for i in range(120)]
    turns = [(c, t, None if t == 1 else "user", None if t == 2 else f"t{t}") for c in range(30) for t in range(4)]
    turns += [turns[0], turns[0], (1, None, "user", "no turn"), (None, 1, "user", "nobody")]
    tables = {
        "documents": (docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        "labels": ([(i, i % 2 if i % 6 else None, 0) for i in range(30)] * 2 + [(None, 1, 0)], "doc_id bigint, quality int, toxic int"),
        "embeddings": (vectors + vectors[7:9], "vec_id bigint, embedding array<double>"),
        "conversations": (turns, "conv_id bigint, turn int, role string, text string"),
    }
    root = tmp_path_factory.mktemp("odd")
    for kind in ("odd", "empty"):
        for name, (rows, schema) in tables.items():
            df = spark.createDataFrame(rows, schema)
            df = df.limit(0) if kind == "empty" else df
            df.withColumns({c: F.lit("x") for c in CLASHING}).write.parquet(f"{root}/{kind}/{name}.parquet")
    return str(root), len(docs)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_tables_give_whole_results(spark, folders, name):
    rows = QUERIES[name](spark, f"{folders[0]}/odd").collect()
    if any(name.startswith(p) for p in PER_DOCUMENT):
        assert len(rows) == folders[1]
    if name == "op1_quality":
        assert all(0 <= r.score <= 1 for r in rows)
    assert rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, folders, name):
    assert QUERIES[name](spark, f"{folders[0]}/empty").collect() == []


def test_copies_of_a_row_are_drawn_once(spark, monkeypatch):
    rows = spark.range(4000).select((F.col("id") % 2000).alias("doc_id"), F.lit("le chat est la").alias("text"), F.lit("fr").alias("lang"))
    rows = rows.withColumn("doc_id", F.when(F.col("doc_id") < 1000, 7).otherwise(F.col("doc_id")))
    seen = []
    monkeypatch.setattr(language_id, "spherical_kmeans", lambda x, k: seen.append(len(x)) or x[:1])
    language_id.train(rows, crc_remainder("doc_id", 4) != 9, per_language=2000)
    assert seen[0] <= 1001
