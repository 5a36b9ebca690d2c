"""Language identification by nearest centroid.

A text is the vector of its hashed character n-grams (one to three code points, lower case,
all that is not a letter in ASCII as one blank), damped
term counts times inverse document frequency, at unit length. Each language has several centroids,
found by spherical k-means over training texts of that language; a text gets the language of the
centroid with the largest cosine. A text whose cosine stays below the distance that nearly all
training texts of that language keep is rejected.

Document frequencies count all training documents. The centroids are fitted on a bounded sample:
about ``per_language`` texts of each language, an even draw by a hash of text and id that does not
depend on how rows are stored. Vectors of whole texts are made where the rows are read.

Null texts and texts without a letter are ``und`` with score 0 and rejected. Rows with a null
``lang`` are never learnt from; without any training row every text is ``und``. Repeated rows count
again; extra columns are not looked at, and :func:`identify` carries them along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.llm.common import ship

UNKNOWN = "und"
BITS = 12
DIMENSIONS = 1 << BITS
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    #: One row for each centroid, at unit length, and the index of its language.
    centroids: np.ndarray
    of: np.ndarray
    #: Least cosine by language; below, a text is rejected.
    least: np.ndarray


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed 1-, 2- and 3-grams of code points."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    # ASCII marks, digits and blanks tell where words end and nothing else.
    codes = np.where((codes < 128) & ((codes < 97) | (codes > 122)), np.uint32(32), codes)
    blank = codes == 32
    codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))] if len(codes) else codes
    counts = np.zeros(DIMENSIONS, dtype=np.float32)
    shift = np.uint32(32 - BITS)
    mixed = codes * _MULTIPLIERS[0]
    for n in (1, 2, 3):
        if n > 1:
            mixed = (mixed[: len(codes) - n + 1] ^ (mixed[: len(codes) - n + 1] >> np.uint32(15))) * _MULTIPLIERS[n - 1]
            mixed = mixed + codes[n - 1 :] * _MULTIPLIERS[0]
        if not len(mixed):
            break
        counts += np.bincount((mixed * _MULTIPLIERS[1]) >> shift, minlength=DIMENSIONS)
    return counts


def _vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    out = np.empty((len(texts), DIMENSIONS), dtype=np.float32)
    for i, text in enumerate(texts):
        out[i] = np.log1p(ngram_counts(text)) * idf
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms > 0, norms, 1)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts and, for each hashed n-gram, in how many texts it is found.

    Each task sends one row for each n-gram number, however many texts it has seen.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, found = 0, np.zeros(DIMENSIONS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                found += ngram_counts(text) > 0
                total += 1
        yield pd.DataFrame({"gram": np.arange(-1, DIMENSIONS), "n": np.concatenate([[total], found])})

    rows = texts.select("text").mapInPandas(count, "gram int, n bigint")
    # DIMENSIONS + 1 rows reach the driver.
    sums = {r["gram"]: r["n"] for r in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    return sums.get(-1, 0), np.array([sums.get(i, 0) for i in range(DIMENSIONS)], dtype=np.float64)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` unit centroids; begins with texts that lie far from each other."""
    seeds = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(seeds) < min(k, len(x)):
        nearest = (x @ x[seeds].T).max(axis=1)
        far = int(np.argmin(nearest))
        if nearest[far] > 0.999:
            break
        seeds.append(far)
    centroids = x[seeds]
    for _ in range(rounds):
        own = np.argmax(x @ centroids.T, axis=1)
        sums = np.stack([x[own == c].sum(axis=0) if (own == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids.astype(np.float32)


def train(
    docs: DataFrame,
    learn: Column,
    clusters: int = 4,
    per_language: int = 500,
    quantile: float = 0.001,
    slack: float = 0.5,
) -> LanguageModel:
    """Fits the centroids on rows where ``learn`` holds, by ``text`` and ``lang`` alone.

    About ``per_language`` texts of each language are drawn by hash. ``slack`` times the cosine that
    all but ``quantile`` of them reach is the least cosine of that language.
    """
    ship(docs.sparkSession)
    rows = docs.filter(learn & F.col("lang").isNotNull()).select(
        "doc_id", "text", F.col("lang").cast("string").alias("lang")
    )
    # One row for each language reaches the driver.
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    rows = rows.filter(F.col("text").rlike(r"\p{L}"))
    total, found = document_frequencies(rows)
    idf = (np.log((1 + total) / (1 + found)) + 1).astype(np.float32)
    share = F.lit(0.0)
    for language, n in sizes.items():
        share = F.when(F.col("lang") == language, min(1.0, per_language / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30))
    # Copies of a row are drawn together and count once.
    drawn = _as_bytes(rows.filter(draw < share * (1 << 30)).distinct(), idf).collect()
    centroids, of, least, languages = [], [], [], []
    for language in sorted(sizes):
        x = np.array([np.frombuffer(r["v"], dtype=np.float32) for r in drawn if r["lang"] == language])
        if not len(x):
            continue
        # Rows come in any order; their sums must not.
        x = x[np.lexsort(x[:, :16].T)]
        own = spherical_kmeans(x, clusters)
        centroids.append(own)
        of += [len(languages)] * len(own)
        least.append(slack * float(np.quantile((x @ own.T).max(axis=1), quantile)))
        languages.append(language)
    if not languages:
        centroids = [np.zeros((0, DIMENSIONS), np.float32)]
    return LanguageModel(
        tuple(languages), idf, np.concatenate(centroids), np.array(of, dtype=int), np.array(least)
    )


def _as_bytes(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [_vectors([t], idf)[0].tobytes() for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "v": own})

    return texts.select("lang", "text").mapInPandas(vectors, "lang string, v binary")


def prediction(text: Column, model: LanguageModel) -> Column:
    """Struct of ``lang``, ``score`` (cosine, 0 to 1) and ``rejected`` for a text column.

    The model has a fixed size: a few centroids of ``DIMENSIONS`` numbers for each language.
    """

    ship()

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, scores, rejected = [], [], []
        for at in range(0, len(texts), 256):
            some = texts.iloc[at : at + 256].tolist()
            known = [has_letter(t) and len(model.languages) > 0 for t in some]
            x = _vectors([t for t, k in zip(some, known, strict=True) if k], model.idf)
            cosines = x @ model.centroids.T
            rows = iter(cosines)
            for k in known:
                if not k:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                row = next(rows)
                best = int(np.argmax(row))
                lang = int(model.of[best])
                langs.append(model.languages[lang])
                scores.append(float(np.clip(row[best], 0, 1)))
                rejected.append(bool(row[best] < model.least[lang]))
        return pd.DataFrame({"lang": langs, "score": scores, "rejected": rejected})

    return predict(text)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with a struct ``__language``."""
    return docs.withColumn("__language", prediction(F.col("text"), model))
