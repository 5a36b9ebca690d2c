"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` bytes. Every passage is encoded by what it is written
like (hashed byte pairs, how often they come again, and shares of byte classes) and a learned layer; gated attention, learned
from the labels of whole documents, weighs the passages; the weighted sum is scored from 0 to 1.
Only the text is an input.

The model is fitted on a bounded sample of labelled documents: about ``documents`` of them, drawn by
hash of the id, with at most ``passages`` evenly spread passages each. Scoring reads every passage of
every text, where its row is.

Null and empty texts are one empty passage and get a score like any other. Documents with several
labels count as the mean of them, null labels not at all; without labels all texts score 0.5. An
empty table gives an empty result; extra columns are carried along by :func:`score_column`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.llm.common import ship, text_of

PASSAGE = 512
PAIRS = 256
CLASSES = 8
#: How often pairs come again: kinds of pairs, the commonest one's share, sum of squared shares.
REPEATS = 3
FEATURES = PAIRS + CLASSES + REPEATS
HIDDEN, ATTENTION = 32, 16


def _byte_classes() -> np.ndarray:
    """Lower, upper, digit, blank, line end, sentence mark, other mark, beyond ASCII."""
    of = np.full(256, 6, dtype=np.int64)
    of[ord("a") : ord("z") + 1] = 0
    of[ord("A") : ord("Z") + 1] = 1
    of[ord("0") : ord("9") + 1] = 2
    of[ord(" ")] = 3
    of[ord("\n")] = 4
    of[[ord(c) for c in ".,"]] = 5
    of[128:] = 7
    return of


CLASS_OF = _byte_classes()


def passages(text: str) -> np.ndarray:
    """One row of features for each passage of the whole text."""
    b = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    n = max(1, -(-len(b) // PASSAGE))
    out = np.zeros((n, FEATURES), dtype=np.float32)
    if not len(b):
        return out
    where = np.arange(len(b)) // PASSAGE
    shares = np.bincount(where * CLASSES + CLASS_OF[b], minlength=n * CLASSES).reshape(n, CLASSES)
    pairs = b[:-1].astype(np.uint32) | (b[1:].astype(np.uint32) << np.uint32(8))
    pairs = (pairs * np.uint32(2654435761)) >> np.uint32(24)
    counts = np.bincount(where[:-1] * PAIRS + pairs, minlength=n * PAIRS).reshape(n, PAIRS)
    total = np.maximum(counts.sum(axis=1), 1)
    out[:, -3] = (counts > 0).sum(axis=1) / np.minimum(total, PAIRS)
    out[:, -2] = 4 * counts.max(axis=1) / total
    out[:, -1] = 8 * (counts.astype(np.float64) ** 2).sum(axis=1) / total**2
    counts = np.log1p(counts)
    out[:, :PAIRS] = counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    out[:, PAIRS:-REPEATS] = shares / np.bincount(where, minlength=n)[:, None]
    return out


@dataclass
class AttentionModel:
    """Weights by name: encoder W, b; gated attention V, U, w; head c, d."""

    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Activations for bags whose passages begin at ``starts``."""
        p = self.weights
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        lengths = np.diff([*starts, len(x)])
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), lengths))
        a = e / np.repeat(np.add.reduceat(e, starts), lengths)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "s": s, "lengths": lengths}

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        p, f = self.weights, self.forward(x, starts)
        ds = (f["s"] - y) / len(y)
        dz = np.repeat(ds[:, None] * p["c"], f["lengths"], axis=0)
        da = (dz * f["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(f["a"] * da, starts), f["lengths"])
        de = f["a"] * (da - mean)
        dt = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        du = dh * (1 - f["h"] ** 2)
        return {
            "W": x.T @ du, "b": du.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
            "w": ((f["t"] * f["g"]) * de[:, None]).sum(axis=0), "c": f["z"].T @ ds, "d": ds.sum(),
        }

    def score(self, text: str) -> float:
        x = passages(text)
        return float(self.forward(x, np.array([0]))["s"][0])


def new_model(seed: int = 5) -> AttentionModel:
    rng = np.random.default_rng(seed)
    size = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    return AttentionModel(
        {
            "W": 2 * size(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32),
            "V": size(HIDDEN, ATTENTION), "U": size(HIDDEN, ATTENTION), "w": size(ATTENTION),
            "c": np.zeros(HIDDEN, np.float32), "d": np.zeros((), np.float32),
        }
    )


def fitted(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 30, batch: int = 64) -> AttentionModel:
    """Adam over small batches of bags, in an order that depends on nothing but their number."""
    model, rng = new_model(), np.random.default_rng(11)
    if not len(bags):
        return model
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), batch):
            some = order[at : at + batch]
            x = np.concatenate([bags[i] for i in some])
            starts = np.cumsum([0] + [len(bags[i]) for i in some[:-1]])
            step += 1
            for k, g in model.gradients(x, starts, labels[some]).items():
                g = g + 1e-4 * model.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                model.weights[k] = (model.weights[k] - rate * move).astype(np.float32)
    return model


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, documents: int = 3000, most_passages: int = 24
) -> AttentionModel:
    """Fits a model on a sample of the labelled rows where ``learn`` (over ``doc_id``) holds."""
    ship(docs.sparkSession)
    marks = (
        labels.filter(learn & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("quality"))
    )
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # The sample is bounded by ``documents`` and a few spare rows, so it may be sent to every task.
    share = min(1.0, documents / max(1, marks.count()))
    sample = marks.filter(draw < share * (1 << 30)).limit(2 * documents)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), "doc_id")
    # One text for each drawn id, however often its rows are repeated.
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = []
            for text in batch["text"]:
                x = passages(text)
                if len(x) > most_passages:
                    x = x[np.linspace(0, len(x) - 1, most_passages).round().astype(int)]
                own.append(x.astype(np.float16).tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "bag": own})

    schema = "doc_id bigint, quality double, bag binary"
    drawn = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality", "text").mapInPandas(bags, schema)
    drawn = sorted(drawn.collect(), key=lambda r: (r["doc_id"], bytes(r["bag"])))
    x = [np.frombuffer(r["bag"], dtype=np.float16).reshape(-1, FEATURES).astype(np.float32) for r in drawn]
    return fitted(x, np.array([r["quality"] for r in drawn], dtype=np.float32))


def score_column(text: Column, model: AttentionModel) -> Column:
    """Score of a text column, null taken as empty; the model has a fixed size of about ten thousand
    numbers."""

    ship()

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(model.score).astype("float64")

    return score(F.coalesce(text.cast("string"), F.lit("")))
