"""Document fingerprints by quartile bucket digest.

Byte triplets of a text are hashed into 256 buckets and counted: from every window of five bytes
the triplets that begin with its first byte. Each bucket is then told by the quartile its count lies
in (2 bits), next to the length on a logarithmic scale and the ratios of the quartiles. Two digests
are compared by a difference score: the sum over buckets of the distance of their quartiles (far
ones count more), plus the distances of length and ratios, bounded by a fixed maximum; likeness is 1
at no difference and 0 at the maximum.

Equal texts have equal digests. Null texts are empty ones; texts under three bytes have no triplet
and compare by their length and a check sum. Work on a text is one pass where its row is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.llm.common import ship, text_of

BUCKETS = 256
#: Offsets of the second and third byte of a triplet behind its first one.
TRIPLETS = ((1, 2), (1, 3), (2, 4))
#: Differences of two quartiles cost 0, 1, 3 and 6.
COSTS = np.array([0, 1, 3, 6], dtype=np.int64)
LENGTH_COST, RATIO_COST = 2, 2
#: The score is bounded here; unrelated texts lie about or beyond it.
MOST = 480


def bucket_counts(data: bytes) -> np.ndarray:
    """Counts of the hashed byte triplets of all windows."""
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for salt, (second, third) in enumerate(TRIPLETS):
        n = len(b) - third
        if n <= 0:
            continue
        # Multiplied and shifted, so that every bit of the three bytes reaches the bucket.
        code = b[:n] | (b[second : n + second] << np.uint32(8))
        code |= b[third:] << np.uint32(16)
        code += np.uint32(salt << 24)
        code *= np.uint32(2654435761)
        code ^= code >> np.uint32(15)
        code *= np.uint32(2246822519)
        counts += np.bincount(code >> np.uint32(24), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> str:
    """Hexadecimal: length (2 digits), ratios (2), check sum (2), quartiles of 256 buckets (128)."""
    counts = bucket_counts(data)
    ordered = np.sort(counts)
    q1, q2, q3 = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1])
    length = min(255, round(12 * np.log1p(len(data))))
    ratios = [(q * 16 // q3) % 16 if q3 else 0 for q in (q1, q2)]
    check = sum(data) % 256
    return bytes([length, ratios[0] * 16 + ratios[1], check]).hex() + packed.astype(np.uint8).tobytes().hex()


def _parts(digests: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(digests)), dtype=np.uint8).reshape(len(digests), -1)
    raw = raw.astype(np.int64)
    body = np.stack([raw[:, 3:] >> s & 3 for s in (6, 4, 2, 0)], axis=2).reshape(len(digests), -1)
    return raw[:, 0], np.stack([raw[:, 1] >> 4, raw[:, 1] & 15], axis=1), raw[:, 2], body


def _around(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    d = np.abs(a - b)
    return np.minimum(d, size - d)


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness from 0 to 1 of the digests in two lists, position by position."""
    if not a:
        return np.zeros(0)
    (la, ra, ca, ba), (lb, rb, cb, bb) = _parts(a), _parts(b)
    far = COSTS[np.abs(ba - bb)].sum(axis=1)
    far = far + LENGTH_COST * np.maximum(0, np.abs(la - lb) - 1)
    far = far + RATIO_COST * np.maximum(0, _around(ra, rb, 16) - 1).sum(axis=1) + (ca != cb)
    return 1 - np.minimum(far, MOST) / MOST


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``__fingerprint``."""

    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: digest(t.encode("utf-8")))

    return docs.withColumn("__fingerprint", of(text_of()))


def in_order(docs: DataFrame, key: str, parts: int) -> DataFrame:
    """``docs`` dealt into ranges of ``key``, ordered inside, with ``__part`` and ``__tail``.

    The rows with the first key of a range stand a second time (``__tail``) at the end of the range
    before it, those with the smallest key of all at the end of the last: so a task that walks along
    a range knows what follows its last row. About ``parts`` bounds reach the driver.
    """
    ids = docs.select(F.col(key).cast("bigint").alias("k"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    row = ids.agg(
        F.min("k").alias("first"),
        F.percentile_approx("k", shares, 100 * parts).alias("b"),
        F.count_if(F.col("k").isNull()).alias("without"),
    ).first()
    smallest = row["first"]
    bounds = sorted({b for b in (row["b"] or []) if b > smallest})
    last = len(bounds)
    k = F.col(key).cast("bigint")
    if bounds:
        place = F.expr(f"array({','.join(f'{b}L' for b in bounds)})")
        # Rows without an id come first, as ascending order has them.
        part = F.size(F.filter(place, lambda b: b <= F.coalesce(k, F.lit(smallest))))
        first = F.array_contains(place, F.coalesce(k, F.lit(smallest)))
    else:
        part, first = F.lit(0), F.lit(False)
    head = k.isNull() if row["without"] else k.eqNullSafe(F.lit(smallest).cast("bigint"))

    def spot(wanted: Column, p: Column, tail: bool) -> Column:
        return F.when(wanted, F.struct(p.cast("int").alias("part"), F.lit(tail).alias("tail")))

    spots = F.array_compact(
        F.array(spot(F.lit(True), part, False), spot(first, part - 1, True), spot(head, F.lit(last), True))
    )
    dealt = docs.withColumn("__spot", F.explode(spots))
    dealt = dealt.withColumns({"__part": F.col("__spot.part"), "__tail": F.col("__spot.tail")}).drop("__spot")
    return dealt.repartition(last + 1, "__part")


def edit_digest(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next text's are.

    The edited text is the text with its last half replaced by the beginning of the next document.
    Documents stand in ascending order of ``doc_id`` (null first), then of text; the first follows
    the last. A single document follows itself.
    """
    spark = docs.sparkSession
    ship(spark)
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    dealt = in_order(narrow, "doc_id", parts).sortWithinPartitions(
        "__part", "__tail", F.col("doc_id").asc_nulls_first(), "text"
    )
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple | None = None  # part, id, text, fingerprint of the row that waits for its next
        for batch in batches:
            rows, edits, nexts = [], [], []
            ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"].astype(object)]
            for part, tail, doc_id, text in zip(
                batch["__part"], batch["__tail"], ids, batch["text"], strict=True
            ):
                if tail and last is None:
                    continue
                own = digest(text.encode("utf-8"))
                if last is not None and last[0] == part:
                    _, before_id, before, before_print = last
                    half = len(before) // 2
                    edited = (before[: len(before) - half] + text[:half]).encode("utf-8")
                    edits.append(digest(edited))
                    nexts.append(own)
                    rows.append((before_id, len(before), hashlib.sha256(edited).hexdigest(), before_print))
                last = None if tail else (part, doc_id, text, own)
            prints = [r[3] for r in rows]
            yield pd.DataFrame(
                {
                    "doc_id": pd.array([r[0] for r in rows], dtype="Int64"),
                    "n_chars": np.array([r[1] for r in rows], dtype=np.int64),
                    "edited_sha256": [r[2] for r in rows],
                    "fingerprint": prints,
                    "edited_fingerprint": edits,
                    "near_edited": likeness(prints, edits),
                    "near_next": likeness(prints, nexts),
                }
            )

    return dealt.mapInPandas(
        walk,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
