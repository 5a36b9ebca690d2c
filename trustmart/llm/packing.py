"""Packing token sequences by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: full ``max_length`` pieces
first, then the binary digits of what is left, largest first. Every piece is a sequence of its own,
so no sequence crosses documents and none is padded; sequences of one length form a bucket and are
numbered one after the other.

Texts are tokenised where they are read. White space always ends a word of this kind of vocabulary,
so ids are worked out once for each distinct word that a task meets and put together from there;
the store of words is bounded by ``MEMO`` and begins anew when it is full. Only counts of sequences
(one row for each task and length) are shuffled.

Null and empty texts are one piece, the end id alone; repeated rows are packed each for itself; an
empty table gives no sequence; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustmart.llm.common import ship, stored

#: Words that a worker keeps with their ids, about 200 bytes each, and words of the texts that are
#: encoded together; a longer text is encoded alone.
MEMO, GROUP = 500_000, 300_000
#: Letters with ASCII marks behind them (no apostrophe): the marks are a word of their own.
LETTERS_AND_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")


def lowered(word: str) -> str:
    """Lower-cased character by character, as the tokenizer does it: ``str.lower`` alone makes another
    sigma of a capital one at the end of a word."""
    return word.replace("\u03a3", "\u03c3").lower()


class WordIds:
    """Ids of texts under a tokenizer that lower-cases, drops white space and marks word ends.

    Gives the same ids as ``encode(text, add_special_tokens=False)``, as little-endian unsigned 32-bit
    numbers.
    """

    def __init__(self, path: str):
        # Spark runs one task a core; more threads would only take turns.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model = json.loads(self.tokenizer.to_str())["model"]
        suffix = model.get("end_of_word_suffix")
        if not suffix:
            raise ValueError("the tokenizer must mark the ends of words")
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.is_end[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
        self.memo: dict[str, bytes] = {"": b""}

    def _alone(self, chunk: str) -> bytes:
        ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _learn(self, chunks: set[str]) -> None:
        """Adds the ids of chunks without blanks to the store, many words in one call."""
        memo = self.memo
        parts = {c: m.groups() for c in chunks if (m := LETTERS_AND_MARKS.fullmatch(c))}
        new = {lowered(core) for core, _ in parts.values()}
        new = [w for w in new if w not in memo]
        groups = [new[at : at + 100] for at in range(0, len(new), 100)]
        encoded = self.tokenizer.encode_batch_fast(
            [" ".join(some) for some in groups], add_special_tokens=False
        )
        for some, encoding in zip(groups, encoded, strict=True):
            ids = np.array(encoding.ids, dtype="<u4")
            ends = (4 * np.flatnonzero(self.is_end[ids]) + 4).tolist()
            if len(ends) == len(some) and ends[-1] == 4 * len(ids):
                data = ids.tobytes()
                for word, begin, end in zip(some, [0, *ends[:-1]], ends, strict=True):
                    memo[word] = data[begin:end]
            else:
                memo.update((word, self._alone(word)) for word in some)
        for chunk in chunks:
            core, marks = parts.get(chunk, (None, ""))
            if core is None:
                memo[chunk] = self._alone(chunk)
                continue
            if marks and marks not in memo:
                memo[marks] = self._alone(marks)
            memo[chunk] = memo[lowered(core)] + memo[marks]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; texts are looked at in groups, so that new words are encoded together."""
        group: list[list[str]] = []
        new: set[str] = set()
        size = 0
        for text in texts:
            chunks = text.replace("\n", " ").replace("\t", " ").split(" ")
            group.append(chunks)
            new.update(chunks)
            size += len(chunks)
            if size > GROUP:
                yield from self._settle(group, new)
                group, new, size = [], set(), 0
        yield from self._settle(group, new)

    def _settle(self, group: list[list[str]], new: set[str]) -> Iterator[bytes]:
        self._learn(new.difference(self.memo))
        get = self.memo.__getitem__
        for chunks in group:
            yield b"".join(map(get, chunks))
        if len(self.memo) > MEMO:
            # What the last texts needed stays, frequent words with it.
            self.memo = {"": b"", **{c: self.memo[c] for c in new}}


_CODERS: dict[str, WordIds] = {}


def coder(path: str) -> WordIds:
    """One for each Python worker, which runs many tasks and keeps the words it has learnt."""
    if path not in _CODERS:
        _CODERS[path] = WordIds(path)
    return _CODERS[path]


def binary_lengths(n: int, longest: int) -> Iterator[int]:
    """Powers of two that add up to ``n``, none above ``longest``, largest first."""
    yield from [longest] * (n // longest)
    rest, bit = n % longest, longest
    while rest:
        bit >>= 1
        if rest & bit:
            yield bit
            rest -= bit


PIECE = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, "
    "nth bigint"
)


def pieces_of(
    docs: DataFrame, tokenizer_path: str, end_id: int, max_length: int, with_ids: bool
) -> DataFrame:
    """One row for each piece. ``nth`` counts the pieces of one length in the task ``part``."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    ship(docs.sparkSession)
    schema = T.StructType.fromDDL(PIECE + ", ids array<int>" * with_ids)
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}
    arrow = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        words = coder(tokenizer_path)
        end = end_id.to_bytes(4, "little")
        counts: dict[int, int] = {}
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in arrow.names}
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, ids in zip(doc_ids, words.encode([t or "" for t in texts]), strict=True):
                ids += end
                whole, start = len(ids) // 4, 0
                for length in binary_lengths(whole, max_length):
                    own = ids[4 * start : 4 * (start + length)]
                    nth = counts.get(length, 0)
                    counts[length] = nth + 1
                    row = (doc_id, start, length, zlib.crc32(own), whole, part, nth)
                    for name, value in zip(columns, row, strict=False):
                        columns[name].append(value)
                    if with_ids:
                        columns["ids"].append(memoryview(own).cast("i").tolist())
                    start += length
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    max_length: int = 4096,
    with_ids: bool = True,
) -> DataFrame:
    """All pieces with ``sequence_id`` and ``offset``; ``ids`` holds the tokens if asked for.

    Sequences are numbered from 0 without gaps, bucket by bucket, shortest first. ``tokenizer_path``
    must lead to the same file on every executor.
    """
    pieces = stored(pieces_of(docs, tokenizer_path, end_id, max_length, with_ids), "pieces")
    # A row for each task and length, whatever the size of the texts in it: at most 13 a task.
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n"))
    earlier = W.orderBy("length").rowsBetween(W.unboundedPreceding, -1)
    # One row for each power of two.
    bases = buckets.select("length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    ).join(bases, "length")
    return (
        pieces.join(starts, ["length", "part"])
        .withColumn("sequence_id", F.col("base") + F.col("shift") + F.col("nth"))
        .withColumn("offset", F.lit(0).cast("bigint"))
        .drop("part", "nth", "base", "shift")
    )


def packing_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return pack(docs, tokenizer_path, with_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
