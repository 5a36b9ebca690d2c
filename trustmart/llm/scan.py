"""Running numbers and sums within keys of any size.

A window over a key works through the whole key in one task. Here rows are dealt to tasks by ranges of
(key, order), so a key of a third of all rows lies in many tasks; each task runs through its rows once
and what a key has gathered in earlier tasks is added afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.llm.common import ship, stored

NTH = "__nth"


def _combine(kind: str, a, b):
    return a ^ b if kind == "xor" else a + b


def _segment_totals(kind: str, values: np.ndarray, begins: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Running totals that begin anew at each of ``begins``; ``segment`` numbers the rows' segments."""
    if kind == "xor":
        total = np.bitwise_xor.accumulate(values)
        return total ^ (total[begins] ^ values[begins])[segment]
    total = np.cumsum(values)
    return total - (total[begins] - values[begins])[segment]


def scan(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    sums: Sequence[str] = (),
    xors: Sequence[str] = (),
    name: str = "scan",
) -> DataFrame:
    """``df`` with ``__nth`` (place of the row within ``key``, from 1) and, for each of the bigint
    columns ``sums`` and ``xors``, ``__run_<column>``: its total over the key's rows up to this one.

    ``key`` is a bigint column without nulls, and so are the summed columns. The sorted rows are
    written once; hand in narrow ones. One row for each task reaches the driver. An empty table gives
    an empty one; rows that ``order`` does not tell apart stand in any order.
    """
    spark = df.sparkSession
    ship(spark)
    kinds = [(NTH, "sum"), *[(c, "sum") for c in sums], *[(c, "xor") for c in xors]]
    runs = [NTH, *[f"__run_{c}" for c in [*sums, *xors]]]
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        first, last, carried, rows = None, None, [np.int64(0)] * len(kinds), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(columns.index(key)).to_numpy(zero_copy_only=False)
            first = keys[0] if first is None else first
            begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            segment = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, n)))
            goes_on = (segment == 0) & bool(last is not None and keys[0] == last)
            totals = []
            for i, (column, kind) in enumerate(kinds):
                if column == NTH:
                    values = np.ones(n, dtype=np.int64)
                else:
                    values = batch.column(columns.index(column)).to_numpy(zero_copy_only=False)
                found = _segment_totals(kind, values, begins, segment)
                found = np.where(goes_on, _combine(kind, found, carried[i]), found)
                carried[i] = found[-1]
                totals.append(pa.array(found, pa.int64()))
            last = keys[-1]
            place = pa.array(np.arange(rows, rows + n), pa.int64())
            rows += n
            lead = pa.array(keys == first)
            parts = pa.array(np.full(n, part, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *totals, parts, place, lead], names=[*columns, *runs, "__part", "__row", "__lead"]
            )

    added = ", ".join(f"{c} bigint" for c in runs) + ", __part int, __row bigint, __lead boolean"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", " + added
    sorted_rows = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    rows = stored(sorted_rows.mapInArrow(run, schema), name)
    # One row for each task: its first key, its last key and what that has come to.
    ends = (
        rows.groupBy("__part")
        .agg(F.min_by(key, "__row").alias("first"), F.max_by(F.struct(F.col(key).alias("key"), *runs), "__row").alias("end"))
        .orderBy("__part")
        .collect()
    )
    carry, before, key_before = [], [0] * len(runs), None
    for r in ends:
        mine = list(before) if r["first"] == key_before else [0] * len(runs)
        carry.append((r["__part"], *mine))
        own = [r["end"][c] for c in runs]
        goes_on = r["end"]["key"] == r["first"]
        before = [_combine(k, a, b) for (_, k), a, b in zip(kinds, mine, own, strict=True)] if goes_on else own
        key_before = r["end"]["key"]
    names = ", ".join(f"c{i} bigint" for i in range(len(runs)))
    carries = spark.createDataFrame(carry, f"__of int, {names}")
    joined = rows.join(F.broadcast(carries), F.col("__part") == F.col("__of"), "left")
    total = {}
    for i, (c, (_, kind)) in enumerate(zip(runs, kinds, strict=True)):
        earlier = F.when(F.col("__lead"), F.col(f"c{i}")).otherwise(F.lit(0).cast("bigint"))
        total[c] = F.col(c).bitwiseXOR(earlier) if kind == "xor" else F.col(c) + earlier
    return joined.withColumns(total).select(*columns, *runs)
