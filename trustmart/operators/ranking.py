"""Ranking operators that never sort a whole table, or one hot key, in a single task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustmart.operators.joins import lookup

def sequence_within(
    df: DataFrame, key: str, ts: str, tie_break: str, out: str, store: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Running number of each row within ``key``, by ``ts`` (NULLS LAST), then ``tie_break``.

    Equals ``row_number()`` per key (NULL is a key), whatever the size of the table or of a key. The
    rows are dealt to tasks by ranges of (key, ts, tie_break), so no key, instant or common beginning
    of ids fills one task. A row's place in the whole order is its place in its part plus the rows of
    earlier parts; its number counts from the place of its key's first row.

    ``store`` writes the sorted rows and returns the stored table: places must not be worked out
    twice, since ranges are drawn from a sample. Hand in a narrow frame.
    """
    in_time = [F.col(ts).asc_nulls_last(), F.col(tie_break).asc_nulls_last()]
    order = [F.col(key).asc_nulls_first(), *in_time]
    # The upper bits of this id are the part, the lower 33 the place in it.
    placed = store(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
    ).withColumns(
        {
            "__part": F.shiftright("__id", 33),
            "__place": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)),
            # Never NULL, and a NULL key cannot collide with any text.
            "__key": F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null")),
        }
    )
    # One row per part, so the window and the broadcast hold as many rows as the shuffle has partitions.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select(
        F.col("__part").alias("__of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
    )
    placed = placed.join(F.broadcast(parts), F.col("__part") == F.col("__of"))
    placed = placed.withColumn("__place", F.col("__place") + F.col("__before"))
    firsts = placed.groupBy(F.col("__key").alias("__first_key")).agg(F.min("__place").alias("__first"))
    return (
        lookup(placed, firsts, "__key", "__first_key", "inner")
        .withColumn(out, F.col("__place") - F.col("__first") + 1)
        .drop("__id", "__part", "__of", "__place", "__before", "__key", "__first")
    )


def top_n(df: DataFrame, measure: str, n: int, tie_break: str) -> DataFrame:
    """The ``n`` rows with the largest measure; ties go to the smaller ``tie_break``."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(tie_break).asc_nulls_last()).limit(n)


def share(df: DataFrame, measure: str, out: str) -> DataFrame:
    """Adds each row's share of the column total (NULL when the total is zero)."""
    total = df.agg(F.sum(measure).cast("double").alias("__total"))
    return (
        df.crossJoin(F.broadcast(total))
        .withColumn(out, F.col(measure).cast("double") / F.nullif(F.col("__total"), F.lit(0.0)))
        .drop("__total")
    )


def concentration(
    df: DataFrame,
    key: str,
    measure: str,
    ks: Sequence[int] = (5, 10, 50),
    entity: str = "seller",
    total_name: str = "total_gmv_revenue_eligible",
) -> DataFrame:
    """Value and share held by the top k keys; no row at all for empty input.

    Only the ``max(ks)`` leading rows are ever ranked together; the total is a plain aggregate.
    """
    totals = df.groupBy(key).agg(F.sum(measure).alias("__value"))
    leaders = top_n(totals, "__value", max(ks), key)
    ranked = leaders.withColumn(
        "__rank",
        F.row_number().over(
            Window.orderBy(F.col("__value").desc_nulls_last(), F.col(key).asc_nulls_last())
        ),
    )
    tops = ranked.agg(
        F.count(F.lit(1)).alias("__keys"),
        *[
            F.sum(F.when(F.col("__rank") <= k, F.col("__value")).otherwise(F.lit(0)))
            .cast("double")
            .alias(f"top_{k}_{entity}_gmv")
            for k in ks
        ],
    )
    grand = totals.agg(F.sum("__value").cast("double").alias(total_name))
    return (
        tops.filter(F.col("__keys") > 0)
        .crossJoin(F.broadcast(grand))
        .select(
            total_name,
            *[f"top_{k}_{entity}_gmv" for k in ks],
            *[
                (F.col(f"top_{k}_{entity}_gmv") / F.nullif(F.col(total_name), F.lit(0.0))).alias(
                    f"top_{k}_share"
                )
                for k in ks
            ],
        )
    )
