"""Distinct customers from mergeable bitmaps.

Every person gets a number, dense within a part; a month has a bitmap of the numbers that ordered in
it for each part and stretch of 32 768 numbers. Months, and batches of orders, fold into quarters,
years and totals by OR, exactly and without reading the orders again. Numbers stay as they are when
people join, so bitmaps written earlier remain right.

A bitmap takes 4 KB, so a month takes an eighth of a byte for each person known: far less than a row
for each person that ordered. Orders without person count in their month as nobody.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustmart.functions.clean import period_start
from trustmart.functions.metrics import ratio
from trustmart.operators.joins import lookup

#: People numbered in one task: four bitmaps' worth.
PER_PART = 4 * 32_768


def parts_for(people: int) -> int:
    """Parts for about this many people. Numbers keep their parts for as long as they are in use, so
    reckon with the people to come."""
    return max(1, -(-people // PER_PART))


def numbered(people: DataFrame, key: str, parts: int, known: DataFrame | None = None) -> DataFrame:
    """(person, part, n) for each distinct ``key``, n from 1 within its part; null has no number.

    With ``known``, an earlier result for the same ``parts``, its rows stay and people who are new are
    numbered after them.
    """
    found = people.select(F.col(key).alias("person")).filter("person is not null").distinct()
    if known is not None:
        found = lookup(found, known.select(F.col("person").alias("__known")), "person", "__known", "left_anti")
    found = found.select("person", F.pmod(F.xxhash64("person"), F.lit(parts)).alias("part"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("person")).cast("bigint")
    if known is None:
        return found.select("person", "part", place.alias("n"))
    # One row for each part.
    last = known.groupBy(F.col("part").alias("__part")).agg(F.max("n").alias("__last"))
    placed = found.withColumn("n", place).join(last, F.col("part") == F.col("__part"), "left")
    added = placed.select("person", "part", (F.col("n") + F.coalesce("__last", F.lit(0))).alias("n"))
    return known.select("person", "part", "n").unionByName(added)


def activity(orders: DataFrame, key: str = "customer_unique_id", ts: str = "order_purchase_ts") -> DataFrame:
    """(month_start, person, repeated): who ordered in which month, and whether that person has, by
    the end of it, ordered more than once. A person has no more rows than there are months."""
    months = orders.groupBy(period_start(ts, "month").alias("month_start"), F.col(key).alias("person")).agg(
        F.count(F.lit(1)).alias("__orders")
    )
    nobody = months.filter("person is null").select("month_start", "person", F.lit(False).alias("repeated"))
    first = F.min("month_start").over(Window.partitionBy("person"))
    repeated = (F.col("__orders") > 1) | ~F.col("month_start").eqNullSafe(first)
    people = months.filter("person is not null").select("month_start", "person", repeated.alias("repeated"))
    return people.unionByName(nobody)


def month_bitmaps(active: DataFrame, numbers: DataFrame) -> DataFrame:
    """(month_start, part, stretch, seen, again): bitmaps of the people of ``activity`` and of those who
    had ordered more than once."""
    places = numbers.select(
        F.col("person").alias("__person"),
        "part",
        F.bitmap_bucket_number("n").alias("stretch"),
        F.bitmap_bit_position("n").alias("bit"),
    )
    placed = lookup(active, places, "person", "__person")
    return placed.groupBy("month_start", "part", "stretch").agg(
        F.bitmap_construct_agg("bit").alias("seen"),
        F.bitmap_construct_agg(F.when(F.col("repeated"), F.col("bit"))).alias("again"),
    )


def merged(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of several batches as one row for each month, part and stretch."""
    return bitmaps.groupBy("month_start", "part", "stretch").agg(
        *[F.bitmap_or_agg(c).alias(c) for c in ("seen", "again")]
    )


def active_customers(bitmaps: DataFrame, unit: str) -> DataFrame:
    """Distinct people of each month, quarter or year; weeks do not fold from months."""
    if unit not in ("month", "quarter", "year"):
        raise ValueError(f"months do not fold into {unit!r}")
    start = f"{unit}_start"
    folded = bitmaps.groupBy(period_start("month_start", unit).alias(start), "part", "stretch")
    folded = folded.agg(F.bitmap_count(F.bitmap_or_agg("seen")).alias("people"))
    return folded.groupBy(start).agg(F.sum("people").alias("active_customers"))


def repeat_rate(bitmaps: DataFrame) -> DataFrame:
    """Share of all people with more than one order."""
    folded = bitmaps.groupBy("part", "stretch").agg(
        *[F.bitmap_count(F.bitmap_or_agg(c)).alias(c) for c in ("seen", "again")]
    )
    total, repeat = (F.coalesce(F.sum(c), F.lit(0)) for c in ("seen", "again"))
    return folded.agg(
        total.alias("total_customers"),
        repeat.alias("repeat_customers"),
        ratio(repeat, total).alias("repeat_customer_rate"),
    )
