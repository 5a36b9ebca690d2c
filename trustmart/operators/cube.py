"""Order KPIs folded from one cube of daily sums.

The cube has a row for each purchase day and delay bucket and holds counts and exact sums only, so
cubes of disjoint orders add up, and a change of some orders is itself a cube: that of the orders as
they are now less that of the same orders before. Headline, months, weeks and delay buckets are folds
of the cube and do not read the orders again. It has a few rows for each day, however many orders.

Orders without a purchase time share a day of null. No orders give an empty cube.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.functions.clean import period_start
from trustmart.functions.metrics import (
    DELAY_BUCKETS,
    LATE_4_7_BUCKET,
    LATE_8_BUCKET,
    delay_bucket,
    eligible_orders,
    gmv_all,
    gmv_eligible,
    money,
    ratio,
)

DAY, BUCKET = "purchase_day", "delay_bucket"
#: An order's review score is a mean; with 15 decimals its sums are exact in any order.
SCORE = "decimal(25,15)"

COUNTS = ("orders", "eligible_orders", "excluded_orders", "scored_orders", "delivered_orders", "timed_orders", "on_time_orders")
SUMS = {"gmv_all": "decimal(38,4)", "gmv_eligible": "decimal(38,4)", "score_sum": "decimal(38,15)", "delivery_days": "bigint"}
UNITS = ("year", "quarter", "month", "week")


def daily_cube(facts: DataFrame) -> DataFrame:
    """Counts and sums for each purchase day and delay bucket of order facts."""
    flagged = lambda flag: F.count(F.when(F.col(flag) == 1, 1))
    sums = {
        "orders": F.count(F.lit(1)),
        "eligible_orders": eligible_orders(),
        "excluded_orders": flagged("is_canceled_or_unavailable"),
        "scored_orders": F.count("avg_review_score"),
        "delivered_orders": F.count("delivery_days"),
        "timed_orders": F.count("is_on_time_delivery"),
        "on_time_orders": flagged("is_on_time_delivery"),
        "gmv_all": gmv_all(),
        "gmv_eligible": gmv_eligible(),
        "score_sum": F.coalesce(F.sum(F.col("avg_review_score").cast(SCORE)), F.lit(0)),
        "delivery_days": F.coalesce(F.sum("delivery_days"), F.lit(0)),
    }
    by_day = facts.groupBy(F.col("order_purchase_ts").cast("date").alias(DAY), delay_bucket().alias(BUCKET))
    return by_day.agg(*[c.cast(SUMS.get(name, "bigint")).alias(name) for name, c in sums.items()])


def _added(when: Callable[[Column], Column] = lambda c: c) -> list[Column]:
    """Every measure summed up; sums that have outgrown their type fail the job."""
    return [F.sum(when(F.col(c))).cast(SUMS.get(c, "bigint")).alias(c) for c in (*COUNTS, *SUMS)]


def merged(cubes: Sequence[DataFrame]) -> DataFrame:
    """The cube of all orders of ``cubes``, which may be changes."""
    every = cubes[0]
    for cube in cubes[1:]:
        every = every.unionByName(cube)
    return every.groupBy(DAY, BUCKET).agg(*_added())


def change(before: DataFrame, after: DataFrame) -> DataFrame:
    """What to merge into a cube when the orders ``before`` have become ``after``; new orders are in
    ``after`` only, removed ones in ``before`` only."""
    less = daily_cube(before).select(DAY, BUCKET, *[(-F.col(c)).cast(SUMS.get(c, "bigint")).alias(c) for c in (*COUNTS, *SUMS)])
    return merged([less, daily_cube(after)])


def _kpis(on_time_name: str) -> list[Column]:
    """The nine governed KPIs of folded sums."""
    return [
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.coalesce("eligible_orders", F.lit(0)).alias("revenue_eligible_orders"),
        money(F.col("gmv_all")).alias("gmv_all_orders"),
        money(F.col("gmv_eligible")).alias("gmv_revenue_eligible"),
        ratio(F.col("gmv_eligible"), F.col("eligible_orders")).alias("aov_revenue_eligible"),
        ratio(F.col("excluded_orders"), F.col("orders")).alias("cancellation_rate"),
        ratio(F.col("score_sum"), F.col("scored_orders")).alias("avg_review_score"),
        ratio(F.col("delivery_days"), F.col("delivered_orders")).alias("avg_delivery_days"),
        ratio(F.col("on_time_orders"), F.col("timed_orders")).alias(on_time_name),
    ]


def headline(cube: DataFrame) -> DataFrame:
    return cube.agg(*_added()).select(*_kpis("on_time_rate"))


def period_kpis(cube: DataFrame, unit: str) -> DataFrame:
    start = f"{unit}_start"
    folded = cube.groupBy(period_start(DAY, unit).alias(start)).agg(*_added())
    return folded.filter("orders > 0").select(start, *_kpis("on_time_delivery_rate"))


def delay_vs_reviews(cube: DataFrame) -> DataFrame:
    folded = cube.groupBy(BUCKET).agg(*_added()).filter("orders > 0")
    return folded.select(BUCKET, "orders", ratio(F.col("score_sum"), F.col("scored_orders")).alias("avg_review_score"))


def weekly_watch(cube: DataFrame) -> DataFrame:
    """Per ISO week: on-time rate, share of deliveries 4+ days late, cancellations, and the review
    score of each delay bucket."""

    def of(bucket: str, measure: str) -> Column:
        return F.sum(F.when(F.col(BUCKET) == bucket, F.col(measure)))

    def review_name(bucket: str) -> str:
        return "review_" + "_".join(bucket.lower().replace("+", " plus").replace("-", " ").split())

    late = F.sum(F.when(F.col(BUCKET).isin(LATE_4_7_BUCKET, LATE_8_BUCKET), F.col("orders")).otherwise(F.lit(0)))
    weeks = cube.groupBy(period_start(DAY, "week").alias("week_start")).agg(
        F.sum("orders").alias("total_orders"),
        ratio(F.sum("on_time_orders"), F.sum("timed_orders")).alias("on_time_delivery_rate"),
        ratio(late, F.sum("delivered_orders")).alias("late_4_plus_share"),
        ratio(F.sum("excluded_orders"), F.sum("orders")).alias("cancellation_rate"),
        *[ratio(of(b, "score_sum"), of(b, "scored_orders")).alias(review_name(b)) for b in DELAY_BUCKETS],
    )
    return weeks.filter("total_orders > 0")


def levels(cube: DataFrame) -> DataFrame:
    """The KPIs of every year, quarter, month, week and delay bucket, in one pass over the cube."""
    starts = {f"{unit}_start": unit for unit in UNITS}
    dated = cube.withColumns({name: period_start(DAY, unit) for name, unit in starts.items()})
    folded = dated.groupingSets([[k] for k in (*starts, BUCKET)], *starts, BUCKET).agg(
        *[F.grouping(k).alias(f"__{k}") for k in starts], *_added()
    )
    level = F.lit("bucket")
    for name, unit in starts.items():
        level = F.when(F.col(f"__{name}") == 0, unit).otherwise(level)
    # A fold has one key; the others are null in it.
    first_day = F.coalesce(*starts).alias("period_start")
    return folded.filter("orders > 0").select(level.alias("level"), first_day, BUCKET, *_kpis("on_time_delivery_rate"))
