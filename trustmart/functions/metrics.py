"""Order-level flags and the KPI aggregate expressions shared by headline and period tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Statuses that never count as realised revenue.
EXCLUDED_STATUSES = ("canceled", "unavailable")

# Delay buckets in reporting order, with their day ranges (inclusive).
ON_TIME_BUCKET = "On time or early"
LATE_1_3_BUCKET = "1-3 days late"
LATE_4_7_BUCKET = "4-7 days late"
LATE_8_BUCKET = "8+ days late"
NOT_DELIVERED_BUCKET = "Not Delivered"
DELAY_BUCKETS = (
    ON_TIME_BUCKET,
    LATE_1_3_BUCKET,
    LATE_4_7_BUCKET,
    LATE_8_BUCKET,
    NOT_DELIVERED_BUCKET,
)


# --- flags on one order ---------------------------------------------------------------------


def is_excluded(status: str = "order_status", excluded: Sequence[str] = EXCLUDED_STATUSES) -> Column:
    return F.col(status).isin(*excluded)


def is_eligible(
    status: str = "order_status",
    gmv: str = "item_gmv",
    excluded: Sequence[str] = EXCLUDED_STATUSES,
) -> Column:
    """Counts as revenue: a known status that is not excluded, and GMV present."""
    return ~is_excluded(status, excluded) & F.col(gmv).isNotNull()


def on_time_flag(delivered: str, estimated: str) -> Column:
    """1 on time, 0 late, NULL when either timestamp is missing. Compares timestamps, not dates."""
    known = F.col(delivered).isNotNull() & F.col(estimated).isNotNull()
    return F.when(known, F.when(F.col(delivered) <= F.col(estimated), 1).otherwise(0))


def delay_bucket(actual_days: str = "delivery_days", estimated_days: str = "estimated_delivery_days"):
    """Delay label by calendar days. A delivery without an estimate lands in the last late bucket."""
    late = F.col(actual_days) - F.col(estimated_days)
    return (
        F.when(F.col(actual_days).isNull(), NOT_DELIVERED_BUCKET)
        .when(late <= 0, ON_TIME_BUCKET)
        .when(late.between(1, 3), LATE_1_3_BUCKET)
        .when(late.between(4, 7), LATE_4_7_BUCKET)
        .otherwise(LATE_8_BUCKET)
    )


def bucket_rank(bucket: str = "delay_bucket") -> Column:
    """Position of a delay label in reporting order."""
    return F.array_position(F.array(*[F.lit(b) for b in DELAY_BUCKETS]), F.col(bucket))


# --- aggregates -----------------------------------------------------------------------------


def money(total: Column) -> Column:
    """Exact decimal total, published as double."""
    return total.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def mean_money(amount: Column) -> Column:
    return ratio(F.sum(amount), F.count(amount))


def share_of_rows(condition: Column) -> Column:
    """Share of rows for which ``condition`` holds; unknown counts as not."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def eligible_orders() -> Column:
    return F.count(F.when(F.col("is_revenue_eligible_order") == 1, 1))


def gmv_all() -> Column:
    return F.sum(F.coalesce(F.col("item_gmv"), F.lit(0)))


def gmv_eligible() -> Column:
    return F.sum(F.coalesce(F.col("revenue_eligible_gmv"), F.lit(0)))


def order_kpis(on_time_name: str) -> list[Column]:
    """The nine governed KPIs as aggregates over an order-grain frame."""
    return [
        F.count(F.lit(1)).alias("total_orders"),
        eligible_orders().alias("revenue_eligible_orders"),
        money(gmv_all()).alias("gmv_all_orders"),
        money(gmv_eligible()).alias("gmv_revenue_eligible"),
        ratio(gmv_eligible(), eligible_orders()).alias("aov_revenue_eligible"),
        share_of_rows(F.col("is_canceled_or_unavailable") == 1).alias("cancellation_rate"),
        F.avg("avg_review_score").alias("avg_review_score"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.avg(F.col("is_on_time_delivery").cast("double")).alias(on_time_name),
    ]


def as_reported(df: DataFrame) -> DataFrame:
    """Published types: every exact decimal becomes a double."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
