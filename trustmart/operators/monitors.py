"""Documented monitoring and BI measures on top of the model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.functions.clean import day_diff, period_start
from trustmart.functions.metrics import (
    DELAY_BUCKETS,
    LATE_4_7_BUCKET,
    LATE_8_BUCKET,
    delay_bucket,
    order_kpis,
    ratio,
    share_of_rows,
)
from trustmart.operators.joins import lookup, with_orders
from trustmart.operators.kpis import item_categories, seller_concentration
from trustmart.operators.marts import calendar


def repeat_rate(facts: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Share of customers with more than one order."""
    per_customer = (
        facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("orders"))
    )
    repeat = F.count(F.when(F.col("orders") > 1, 1))
    return per_customer.agg(
        F.count(F.lit(1)).alias("total_customers"),
        repeat.alias("repeat_customers"),
        ratio(repeat, F.count(F.lit(1))).alias("repeat_customer_rate"),
    )


def freshness(
    facts: DataFrame, as_of: date, ts: str = "order_purchase_ts", max_lag_days: int = 2
) -> DataFrame:
    """Days between the newest ``ts`` and ``as_of``; warns beyond ``max_lag_days`` or without data."""
    lag = day_diff("latest_ts", F.lit(as_of))
    return facts.agg(F.max(ts).alias("latest_ts")).select(
        "latest_ts",
        F.lit(as_of).alias("as_of"),
        lag.alias("lag_days"),
        F.when(lag <= max_lag_days, "OK").otherwise("WARN").alias("status"),
    )


def volume_anomaly(
    facts: DataFrame, ts: str = "order_purchase_ts", window: int = 28, z: float = 3.0
) -> DataFrame:
    """Daily order count against the mean and deviation of the ``window`` days before it.

    Days without orders count as zero. Every day hands its count to the days that follow it, and
    the counts are added up per receiving day as exact integers: no window over one global
    ordering, and the same figures however the rows are split.
    """
    daily = (
        facts.filter(F.col(ts).isNotNull())
        .groupBy(F.col(ts).cast("date").alias("order_day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    bounds = daily.agg(F.min("order_day").alias("lo"), F.max("order_day").alias("hi"))
    days = (
        calendar(bounds, "lo", "hi")
        .select("date_day")
        .join(daily, F.col("date_day") == F.col("order_day"), "left")
        .select("date_day", F.coalesce("n", F.lit(0)).cast("bigint").alias("orders"))
    )
    exact = F.col("orders").cast("decimal(12,0)")
    n, total = F.count(F.lit(1)), F.sum(exact)
    spread = n.cast("decimal(4,0)") * F.sum(exact * exact) - total * total
    history = (
        days.select(
            F.explode(F.sequence(F.lit(1), F.lit(window))).alias("ahead"), "date_day", "orders"
        )
        .groupBy(F.expr("date_add(date_day, ahead)").alias("__day"))
        .agg(
            n.alias("history_days"),
            ratio(total, n).alias("trailing_mean"),
            F.sqrt(ratio(spread, n * (n - 1))).alias("trailing_stddev"),
        )
    )
    score = (F.col("orders").cast("double") - F.col("trailing_mean")) / F.nullif(
        F.col("trailing_stddev"), F.lit(0.0)
    )
    return days.join(history, F.col("date_day") == F.col("__day"), "left").select(
        "date_day",
        "orders",
        F.coalesce("history_days", F.lit(0)).cast("bigint").alias("history_days"),
        "trailing_mean",
        "trailing_stddev",
        score.alias("z_score"),
        F.coalesce(F.abs(score) > z, F.lit(False)).cast("int").alias("is_anomaly"),
    )


def kpi_drift(
    kpis: DataFrame, bands: Mapping[str, tuple[float, float]], id_columns: Sequence[str] = ()
) -> DataFrame:
    """Each banded KPI of each row, and whether it lies inside its expected band."""

    def check(name: str, low: float, high: float) -> Column:
        value = F.col(name).cast("double")
        inside = F.coalesce(value.between(low, high), F.lit(False))
        return F.struct(
            F.lit(name).alias("kpi"),
            value.alias("value"),
            F.lit(float(low)).alias("lower_bound"),
            F.lit(float(high)).alias("upper_bound"),
            F.when(inside, "IN_BAND").otherwise("DRIFT").alias("status"),
        )

    return kpis.select(
        *id_columns, F.inline(F.array(*[check(k, lo, hi) for k, (lo, hi) in bands.items()]))
    )


def bi_measures(facts: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """The BI measure set in one row, with the share of the ``top`` sellers."""
    measures = facts.agg(*order_kpis("on_time_delivery_rate"))
    leaders = seller_concentration(items, facts, ks=(top,)).agg(
        F.max(f"top_{top}_share").alias(f"top_{top}_seller_gmv_share")
    )
    return measures.drop("total_orders").crossJoin(F.broadcast(leaders))


def apply_slicers(
    facts: DataFrame,
    equals: Mapping[str, str | Sequence[str]] | None = None,
    ranges: Mapping[str, tuple] | None = None,
    revenue_view: str = "all",
) -> DataFrame:
    """Dashboard slicers as plain filters, so they reach the scan.

    ``equals`` maps a column to one value or several; ``ranges`` maps a column to inclusive bounds
    (either may be None); ``revenue_view`` is "all" or "primary" (revenue-eligible orders only).
    """
    for column, wanted in (equals or {}).items():
        values = [wanted] if isinstance(wanted, str) else list(wanted)
        facts = facts.filter(F.col(column).isin(*values))
    for column, (low, high) in (ranges or {}).items():
        if low is not None:
            facts = facts.filter(F.col(column) >= F.lit(low))
        if high is not None:
            facts = facts.filter(F.col(column) <= F.lit(high))
    if revenue_view == "primary":
        facts = facts.filter("is_revenue_eligible_order = 1")
    elif revenue_view != "all":
        raise ValueError(f"unknown revenue view: {revenue_view}")
    return facts


def orders_of_customers(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders placed by any of the given customers (for the customer-state slicer)."""
    chosen = customers.select(F.col("customer_id").alias("__customer"))
    return lookup(facts, chosen, "customer_id", "__customer", "left_semi")


def orders_with_items(facts: DataFrame, items: DataFrame) -> DataFrame:
    """Orders that hold any of the given items (for the category and seller-state slicers)."""
    return facts.join(items.select("order_id").distinct(), "order_id", "left_semi")


def sliced_items(
    items: DataFrame, products: DataFrame | None = None, sellers: DataFrame | None = None
) -> DataFrame:
    """Items of the given products and of the given sellers (category and seller-state slicers)."""
    for chosen, key in ((products, "product_id"), (sellers, "seller_id")):
        if chosen is not None:
            wanted = chosen.select(F.col(key).alias("__chosen"))
            items = lookup(items, wanted, key, "__chosen", "left_semi")
    return items


def monitor_status(fresh: DataFrame, volume: DataFrame, drift: DataFrame) -> DataFrame:
    """One row per monitor: how many of its rows ask for a look, and OK or WARN."""

    def row(name: str, df: DataFrame, wrong: Column) -> DataFrame:
        return df.agg(F.count(F.when(wrong, 1)).alias("findings")).select(
            F.lit(name).alias("monitor"),
            "findings",
            F.when(F.col("findings") == 0, "OK").otherwise("WARN").alias("status"),
        )

    return (
        row("freshness", fresh, F.col("status") == "WARN")
        .unionByName(row("volume_anomaly", volume, F.col("is_anomaly") == 1))
        .unionByName(row("kpi_drift", drift, F.col("status") == "DRIFT"))
    )


def weekly_watch(facts: DataFrame) -> DataFrame:
    """Per ISO week: on-time rate, share of deliveries 4+ days late, cancellations, and the review
    score of each delay bucket."""
    bucketed = facts.select(
        period_start("order_purchase_ts", "week").alias("week_start"),
        delay_bucket().alias("bucket"),
        F.col("delivery_days").isNotNull().alias("delivered"),
        "is_on_time_delivery",
        "is_canceled_or_unavailable",
        "avg_review_score",
    )
    very_late = F.col("bucket").isin(LATE_4_7_BUCKET, LATE_8_BUCKET)

    def review_name(bucket: str) -> str:
        words = bucket.lower().replace("+", " plus").replace("-", " ").split()
        return "review_" + "_".join(words)

    return bucketed.groupBy("week_start").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.avg(F.col("is_on_time_delivery").cast("double")).alias("on_time_delivery_rate"),
        ratio(F.count(F.when(very_late, 1)), F.count(F.when(F.col("delivered"), 1))).alias(
            "late_4_plus_share"
        ),
        share_of_rows(F.col("is_canceled_or_unavailable") == 1).alias("cancellation_rate"),
        *[
            F.avg(F.when(F.col("bucket") == b, F.col("avg_review_score"))).alias(review_name(b))
            for b in DELAY_BUCKETS
        ],
    )


def category_reviews(items: DataFrame, facts: DataFrame, products: DataFrame) -> DataFrame:
    """Review score per category; an order counts once per category, however many lines it has."""
    scores = facts.filter("is_revenue_eligible_order = 1").select(
        F.col("order_id").alias("__order"), "avg_review_score"
    )
    lines = with_orders(items.select("order_id", "product_id").distinct(), scores)
    orders = item_categories(lines, products).select("order_id", "category", "avg_review_score").distinct()
    return (
        orders.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count("avg_review_score").alias("reviewed_orders"),
            F.avg("avg_review_score").alias("avg_review_score"),
        )
    )
