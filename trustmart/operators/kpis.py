"""KPI tables. Inputs are the facts and dimensions; outputs carry published (double) figures.

Sorting for presentation is left to the sink (``report_order``): the operators return unordered
frames, which saves a range shuffle whenever a KPI is only an input to something else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustmart.functions.clean import month_diff, period_start
from trustmart.functions.metrics import (
    bucket_rank,
    delay_bucket,
    gmv_all,
    gmv_eligible,
    mean_money,
    money,
    order_kpis,
    ratio,
    share_of_rows,
)
from trustmart.operators import ranking
from trustmart.operators.joins import lookup, with_orders
from trustmart.operators.marts import order_seller_performance, rollup_seller_orders


def headline(facts: DataFrame) -> DataFrame:
    return facts.agg(*order_kpis("on_time_rate"))


def headline_all_orders(facts: DataFrame) -> DataFrame:
    """Unweighted variant: GMV and mean order value over all orders, eligible or not."""
    return facts.agg(
        F.count(F.lit(1)).alias("total_orders"),
        money(gmv_all()).alias("total_gmv"),
        ratio(gmv_all(), F.count(F.lit(1))).alias("aov"),
        share_of_rows(F.col("is_canceled_or_unavailable") == 1).alias("cancellation_rate"),
        F.avg("avg_review_score").alias("avg_review_score"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        F.avg(F.col("is_on_time_delivery").cast("double")).alias("on_time_delivery_rate"),
    )


def period_kpis(facts: DataFrame, unit: str) -> DataFrame:
    """The governed KPIs per calendar ``unit`` ("month" or "week")."""
    return facts.groupBy(period_start("order_purchase_ts", unit).alias(f"{unit}_start")).agg(
        *order_kpis("on_time_delivery_rate")
    )


def active_customers(
    facts: DataFrame, unit: str = "month", key: str = "customer_unique_id"
) -> DataFrame:
    return facts.groupBy(period_start("order_purchase_ts", unit).alias(f"{unit}_start")).agg(
        F.countDistinct(key).alias("active_customers")
    )


def cohort_retention(
    facts: DataFrame, key: str = "customer_unique_id", ts: str = "order_purchase_ts"
) -> DataFrame:
    """Customers of each first-order month that come back in later months.

    Orders shrink to distinct (customer, month) pairs before the shuffle. The cohort of a customer
    is the minimum over those few pairs, and a cohort's size is its own month-zero activity, so
    neither the facts nor the customers are read a second time.
    """
    months = (
        facts.filter(F.col(key).isNotNull())
        .select(F.col(key).alias("customer"), period_start(ts, "month").alias("order_month"))
        .distinct()
    )
    first = F.min("order_month").over(Window.partitionBy("customer"))
    activity = (
        months.withColumn("cohort_month", first)
        .filter(F.col("cohort_month").isNotNull())
        .groupBy("cohort_month", "order_month")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    founders = F.when(F.col("order_month") == F.col("cohort_month"), F.col("active_customers"))
    size = F.max(founders).over(Window.partitionBy("cohort_month"))
    return activity.withColumn("cohort_size", size).select(
        "cohort_month",
        "order_month",
        month_diff("cohort_month", "order_month").alias("month_number"),
        "cohort_size",
        "active_customers",
        ratio(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate"),
    )


def delay_vs_reviews(facts: DataFrame) -> DataFrame:
    return facts.groupBy(delay_bucket().alias("delay_bucket")).agg(
        F.count(F.lit(1)).alias("orders"), F.avg("avg_review_score").alias("avg_review_score")
    )


def _order_columns(facts: DataFrame, *columns: str) -> DataFrame:
    return facts.select(F.col("order_id").alias("__order"), *columns)


def _eligible(facts: DataFrame, *columns: str) -> DataFrame:
    return _order_columns(facts.filter("is_revenue_eligible_order = 1"), *columns)


def _with_seller_state(df: DataFrame, sellers: DataFrame) -> DataFrame:
    states = sellers.select(F.col("seller_id").alias("__seller"), "seller_state")
    return df.join(states, F.col("seller_id") == F.col("__seller"), "left").drop("__seller")


def item_categories(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with their translated category, ``unknown`` for unknown products."""
    names = products.select(F.col("product_id").alias("__product"), "product_category_name_en")
    return (
        lookup(items, names, "product_id", "__product")
        .withColumn("category", F.coalesce("product_category_name_en", F.lit("unknown")))
        .drop("product_category_name_en")
    )


def category_performance(
    items: DataFrame, facts: DataFrame, products: DataFrame, in_place: bool = False
) -> DataFrame:
    """Eligible orders and GMV per category.

    Lines shrink to (order, product) grain first, so an order or a product with very many lines
    reaches the joins as few rows. ``in_place``: both facts are stored sorted by order, so lines meet
    their orders as they are read and nothing is gained by summing them first.
    """
    if in_place:
        priced = F.when(F.col("gmv").isNull(), 0).otherwise(1)
        lines = items.select("order_id", "product_id", "gmv", priced.alias("priced_lines"))
    else:
        lines = items.groupBy("order_id", "product_id").agg(
            F.sum("gmv").alias("gmv"), F.count("gmv").alias("priced_lines")
        )
    sold = with_orders(lines, _eligible(facts))
    return (
        item_categories(sold, products)
        .groupBy("category")
        .agg(
            F.countDistinct("order_id").alias("orders"),
            money(F.sum("gmv")).alias("gmv_revenue_eligible"),
            ratio(F.sum("gmv"), F.sum("priced_lines")).alias("avg_item_value_revenue_eligible"),
        )
    )


def seller_performance(items: DataFrame, facts: DataFrame, sellers: DataFrame) -> DataFrame:
    """Eligible orders and GMV per seller; the mean is per seller-order, not per item.

    The seller's state joins after the aggregation, one row per seller.
    """
    seller_orders = order_seller_performance(items, facts.filter("is_revenue_eligible_order = 1"))
    totals = seller_orders.groupBy("seller_id").agg(
        # Already one row per seller and order, so counting rows is counting distinct orders.
        F.count(F.lit(1)).alias("orders"),
        money(F.sum("seller_gmv")).alias("gmv_revenue_eligible"),
        mean_money(F.col("seller_gmv")).alias("avg_order_gmv_revenue_eligible"),
    )
    return _with_seller_state(totals, sellers).select(
        "seller_state",
        "seller_id",
        "orders",
        "gmv_revenue_eligible",
        "avg_order_gmv_revenue_eligible",
    )


def seller_risk(
    items: DataFrame, facts: DataFrame, sellers: DataFrame, min_orders: int = 30
) -> DataFrame:
    """Operational profile of sellers with at least ``min_orders`` orders."""
    eligible = F.col("is_revenue_eligible_order") == 1
    flags = _order_columns(
        facts,
        "is_revenue_eligible_order",
        "is_on_time_delivery",
        "is_canceled_or_unavailable",
        "avg_review_score",
    )
    seller_orders = with_orders(rollup_seller_orders(items), flags)
    profile = seller_orders.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("orders_all"),
        F.count(F.when(eligible, 1)).alias("orders_revenue_eligible"),
        money(F.sum(F.when(eligible, F.col("seller_gmv")).otherwise(F.lit(0)))).alias(
            "gmv_revenue_eligible"
        ),
        mean_money(F.when(eligible, F.col("seller_gmv"))).alias("avg_order_gmv_revenue_eligible"),
        share_of_rows(F.col("is_on_time_delivery") == 0).alias("late_delivery_rate"),
        share_of_rows(F.col("is_canceled_or_unavailable") == 1).alias("cancellation_rate"),
        F.avg("avg_review_score").alias("avg_review_score"),
    )
    return _with_seller_state(profile.filter(F.col("orders_all") >= min_orders), sellers).select(
        "seller_id",
        "seller_state",
        "orders_all",
        "orders_revenue_eligible",
        "gmv_revenue_eligible",
        "avg_order_gmv_revenue_eligible",
        "late_delivery_rate",
        "cancellation_rate",
        "avg_review_score",
    )


def state_performance(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """KPIs per customer state.

    Orders are summed per customer before they meet the customers, so a customer with very many
    orders is one row in the join. Orders are unique in the fact, so counting is exact.
    """
    per_customer = facts.groupBy(F.col("customer_id").alias("__customer")).agg(
        F.count("order_id").alias("orders"),
        gmv_all().alias("gmv_all"),
        gmv_eligible().alias("gmv_eligible"),
        F.sum("avg_review_score").alias("review_sum"),
        F.count("avg_review_score").alias("review_n"),
        F.sum("delivery_days").alias("days_sum"),
        F.count("delivery_days").alias("days_n"),
    )
    states = customers.select("customer_id", "customer_state")
    return (
        per_customer.join(states, F.col("__customer") == F.col("customer_id"), "left")
        .groupBy("customer_state")
        .agg(
            F.sum("orders").alias("orders"),
            money(F.sum("gmv_all")).alias("gmv_all_orders"),
            money(F.sum("gmv_eligible")).alias("gmv_revenue_eligible"),
            ratio(F.sum("review_sum"), F.sum("review_n")).alias("avg_review_score"),
            ratio(F.sum("days_sum"), F.sum("days_n")).alias("avg_delivery_days"),
        )
    )


def payment_mix(stg_payments: DataFrame) -> DataFrame:
    return stg_payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payment_records"),
        money(F.sum("payment_value")).alias("payment_value"),
        mean_money(F.col("payment_value")).alias("avg_payment_value"),
    )


def seller_concentration(
    items: DataFrame, facts: DataFrame, ks: Sequence[int] = (5, 10, 50), in_place: bool = False
) -> DataFrame:
    """GMV and share of the leading sellers, eligible orders only. ``in_place``: as for categories."""
    if in_place:
        lines = items.select("order_id", "seller_id", F.col("gmv").alias("seller_gmv"))
    else:
        lines = rollup_seller_orders(items)
    return ranking.concentration(with_orders(lines, _eligible(facts)), "seller_id", "seller_gmv", ks)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every named table. Over stored Parquet this reads file footers only."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


def fan_out_audit(stg_items: DataFrame, stg_payments: DataFrame, facts: DataFrame) -> DataFrame:
    """What joining items straight to payments would claim, against the trusted GMV.

    Each item of an order would be repeated once per payment, so the naive total is the order's GMV
    times its number of payments: the many-to-many join is never run.
    """
    item_totals = stg_items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("gmv")
    )
    payment_counts = stg_payments.groupBy(F.col("order_id").alias("__order")).agg(
        F.count(F.lit(1)).alias("payments")
    )
    naive = item_totals.join(payment_counts, F.col("order_id") == F.col("__order")).agg(
        F.sum(F.col("gmv") * F.col("payments").cast("decimal(10,0)")).alias("naive")
    )
    trusted = facts.agg(
        F.sum("item_gmv").alias("all_orders"), F.sum("revenue_eligible_gmv").alias("eligible")
    )
    return naive.crossJoin(F.broadcast(trusted)).select(
        money(F.col("naive")).alias("naive_gmv"),
        money(F.col("all_orders")).alias("trusted_gmv_all_orders"),
        money(F.col("eligible")).alias("trusted_gmv_revenue_eligible"),
        money(F.col("naive") - F.col("all_orders")).alias("gmv_overstatement_vs_all_orders"),
    )


def report_order(name: str) -> list[Column]:
    """Presentation order of an exported KPI table."""

    def largest(measure: str, tie: str) -> list[Column]:
        return [F.col(measure).desc_nulls_last(), F.col(tie).asc_nulls_last()]

    orders = {
        "kpi_monthly": lambda: [F.col("month_start").asc_nulls_last()],
        "kpi_weekly_ops": lambda: [F.col("week_start").asc_nulls_last()],
        "kpi_active_customers_monthly": lambda: [F.col("month_start").asc_nulls_last()],
        "kpi_customer_cohort_retention": lambda: [
            F.col("cohort_month").asc_nulls_last(),
            F.col("month_number").asc_nulls_last(),
        ],
        "kpi_category_performance": lambda: largest("gmv_revenue_eligible", "category"),
        "kpi_seller_performance": lambda: largest("gmv_revenue_eligible", "seller_id"),
        "kpi_seller_operational_risk": lambda: largest("gmv_revenue_eligible", "seller_id"),
        "kpi_state_performance": lambda: largest("gmv_revenue_eligible", "customer_state"),
        "kpi_payment_mix": lambda: largest("payment_value", "payment_type"),
        "kpi_delay_vs_reviews": lambda: [bucket_rank().asc_nulls_last()],
        "data_quality_summary": lambda: largest("issue_rows", "check_name"),
        "model_row_counts": lambda: [F.col("table_name").asc_nulls_last()],
    }
    return orders[name]() if name in orders else []
