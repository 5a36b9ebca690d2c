"""Staging tables to the star schema: dimensions, item and order facts.

Child tables are rolled up to order grain before they meet an order, so no join can multiply money,
and the roll-ups combine on the map side, so an order with very many children stays cheap. Joins
carry no broadcast hint: dimensions grow with the data, so Spark decides by their measured size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustmart.functions.clean import day_diff
from trustmart.functions.metrics import (
    EXCLUDED_STATUSES,
    is_eligible,
    is_excluded,
    on_time_flag,
)
from trustmart.operators.joins import lookup, with_orders
from trustmart.operators.ranking import sequence_within

# --- dimensions -----------------------------------------------------------------------------


def dim_geography(stg_geo: DataFrame) -> DataFrame:
    return stg_geo.select(
        "zip_code_prefix",
        F.col("primary_city").alias("city"),
        F.col("primary_state").alias("state"),
        F.col("avg_latitude").alias("latitude"),
        F.col("avg_longitude").alias("longitude"),
    )


def _with_coordinates(df: DataFrame, zip_col: str, geography: DataFrame) -> DataFrame:
    places = geography.select(F.col("zip_code_prefix").alias("__zip"), "latitude", "longitude")
    return lookup(df, places, zip_col, "__zip")


def dim_customers(
    stg_customers: DataFrame, stg_orders: DataFrame, geography: DataFrame
) -> DataFrame:
    """Customers with their order history; the history is NULL, not zero, without orders."""
    history = stg_orders.groupBy(F.col("customer_id").alias("__customer")).agg(
        F.min("order_purchase_ts").alias("first_order_ts"),
        F.max("order_purchase_ts").alias("last_order_ts"),
        F.count(F.lit(1)).alias("total_orders"),
    )
    known = stg_customers.join(history, F.col("customer_id") == F.col("__customer"), "left")
    return _with_coordinates(known, "customer_zip_code_prefix", geography).select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
        "latitude",
        "longitude",
        "first_order_ts",
        "last_order_ts",
        "total_orders",
    )


def dim_sellers(stg_sellers: DataFrame, geography: DataFrame) -> DataFrame:
    return _with_coordinates(stg_sellers, "seller_zip_code_prefix", geography)


def dim_products(stg_products: DataFrame) -> DataFrame:
    return stg_products.withColumn(
        "product_volume_cm3",
        F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"),
    )


def calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between two date columns of a one-row frame."""
    day = F.col("date_day")
    weekday = F.dayofweek(day) - 1
    return bounds.select(
        F.explode(F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))).alias("date_day")
    ).select(
        "date_day",
        F.year(day).cast("bigint").alias("year_num"),
        F.month(day).cast("bigint").alias("month_num"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.weekofyear(day).cast("bigint").alias("week_num"),
        weekday.cast("bigint").alias("day_of_week_num"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.when(weekday.isin(0, 6), 1).otherwise(0).alias("is_weekend"),
    )


def dim_dates(stg_orders: DataFrame) -> DataFrame:
    day = F.col("order_purchase_ts").cast("date")
    return calendar(stg_orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi")), "lo", "hi")


# --- facts ----------------------------------------------------------------------------------


def with_item_gmv(items: DataFrame) -> DataFrame:
    return items.withColumn("gmv", F.col("price") + F.col("freight_value"))


def fact_order_items(stg_items: DataFrame, stg_orders: DataFrame, in_place: bool = False) -> DataFrame:
    """Items of known orders, with GMV and purchase date. ``in_place``: both are dealt by order already."""
    orders = stg_orders.select(
        F.col("order_id").alias("__order"), "customer_id", "order_status", "order_purchase_ts"
    )
    items = with_item_gmv(stg_items)
    known = with_orders(items, orders) if in_place else lookup(items, orders, "order_id", "__order", "inner")
    return known.select(
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_status",
        F.col("order_purchase_ts").cast("date").alias("purchase_date"),
        "shipping_limit_ts",
        "price",
        "freight_value",
        "gmv",
    )


def rollup_items(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("price").alias("item_price_value"),
        F.sum("freight_value").alias("item_freight_value"),
        F.sum("gmv").alias("item_gmv"),
    )


def rollup_payments(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value_total"),
        F.count(F.lit(1)).alias("payment_record_count"),
    )


def rollup_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count(F.lit(1)).alias("review_count"),
    )


def with_revenue_eligibility(
    df: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    eligible = is_eligible(excluded=excluded)
    return df.withColumns(
        {
            "revenue_eligible_gmv": F.when(eligible, F.col("item_gmv")).otherwise(F.lit(0)),
            "is_revenue_eligible_order": F.when(eligible, 1).otherwise(0),
        }
    )


def with_on_time(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "is_on_time_delivery", on_time_flag("delivered_customer_ts", "estimated_delivery_ts")
    )


def with_cancel_flag(df: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES) -> DataFrame:
    return df.withColumn(
        "is_canceled_or_unavailable", F.when(is_excluded(excluded=excluded), 1).otherwise(0)
    )


def with_delivery_days(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "delivery_days": day_diff("order_purchase_ts", "delivered_customer_ts"),
            "estimated_delivery_days": day_diff("order_purchase_ts", "estimated_delivery_ts"),
        }
    )


def order_facts(
    stg_orders: DataFrame,
    items: DataFrame,
    stg_payments: DataFrame,
    stg_reviews: DataFrame,
    excluded: Sequence[str] = EXCLUDED_STATUSES,
) -> DataFrame:
    """Orders with their item, payment and review roll-ups and all flags; customer-free.

    ``items`` may be the item fact or any item frame with ``gmv``: items of unknown orders find no
    order here. Every roll-up is unique per order, so Spark drops the whole branch of a roll-up
    whose columns a query never reads.
    """
    facts = stg_orders
    for rollup in (rollup_items(items), rollup_payments(stg_payments), rollup_reviews(stg_reviews)):
        rollup = rollup.withColumnRenamed("order_id", "__order")
        facts = facts.join(rollup, F.col("order_id") == F.col("__order"), "left").drop("__order")
    facts = with_delivery_days(facts)
    return with_cancel_flag(with_on_time(with_revenue_eligibility(facts, excluded)), excluded)


def order_keys(stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Who ordered when: the few columns that customer KPIs and order numbers need."""
    people = stg_customers.select(F.col("customer_id").alias("__customer"), "customer_unique_id")
    orders = stg_orders.select("order_id", "customer_id", "order_purchase_ts")
    return lookup(orders, people, "customer_id", "__customer")


def number_orders(keys: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Numbers the orders of each person in time; ``store`` writes the sorted keys and reads them back."""
    return sequence_within(
        keys.select("order_id", "customer_unique_id", "order_purchase_ts"),
        "customer_unique_id",
        "order_purchase_ts",
        "order_id",
        "customer_order_sequence",
        store,
    ).select("order_id", "customer_unique_id", "customer_order_sequence")


FACT_ORDERS_COLUMNS = (
    "order_id",
    "customer_id",
    "customer_unique_id",
    "order_status",
    "order_purchase_ts",
    "order_approved_ts",
    "delivered_carrier_ts",
    "delivered_customer_ts",
    "estimated_delivery_ts",
    "item_count",
    "item_price_value",
    "item_freight_value",
    "item_gmv",
    "revenue_eligible_gmv",
    "payment_value_total",
    "payment_record_count",
    "avg_review_score",
    "review_count",
    "delivery_days",
    "estimated_delivery_days",
    "is_on_time_delivery",
    "is_canceled_or_unavailable",
    "is_revenue_eligible_order",
    "customer_order_sequence",
)


def fact_orders(facts: DataFrame, numbered: DataFrame) -> DataFrame:
    """One row per order: roll-ups, flags, person and the person's order number.

    Persons and numbers are worked out on narrow rows (``number_orders``) and come back by order
    id, the key the wide facts are partitioned by already: the facts themselves are never shuffled
    by customer. After de-duplication one order at most has no id; what is known of it comes back
    as a frame of one row.
    """
    people = numbered.withColumnRenamed("order_id", "__order")
    found = ("customer_unique_id", "customer_order_sequence")
    nameless = numbered.filter("order_id is null").agg(*[F.max(c).alias(f"__{c}") for c in found])
    return (
        facts.join(people, F.col("order_id") == F.col("__order"), "left")
        .crossJoin(F.broadcast(nameless))
        .withColumns({c: F.when(F.col("order_id").isNull(), F.col(f"__{c}")).otherwise(F.col(c)) for c in found})
        .select(*FACT_ORDERS_COLUMNS)
    )


def rollup_seller_orders(items: DataFrame) -> DataFrame:
    """Items at seller x order grain."""
    return items.groupBy("seller_id", "order_id").agg(
        F.sum("price").alias("seller_item_revenue"),
        F.sum("freight_value").alias("seller_freight_revenue"),
        F.sum("gmv").alias("seller_gmv"),
        F.count(F.lit(1)).alias("seller_item_count"),
    )


def order_seller_performance(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Seller x order view. Items are rolled up first; status and date hang on the order."""
    known = orders.select(
        F.col("order_id").alias("__order"),
        "order_status",
        F.col("order_purchase_ts").cast("date").alias("purchase_date"),
    )
    return with_orders(rollup_seller_orders(items), known).select(
        "seller_id",
        "order_id",
        "order_status",
        "purchase_date",
        "seller_item_revenue",
        "seller_freight_revenue",
        "seller_gmv",
        "seller_item_count",
    )
