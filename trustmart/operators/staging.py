"""Raw tables to typed, normalised, de-duplicated staging tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.functions.clean import (
    COORDINATE,
    MONEY,
    blank_to_null,
    norm_lower,
    norm_upper,
    parse_ts,
    text,
    typed,
    zip5,
)
from trustmart.operators.dedupe import asc_last, dedupe_keep_first, desc_last


#: Deals rows to tasks before duplicates go.
Deal = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Rule:
    """Which row of a key stays: the first under ``order``."""

    keys: tuple[str, ...]
    order: Callable[[], list[Column]]

    def winners(self, df: DataFrame, deal: Deal | None = None) -> DataFrame:
        """The winners. ``deal`` may deal the rows by a part of the key: then what is grouped or joined by
        that part later is in place already, but copies of a row are shuffled with it, and sorted once
        instead of twice."""
        return dedupe_keep_first(deal(df) if deal else df, self.keys, self.order())


#: The rules of the staging tables that keep one row per key.
RULES = {
    "stg_orders": Rule(
        ("order_id",),
        lambda: [desc_last("order_purchase_ts"), asc_last("customer_id"), asc_last("order_status")],
    ),
    "stg_order_items": Rule(
        ("order_id", "order_item_id"),
        lambda: [
            desc_last("shipping_limit_ts"),
            asc_last("seller_id"),
            asc_last("product_id"),
            desc_last("price"),
            desc_last("freight_value"),
        ],
    ),
    "stg_order_payments": Rule(
        ("order_id", "payment_sequential"),
        lambda: [desc_last("payment_value"), asc_last("payment_type"), desc_last("payment_installments")],
    ),
    "stg_order_reviews": Rule(
        ("review_id",),
        lambda: [desc_last("review_answer_ts"), asc_last("order_id"), desc_last("review_score")],
    ),
    "stg_customers": Rule(
        ("customer_id",),
        lambda: [
            asc_last("customer_unique_id"),
            asc_last("customer_zip_code_prefix"),
            asc_last("customer_state"),
            asc_last("customer_city"),
        ],
    ),
    "stg_sellers": Rule(
        ("seller_id",),
        lambda: [asc_last("seller_zip_code_prefix"), asc_last("seller_state"), asc_last("seller_city")],
    ),
}


def typed_orders(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(
        text("order_id").alias("order_id"),
        text("customer_id").alias("customer_id"),
        norm_lower("order_status").alias("order_status"),
        parse_ts("order_purchase_timestamp").alias("order_purchase_ts"),
        parse_ts("order_approved_at").alias("order_approved_ts"),
        parse_ts("order_delivered_carrier_date").alias("delivered_carrier_ts"),
        parse_ts("order_delivered_customer_date").alias("delivered_customer_ts"),
        parse_ts("order_estimated_delivery_date").alias("estimated_delivery_ts"),
    )


def stage_orders(raw_orders: DataFrame, deal: Deal | None = None) -> DataFrame:
    """One row per order; the latest purchase wins."""
    return RULES["stg_orders"].winners(typed_orders(raw_orders), deal)


def typed_order_items(raw_items: DataFrame, money=MONEY) -> DataFrame:
    return raw_items.select(
        text("order_id").alias("order_id"),
        typed("order_item_id", "int").alias("order_item_id"),
        text("product_id").alias("product_id"),
        text("seller_id").alias("seller_id"),
        parse_ts("shipping_limit_date").alias("shipping_limit_ts"),
        typed("price", money).alias("price"),
        typed("freight_value", money).alias("freight_value"),
    )


def stage_order_items(raw_items: DataFrame, money=MONEY, deal: Deal | None = None) -> DataFrame:
    """One row per order line; the latest shipping limit wins, then seller, product, dearest."""
    return RULES["stg_order_items"].winners(typed_order_items(raw_items, money), deal)


def payment_values(raw_payments: DataFrame, money=MONEY, deal: Deal | None = None) -> DataFrame:
    """Payments of an order with the value of the row that wins, which is the highest.

    Other columns only settle which of several rows of one value stays, so values need neither them
    nor a sort.
    """
    values = raw_payments.select(
        text("order_id").alias("order_id"),
        typed("payment_sequential", "int").alias("payment_sequential"),
        typed("payment_value", money).alias("payment_value"),
    )
    keys = RULES["stg_order_payments"].keys
    return (deal(values) if deal else values).groupBy(*keys).agg(F.max("payment_value").alias("payment_value"))


def stage_order_payments(raw_payments: DataFrame, money=MONEY) -> DataFrame:
    """One row per payment of an order; the highest value wins."""
    typed_payments = raw_payments.select(
        text("order_id").alias("order_id"),
        typed("payment_sequential", "int").alias("payment_sequential"),
        norm_lower("payment_type").alias("payment_type"),
        typed("payment_installments", "int").alias("payment_installments"),
        typed("payment_value", money).alias("payment_value"),
    )
    return RULES["stg_order_payments"].winners(typed_payments)


def stage_order_reviews(raw_reviews: DataFrame) -> DataFrame:
    """One row per review id, whatever the order; the latest answer wins."""
    typed_reviews = raw_reviews.select(
        text("review_id").alias("review_id"),
        text("order_id").alias("order_id"),
        typed("review_score", "int").alias("review_score"),
        blank_to_null("review_comment_title").alias("review_comment_title"),
        blank_to_null("review_comment_message").alias("review_comment_message"),
        parse_ts("review_creation_date").alias("review_creation_ts"),
        parse_ts("review_answer_timestamp").alias("review_answer_ts"),
    )
    return RULES["stg_order_reviews"].winners(typed_reviews)


def stage_customers(raw_customers: DataFrame) -> DataFrame:
    typed_customers = raw_customers.select(
        text("customer_id").alias("customer_id"),
        text("customer_unique_id").alias("customer_unique_id"),
        zip5("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        norm_lower("customer_city").alias("customer_city"),
        norm_upper("customer_state").alias("customer_state"),
    )
    return RULES["stg_customers"].winners(typed_customers)


def stage_sellers(raw_sellers: DataFrame) -> DataFrame:
    typed_sellers = raw_sellers.select(
        text("seller_id").alias("seller_id"),
        zip5("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        norm_lower("seller_city").alias("seller_city"),
        norm_upper("seller_state").alias("seller_state"),
    )
    return RULES["stg_sellers"].winners(typed_sellers)


def stage_products(raw_products: DataFrame, raw_translation: DataFrame) -> DataFrame:
    """Products with their translated category, ``unknown`` where there is none.

    Products are not de-duplicated: a category that is translated twice fans its products out,
    and the contracts on the facts then report it. No join hint: Spark broadcasts the translation
    by its measured size.
    """
    translation = raw_translation.select(
        F.col("product_category_name").alias("__category"),
        text("product_category_name_english").alias("__english"),
    )
    return raw_products.join(
        translation, F.col("product_category_name") == F.col("__category"), "left"
    ).select(
        text("product_id").alias("product_id"),
        text("product_category_name").alias("product_category_name_pt"),
        F.coalesce(F.col("__english"), F.lit("unknown")).alias("product_category_name_en"),
        typed("product_name_lenght", "int").alias("product_name_length"),
        typed("product_description_lenght", "int").alias("product_description_length"),
        typed("product_photos_qty", "int").alias("product_photos_qty"),
        typed("product_weight_g", "double").alias("product_weight_g"),
        typed("product_length_cm", "double").alias("product_length_cm"),
        typed("product_height_cm", "double").alias("product_height_cm"),
        typed("product_width_cm", "double").alias("product_width_cm"),
    )


def stage_geolocation_zip(raw_geolocation: DataFrame, coordinate=COORDINATE) -> DataFrame:
    """One row per zip prefix: mean coordinates, most frequent city and state (ties: smallest).

    Each raw row votes once for its city and once for its state. The votes are counted per
    (zip, kind, name) with map-side combine before anything is brought together per zip, so a zip
    with very many rows or spellings is never gathered in one buffer.
    """
    nothing = F.lit(None)
    votes = raw_geolocation.select(
        zip5("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        typed("geolocation_lat", coordinate).alias("lat"),
        typed("geolocation_lng", coordinate).alias("lng"),
        norm_lower("geolocation_city").alias("city"),
        norm_upper("geolocation_state").alias("state"),
    ).select(
        "zip_code_prefix",
        F.inline(
            F.array(
                F.struct(
                    F.lit("city").alias("kind"),
                    F.col("city").alias("name"),
                    F.col("lat").alias("lat"),
                    F.col("lng").alias("lng"),
                ),
                F.struct(
                    F.lit("state").alias("kind"),
                    F.col("state").alias("name"),
                    nothing.cast(coordinate).alias("lat"),
                    nothing.cast(coordinate).alias("lng"),
                ),
            )
        ),
    )
    counted = votes.groupBy("zip_code_prefix", "kind", "name").agg(
        F.count(F.lit(1)).alias("votes"),
        F.sum("lat").alias("lat_sum"),
        F.count("lat").alias("lat_n"),
        F.sum("lng").alias("lng_sum"),
        F.count("lng").alias("lng_n"),
    )

    def most_frequent(kind: str):
        ballot = F.when(
            (F.col("kind") == kind) & F.col("name").isNotNull(),
            F.struct((-F.col("votes")).alias("rank"), F.col("name").alias("name")),
        )
        return F.min(ballot)["name"]

    def mean(total: str, n: str):
        return F.sum(total).cast("double") / F.nullif(F.sum(n), F.lit(0))

    return counted.groupBy("zip_code_prefix").agg(
        mean("lat_sum", "lat_n").alias("avg_latitude"),
        mean("lng_sum", "lng_n").alias("avg_longitude"),
        most_frequent("city").alias("primary_city"),
        most_frequent("state").alias("primary_state"),
    )
