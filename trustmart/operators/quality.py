"""Data-quality checks: one aggregate per source table, whatever the number of checks on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.functions.clean import zip5

# Published check names.
ORDER_CHECKS = (
    "orders_missing_purchase_timestamp",
    "orders_missing_customer_id",
    "orders_missing_delivered_customer_date_for_delivered_status",
    "orders_with_estimated_delivery_before_purchase",
)
DUPLICATE_ORDERS = "duplicate_order_ids_raw"
DUPLICATE_ITEMS = "duplicate_order_item_keys_raw"
DUPLICATE_ZIPS = "duplicate_geolocation_zip_prefix_raw"


def _row_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _as_checks(one_row: DataFrame) -> DataFrame:
    """One-row wide frame to (check_name, issue_rows) rows."""
    return one_row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("check_name"), F.col(c).alias("issue_rows"))
                    for c in one_row.columns
                ]
            )
        )
    )


def order_checks(stg_orders: DataFrame) -> DataFrame:
    """Missing keys and timestamps, and estimates before purchase, in one pass."""
    purchase = F.col("order_purchase_ts")
    conditions = (
        purchase.isNull(),
        F.col("customer_id").isNull(),
        (F.col("order_status") == "delivered") & F.col("delivered_customer_ts").isNull(),
        F.col("estimated_delivery_ts") < purchase,
    )
    return _as_checks(
        stg_orders.agg(*[_row_if(c).alias(n) for n, c in zip(ORDER_CHECKS, conditions)])
    )


def excess_rows(
    df: DataFrame, keys: Mapping[str, Column] | Sequence[str], count_null_key: bool = False
) -> Column | DataFrame:
    """Rows beyond the first of each key, as a one-row frame ``issue_rows``.

    Copies are counted per key with map-side combine, so a key with very many copies shuffles as
    few rows. Rows with a NULL key are all excess, as in ``count(*) - count(distinct key)``, unless
    ``count_null_key`` makes NULL a key value like any other.
    """
    named = keys if isinstance(keys, Mapping) else {k: F.col(k) for k in keys}
    groups = df.groupBy(*[c.alias(k) for k, c in named.items()]).agg(
        F.count(F.lit(1)).alias("copies")
    )
    known = F.lit(True)
    if not count_null_key:
        for k in named:
            known = known & F.col(k).isNotNull()
    return groups.agg(
        (F.coalesce(F.sum("copies"), F.lit(0)) - _row_if(known)).alias("issue_rows")
    )


def duplicate_check(
    name: str,
    df: DataFrame,
    keys: Mapping[str, Column] | Sequence[str],
    count_null_key: bool = False,
) -> DataFrame:
    return excess_rows(df, keys, count_null_key).select(
        F.lit(name).alias("check_name"), "issue_rows"
    )


def duplicate_orders(raw_orders: DataFrame) -> DataFrame:
    return duplicate_check(DUPLICATE_ORDERS, raw_orders, ["order_id"])


def duplicate_items(raw_items: DataFrame) -> DataFrame:
    return duplicate_check(
        DUPLICATE_ITEMS, raw_items, ["order_id", "order_item_id"], count_null_key=True
    )


def duplicate_zips(raw_geolocation: DataFrame) -> DataFrame:
    return duplicate_check(
        DUPLICATE_ZIPS, raw_geolocation, {"zip": zip5("geolocation_zip_code_prefix")}
    )


def data_quality_summary(
    stg_orders: DataFrame,
    raw_orders: DataFrame,
    raw_items: DataFrame,
    raw_geolocation: DataFrame,
) -> DataFrame:
    return (
        order_checks(stg_orders)
        .unionByName(duplicate_orders(raw_orders))
        .unionByName(duplicate_items(raw_items))
        .unionByName(duplicate_zips(raw_geolocation))
    )
