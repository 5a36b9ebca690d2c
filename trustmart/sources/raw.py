"""CSV source for the nine raw tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

# The columns staging reads, spelled as in the source files.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    "order_payments": (
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    "order_reviews": (
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ),
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "products": (
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "geolocation": (
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
    "category_translation": ("product_category_name", "product_category_name_english"),
}

# Only free text may hold line breaks. A multi-line file cannot be split, so the other tables keep
# line-based splits and read in parallel.
MULTI_LINE_TABLES = frozenset({"order_reviews"})


def read_raw(
    spark: SparkSession,
    directory: str,
    table: str,
    file_name: str = "{table}.csv",
    multi_line: Collection[str] = MULTI_LINE_TABLES,
    on_bad: str = "FAILFAST",
) -> DataFrame:
    """One raw table, every column as text, matched by header name.

    Nothing is inferred, so identifiers and zip prefixes keep their leading zeros. ``file_name`` is
    a pattern with ``{table}``; it may name a directory or a glob of many files, which is better for
    multi-line tables, whose files are one task each. A row with too many or too few cells fails the
    read, whichever columns are used, and so does a line break in quotes outside the multi-line
    tables; ``on_bad`` may name another mode of Spark's.
    """
    if table not in RAW_COLUMNS:
        raise ValueError(f"unknown raw table: {table}")
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", table in multi_line)
        .option("mode", on_bad)
        # All cells of a row are looked at, also those that nobody reads.
        .option("columnPruning", False)
        .csv(f"{directory.rstrip('/')}/{file_name.format(table=table)}")
        .select(*RAW_COLUMNS[table])
    )


def register(df: DataFrame, name: str) -> None:
    """Lazy view over a source."""
    df.createOrReplaceTempView(name)
