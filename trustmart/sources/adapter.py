"""Shapes the TPC-H-like driver tables into the nine raw commerce tables.

Plain arithmetic on existing columns only, so another engine can state the same rules. Timestamps
and identifiers are text, as in the original CSV exports, with stray blanks and mixed case that the
staging step has to clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_TABLES = (
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "customers",
    "products",
    "sellers",
    "geolocation",
    "category_translation",
)


_SCHEMAS: dict[str, T.StructType] = {}


def _shift(ts: str, unit: str, amount: str) -> str:
    return f"timestampadd({unit}, cast({amount} as int), {ts})"


def _text(expr: str) -> Column:
    return F.expr(f"cast({expr} as string)")


class DriverTables:
    """Lazy raw tables over one directory of driver Parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """One driver table as it is. Its schema is read from the file footers once per process."""
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def raw(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def orders(self) -> DataFrame:
        placed = self.table("orders").withColumn("day", F.col("o_orderdate").cast("timestamp_ntz"))
        placed = placed.withColumn(
            "purchase", F.expr(_shift("day", "SECOND", "pmod(o_orderkey * 37, 86400)"))
        )
        finished = "o_orderstatus = 'F'"
        return placed.select(
            _text("o_orderkey").alias("order_id"),
            _text("o_custkey").alias("customer_id"),
            F.expr(
                "CASE WHEN o_orderstatus = 'F' THEN ' Delivered '"
                " WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'CANCELED'"
                " WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'unavailable'"
                " ELSE 'shipped' END"
            ).alias("order_status"),
            _text("purchase").alias("order_purchase_timestamp"),
            _text(_shift("purchase", "HOUR", "1")).alias("order_approved_at"),
            _text(f"CASE WHEN {finished} THEN {_shift('purchase', 'DAY', '2')} END").alias(
                "order_delivered_carrier_date"
            ),
            _text(
                f"CASE WHEN {finished} AND pmod(o_orderkey, 97) <> 0"
                f" THEN {_shift('purchase', 'DAY', '5 + pmod(o_orderkey, 31)')} END"
            ).alias("order_delivered_customer_date"),
            _text(_shift("day", "DAY", "20 + pmod(o_orderkey, 11)")).alias(
                "order_estimated_delivery_date"
            ),
        )

    def order_items(self) -> DataFrame:
        return self.table("lineitem").select(
            _text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            _text("l_partkey").alias("product_id"),
            _text("l_suppkey").alias("seller_id"),
            _text("cast(l_shipdate as timestamp_ntz)").alias("shipping_limit_date"),
            F.expr("cast(l_extendedprice as decimal(14,2))").alias("price"),
            F.expr("cast(l_extendedprice as decimal(14,2)) * cast(l_tax as decimal(4,2))").alias(
                "freight_value"
            ),
        )

    def order_payments(self) -> DataFrame:
        return self.table("lineitem").select(
            _text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.expr(
                "CASE l_returnflag WHEN 'A' THEN 'Credit_Card ' WHEN 'R' THEN 'boleto'"
                " ELSE 'voucher' END"
            ).alias("payment_type"),
            F.expr("cast(l_quantity as int)").alias("payment_installments"),
            F.expr("cast(l_extendedprice as decimal(14,2))").alias("payment_value"),
        )

    def order_reviews(self) -> DataFrame:
        seen = self.table("events").withColumn("created", F.col("ts").cast("timestamp_ntz"))
        return seen.select(
            _text("event_id").alias("review_id"),
            _text("event_id - pmod(event_id, 2)").alias("order_id"),
            F.expr("cast(1 + pmod(cast(floor(value) as bigint), 5) as int)").alias("review_score"),
            F.expr("CASE WHEN pmod(event_id, 3) = 0 THEN ' ' ELSE event_type END").alias(
                "review_comment_title"
            ),
            F.col("props").alias("review_comment_message"),
            F.substring(_text("created"), 1, 19).alias("review_creation_date"),
            F.substring(_text(_shift("created", "DAY", "1")), 1, 19).alias(
                "review_answer_timestamp"
            ),
        )

    def _places(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "r_name")
        )

    def customers(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _text("c_custkey").alias("customer_id"),
                _text("c_custkey - pmod(c_custkey, 2)").alias("customer_unique_id"),
                _text("c_nationkey").alias("customer_zip_code_prefix"),
                F.expr("' ' || n_name").alias("customer_city"),
                F.lower("r_name").alias("customer_state"),
            )
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            _text("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.expr("p_size * 10").alias("product_description_lenght"),
            F.expr("pmod(p_size, 5)").alias("product_photos_qty"),
            F.col("p_retailprice").alias("product_weight_g"),
            F.expr("cast(p_size as double)").alias("product_length_cm"),
            F.expr("cast(p_size + 1 as double)").alias("product_height_cm"),
            F.expr("cast(p_size + 2 as double)").alias("product_width_cm"),
        )

    def category_translation(self) -> DataFrame:
        return (
            self.table("part")
            .filter("p_type <> 'ECONOMY'")
            .select(F.col("p_type").alias("product_category_name"))
            .distinct()
            .withColumn("product_category_name_english", F.lower("product_category_name"))
        )

    def sellers(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self._places(), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                _text("s_suppkey").alias("seller_id"),
                _text("s_nationkey").alias("seller_zip_code_prefix"),
                F.expr("' ' || n_name").alias("seller_city"),
                F.lower("r_name").alias("seller_state"),
            )
        )

    def geolocation(self) -> DataFrame:
        homes = self.table("customer").select(
            F.col("c_nationkey").alias("nationkey"),
            F.col("c_acctbal").alias("acctbal"),
            F.col("c_mktsegment").alias("place"),
        )
        depots = self.table("supplier").select(
            F.col("s_nationkey").alias("nationkey"),
            F.col("s_acctbal").alias("acctbal"),
            F.lit("depot").alias("place"),
        )
        return (
            homes.unionByName(depots)
            .join(self._places(), F.col("nationkey") == F.col("n_nationkey"))
            .select(
                _text("nationkey").alias("geolocation_zip_code_prefix"),
                F.expr("cast(acctbal as decimal(12,2)) * 0.01BD").alias("geolocation_lat"),
                F.expr("cast(acctbal as decimal(12,2)) * -0.005BD").alias("geolocation_lng"),
                F.col("place").alias("geolocation_city"),
                F.col("r_name").alias("geolocation_state"),
            )
        )
