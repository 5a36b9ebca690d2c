"""A third of all rows under one key: plans must spread them, results must not change."""

import pytest
from pyspark.sql import functions as F

from tests.rows import bag
from trustmart.operators import kpis, marts, monitors, quality, staging
from trustmart.operators.dedupe import dedupe_keep_first, desc_last

# Small thresholds, so that Spark treats test data like large data.
SMALL_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
}


@pytest.fixture
def at_scale(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_SCALE}
    for k, v in SMALL_SCALE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def orders(spark, n=30_000):
    """Orders of which a third belong to one customer, and a ninth to nobody."""
    return spark.range(0, n, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 9 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("c"), F.col("id").cast("string")))
        .alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.expr("timestampadd(MINUTE, cast(id as int), timestamp_ntz'2020-01-01')").alias(
            "order_purchase_ts"
        ),
    )


def customers(spark, n=30_000):
    ids = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id").cast("string")))
        .alias("customer_id"),
        F.concat(F.lit("u"), (F.col("id") % 1000).cast("string")).alias("customer_unique_id"),
    )
    return dedupe_keep_first(ids, ["customer_id"], [desc_last("customer_unique_id")])


def test_hot_customer_is_split_and_joined_right(at_scale):
    keys = marts.order_keys(orders(at_scale), customers(at_scale))
    rows = keys.collect()
    assert "skew=true" in final_plan(keys)
    assert len(rows) == 30_000
    assert sum(r.customer_unique_id == "u0" and r.customer_id == "hot" for r in rows) == 10_000
    assert sum(r.customer_unique_id is None for r in rows) == sum(r.customer_id is None for r in rows)


def test_hot_order_is_split_in_the_item_fact(at_scale):
    n = 30_000
    lines = at_scale.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("product_id"),
        F.lit("s").alias("seller_id"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_ts"),
        F.lit(1).cast("decimal(16,4)").alias("price"),
        F.lit(0).cast("decimal(16,4)").alias("freight_value"),
    )
    known = dedupe_keep_first(
        at_scale.range(0, n, 1, 8).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
            F.lit("c").alias("customer_id"),
            F.lit("delivered").alias("order_status"),
            F.lit(None).cast("timestamp_ntz").alias("order_purchase_ts"),
        ),
        ["order_id"],
        [desc_last("customer_id")],
    )
    fact = marts.fact_order_items(lines, known)
    assert len(fact.collect()) == n
    assert "skew=true" in final_plan(fact)


def test_hot_seller_is_split_by_the_item_slicer(at_scale):
    n = 30_000
    lines = at_scale.range(0, n, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))
        .alias("seller_id"),
        F.lit("p").alias("product_id"),
    )
    # Sellers that were just de-duplicated, half of them chosen.
    sellers = at_scale.range(0, n, 1, 8).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))
        .alias("seller_id"),
        (F.col("id") % 2).alias("half"),
    )
    sellers = dedupe_keep_first(sellers, ["seller_id"], [desc_last("half")]).filter("half = 0")
    chosen = monitors.sliced_items(lines, sellers=sellers)
    rows = chosen.collect()
    assert "skew=true" in final_plan(chosen)
    assert sum(r.seller_id == "hot" for r in rows) == 10_000
    assert len(rows) == 20_000


def test_copies_of_one_key_are_dropped_before_the_shuffle(spark):
    """Each of 8 tasks holds thousands of copies of one key and passes on one of them."""
    raw = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.lit("c").alias("customer_id"),
        F.lit(" Shipped").alias("order_status"),
        F.lit("2020-01-01 00:00:00").alias("order_purchase_timestamp"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in (
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            )
        ],
    )
    staged = staging.stage_orders(raw)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle
    assert staged.count() == 40_000 - 13_334 + 1
    assert quality.duplicate_orders(raw).first().issue_rows == 13_333


def test_hot_customer_is_one_row_in_the_state_join(at_scale):
    facts = orders(at_scale).selectExpr(
        "*",
        "cast(1 as decimal(27,4)) AS item_gmv",
        "cast(1 as decimal(27,4)) AS revenue_eligible_gmv",
        "cast(null as double) AS avg_review_score",
        "cast(1 as bigint) AS delivery_days",
    )
    people = customers(at_scale).withColumn(
        "customer_state", F.when(F.col("customer_id") == "hot", "A").otherwise("B")
    )
    rows = {r.customer_state: r.orders for r in kpis.state_performance(facts, people).collect()}
    assert rows["A"] == 10_000
    assert sum(rows.values()) == 30_000


def test_geolocation_with_one_hot_zip(spark):
    raw = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 700 + 2).cast("string")).alias(
            "geolocation_zip_code_prefix"
        ),
        F.lit("1.5").alias("geolocation_lat"),
        F.lit("2.5").alias("geolocation_lng"),
        F.when(F.col("id") % 2 == 0, "even").otherwise(F.col("id").cast("string")).alias(
            "geolocation_city"
        ),
        F.lit("x").alias("geolocation_state"),
    )
    hot = staging.stage_geolocation_zip(raw).filter("zip_code_prefix = '00001'")
    assert bag(hot) == [("00001", 1.5, 2.5, "even", "X")]
