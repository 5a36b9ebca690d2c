from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests import shop as data
from tests.rows import bag, by, frame
from tests.shop import shop
from trustmart.operators import marts
from trustmart.operators.ranking import sequence_within
from trustmart.sources.layers import written


@pytest.fixture(scope="module")
def facts(spark):
    return by(shop(spark).fact_orders, "order_id")


def test_money_is_not_multiplied_by_payments(facts):
    o1 = facts["o1"]
    assert (o1.item_count, o1.item_gmv) == (2, Decimal("34.0000"))
    assert (o1.payment_record_count, o1.payment_value_total) == (3, Decimal("34.0000"))
    assert (o1.review_count, o1.avg_review_score) == (2, 3.5)


def test_revenue_eligibility(facts):
    flags = {k: (r.is_revenue_eligible_order, float(r.revenue_eligible_gmv)) for k, r in facts.items()}
    assert flags == {
        "o1": (1, 34.0),
        "o2": (1, 5.5),
        "o3": (0, 0.0),  # cancelled, with items
        "o4": (0, 0.0),  # no items
        "o5": (0, 0.0),  # unknown status
        "o6": (1, 44.0),
    }
    assert facts["o4"].item_gmv is None
    assert facts["o3"].is_canceled_or_unavailable == 1
    assert facts["o5"].is_canceled_or_unavailable == 0


def test_on_time_compares_timestamps_and_days_compare_dates(facts):
    o1 = facts["o1"]
    assert o1.is_on_time_delivery == 0
    assert (o1.delivery_days, o1.estimated_delivery_days) == (5, 5)
    assert facts["o2"].is_on_time_delivery == 1
    assert facts["o6"].is_on_time_delivery is None
    assert facts["o6"].delivery_days == 1


def test_order_sequence_per_person(facts):
    assert facts["o1"].customer_order_sequence == 1
    assert facts["o2"].customer_order_sequence == 2
    # Orders of unknown people are numbered together.
    assert (facts["o5"].customer_order_sequence, facts["o6"].customer_order_sequence) == (1, 2)


def test_fact_columns(spark):
    assert tuple(shop(spark).fact_orders.columns) == marts.FACT_ORDERS_COLUMNS


def test_items_of_unknown_orders_are_dropped(spark):
    items = by(shop(spark).fact_order_items.filter("order_item_id = 1"), "order_id")
    assert "o-lost" not in items
    assert items["o2"].gmv == Decimal("5.5000")
    assert items["o2"].purchase_date == date(2018, 1, 3)


def test_customer_without_orders_has_null_history(spark):
    customers = by(shop(spark).dim_customers, "customer_id")
    assert customers["c9"].total_orders is None
    assert customers["c9"].first_order_ts is None
    assert customers["c9"].latitude is None
    assert customers["c3"].total_orders == 2
    assert (customers["c1"].latitude, customers["c1"].longitude) == (-23.0, -43.0)


def test_product_volume(spark):
    products = by(shop(spark).dim_products, "product_id")
    assert products["p1"].product_volume_cm3 == 24.0
    assert products["p2"].product_volume_cm3 is None


def test_calendar(spark):
    days = by(
        marts.calendar(
            spark.sql("SELECT date'2016-12-31' AS lo, date'2017-01-02' AS hi"), "lo", "hi"
        ),
        "date_day",
    )
    assert len(days) == 3
    first = days[date(2017, 1, 1)]
    assert (first.week_num, first.day_of_week_num, first.is_weekend) == (52, 0, 1)
    assert (first.year_month, first.day_of_week_name) == ("2017-01", "Sunday")
    assert days[date(2017, 1, 2)].is_weekend == 0


def test_seller_orders_match_the_item_level_join(spark):
    m = shop(spark)
    direct = (
        m.fact_order_items.alias("i")
        .join(m.fact_orders.alias("o"), F.col("i.order_id") == F.col("o.order_id"))
        .groupBy("i.seller_id", "i.order_id")
        .agg(F.sum("gmv").alias("seller_gmv"), F.count(F.lit(1)).alias("n"))
    )
    ours = m.order_seller_performance().select(
        "seller_id", "order_id", "seller_gmv", "seller_item_count"
    )
    assert bag(ours) == bag(direct)


def test_unused_rollups_leave_the_plan(small_model):
    lean = small_model.orders.select("order_id", "item_gmv")
    plan = lean._jdf.queryExecution().optimizedPlan().toString()
    assert "payment" not in plan
    assert "review" not in plan


# --- numbering hot keys ---------------------------------------------------------------------


def numbered(df):
    window = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), F.col("id").asc_nulls_last())
    return df.withColumn("n", F.row_number().over(window).cast("bigint"))


def places(df):
    return written(df, "places")


@pytest.mark.parametrize("make_id", ["sha2(cast(id as string), 256)", "concat('ORD-', lpad(id, 12, '0'))"])
def test_hot_keys_are_numbered_as_in_one_window(spark, make_id):
    """A third of the rows share a NULL key, many of them one hour, one instant or no time."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None))
        .when(F.col("id") % 3 == 1, F.lit("busy"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("k"),
        F.expr(
            "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 7 < 3 THEN timestamp_ntz'2020-01-01 10:00:00'"
            " ELSE timestampadd(MILLISECOND, cast(pmod(id * 7919, 9000000) as int),"
            " timestamp_ntz'2020-01-01 09:00:00') END"
        ).alias("ts"),
        F.expr(make_id).alias("id"),
    )
    ours = sequence_within(df, "k", "ts", "id", "n", places)
    assert bag(ours) == bag(numbered(df))


def test_keys_that_look_like_slots_and_texts_of_nothing(spark):
    keys = ["a", "a|2017-01-01 00", "null", "=a", "", None]
    rows = [(k, None, f"{i}-{j}") for i, k in enumerate(keys) for j in range(4)]
    df = frame(spark, "k string, ts timestamp_ntz, id string", *rows)
    assert bag(sequence_within(df, "k", "ts", "id", "n", places)) == bag(numbered(df))


def test_no_task_sorts_one_hot_instant(spark):
    """One key, no time, ids with a common beginning: the stored parts are about equal."""
    df = spark.range(20_000).selectExpr(
        "cast(null as string) k", "cast(null as timestamp_ntz) ts", "concat('ORD-', lpad(id, 12, '0')) id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = []
        sequence_within(df, "k", "ts", "id", "n", lambda d: stored.append(places(d)) or stored[0])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in stored[0].groupBy(F.shiftright("__id", 33)).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3 * 20_000 / len(sizes)


def test_order_without_id_keeps_its_person(spark):
    orders = data.ORDERS + [(None, "c2", "shipped", "2018-02-01 00:00:00", None, None)]
    rows = by(shop(spark, orders=orders).fact_orders, "order_id")
    assert len(rows) == 7
    assert (rows[None].customer_unique_id, rows[None].customer_order_sequence) == ("u1", 3)
    assert rows["o2"].customer_order_sequence == 2


def test_rows_keep_their_number_after_repartitioning(spark):
    again = shop(spark, orders=list(reversed(data.ORDERS))).fact_orders
    assert bag(again) == bag(shop(spark).fact_orders)
