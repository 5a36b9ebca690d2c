from datetime import date

import pytest
from pyspark.sql import functions as F

from tests import shop as data
from tests.rows import bag, by, frame
from tests.shop import shop
from trustmart.operators import kpis, ranking


def test_headline(spark):
    (row,) = shop(spark).headline().collect()
    assert row.total_orders == 6
    assert row.revenue_eligible_orders == 3
    assert row.gmv_all_orders == 190.5
    assert row.gmv_revenue_eligible == 83.5
    assert row.aov_revenue_eligible == pytest.approx(83.5 / 3)
    assert row.cancellation_rate == pytest.approx(1 / 6)
    assert row.avg_review_score == pytest.approx((3.5 + 5 + 1) / 3)
    assert row.avg_delivery_days == pytest.approx((5 + 2 + 1) / 3)
    assert row.on_time_rate == 0.5


def test_headline_over_all_orders(spark):
    (row,) = kpis.headline_all_orders(shop(spark).orders).collect()
    assert (row.total_gmv, row.aov) == (190.5, 190.5 / 6)


def test_month_without_eligible_order_has_no_aov(spark):
    only_canceled = [o for o in data.ORDERS if o[0] == "o3"]
    (row,) = shop(spark, orders=only_canceled).monthly().collect()
    assert (row.month_start, row.revenue_eligible_orders) == (date(2017, 11, 1), 0)
    assert row.gmv_revenue_eligible == 0.0
    assert row.aov_revenue_eligible is None


def test_months_and_weeks_add_up_to_the_headline(spark, small_model):
    (head,) = small_model.headline().collect()
    for periods in (small_model.monthly(), small_model.weekly()):
        (total,) = periods.agg(
            F.sum("total_orders").alias("orders"),
            F.sum("revenue_eligible_orders").alias("eligible"),
            F.sum("gmv_revenue_eligible").alias("gmv"),
        ).collect()
        assert (total.orders, total.eligible) == (head.total_orders, head.revenue_eligible_orders)
        assert total.gmv == pytest.approx(head.gmv_revenue_eligible, abs=0.01)


def test_delay_buckets_at_their_edges(spark):
    days = [0, -5, 1, 3, 4, 7, 8]
    facts = frame(
        spark,
        "delivery_days bigint, estimated_delivery_days bigint, avg_review_score double",
        *[(20 + d, 20, 4.0) for d in days],
        (None, 20, 1.0),
        (20, None, 2.0),
    )
    orders = {k: r.orders for k, r in by(kpis.delay_vs_reviews(facts), "delay_bucket").items()}
    assert orders == {
        "On time or early": 2,
        "1-3 days late": 2,
        "4-7 days late": 2,
        "8+ days late": 2,  # the delivery without an estimate is here
        "Not Delivered": 1,
    }


def test_on_time_bucket_and_late_flag_differ_on_the_estimated_day(spark):
    m = shop(spark, orders=[data.ORDERS[0]])
    assert m.delay_vs_reviews().first().delay_bucket == "On time or early"
    assert m.headline().first().on_time_rate == 0.0


def test_cohorts(spark):
    rows = bag(shop(spark).cohort_retention())
    assert rows == [
        # u1 founds November 2017 together with u2 and returns in January.
        (date(2017, 11, 1), date(2017, 11, 1), 0, 2, 2, 1.0),
        (date(2017, 11, 1), date(2017, 12, 1), 1, 2, 1, 0.5),
        (date(2017, 11, 1), date(2018, 1, 1), 2, 2, 1, 0.5),
    ]


def test_cohort_keeps_undated_orders_of_dated_customers(spark):
    from datetime import datetime

    facts = frame(
        spark,
        "customer_unique_id string, order_purchase_ts timestamp_ntz",
        ("a", datetime(2020, 1, 5)),
        ("a", None),
        ("b", None),
        (None, datetime(2020, 1, 5)),
    )
    rows = bag(kpis.cohort_retention(facts))
    assert rows == [
        (date(2020, 1, 1), None, None, 1, 1, 1.0),
        (date(2020, 1, 1), date(2020, 1, 1), 0, 1, 1, 1.0),
    ]


def test_active_customers(spark):
    months = {r.month_start: r.active_customers for r in shop(spark).active_customers().collect()}
    assert months == {date(2017, 11, 1): 2, date(2017, 12, 1): 1, date(2018, 1, 1): 1}


def test_categories(spark):
    rows = by(shop(spark).category_performance(), "category")
    assert set(rows) == {"home", "unknown"}
    assert (rows["home"].orders, rows["home"].gmv_revenue_eligible) == (2, 17.0)
    assert rows["home"].avg_item_value_revenue_eligible == 8.5
    # p2 has no translation: the items of o1 and o6.
    assert (rows["unknown"].orders, rows["unknown"].gmv_revenue_eligible) == (2, 66.5)


def test_sellers(spark):
    rows = by(shop(spark).seller_performance(), "seller_id")
    assert (rows["s1"].seller_state, rows["s1"].orders) == ("RJ", 2)
    assert rows["s1"].gmv_revenue_eligible == 17.0
    assert rows["s3"].orders == 1


def test_seller_risk_threshold(spark):
    m = shop(spark)
    rows = by(m.seller_risk(1), "seller_id")
    assert (rows["s1"].orders_all, rows["s1"].orders_revenue_eligible) == (3, 2)
    # The undelivered order counts in the denominator.
    assert rows["s1"].late_delivery_rate == pytest.approx(1 / 3)
    assert rows["s3"].cancellation_rate == 0.5
    assert set(by(m.seller_risk(3), "seller_id")) == {"s1"}
    assert set(by(m.seller_risk(4), "seller_id")) == set()


def test_states(spark):
    rows = by(shop(spark).state_performance(), "customer_state")
    assert (rows["RJ"].orders, rows["RJ"].gmv_revenue_eligible) == (2, 39.5)
    assert (rows["SP"].orders, rows["SP"].gmv_all_orders) == (4, 151.0)
    assert rows["SP"].avg_review_score == 1.0


def test_payment_mix(spark):
    rows = by(shop(spark).payment_mix(), "payment_type")
    assert (rows["voucher"].payment_records, rows["voucher"].payment_value) == (2, 24.0)


def test_fan_out_equals_the_literal_join(spark, small_model):
    for m in (shop(spark), small_model):
        literal = (
            m.stg_order_items.join(m.stg_order_payments, "order_id")
            .agg(F.sum(F.col("price") + F.col("freight_value")).cast("double"))
            .first()[0]
        )
        assert m.join_risk().first().naive_gmv == literal


def test_naive_join_counts_every_payment(spark):
    only = [o for o in data.ORDERS if o[0] == "o1"]
    row = shop(spark, orders=only).join_risk().first()
    # The order has three payments; the naive join also brings in the other orders' items.
    assert row.trusted_gmv_all_orders == 34.0
    assert row.naive_gmv == 3 * 34.0 + 5.5 + 100.0 + 44.0


@pytest.mark.parametrize("sellers", [3, 60])
def test_concentration(spark, sellers):
    df = spark.range(sellers).select(
        F.format_string("s%03d", "id").alias("seller_id"), (F.col("id") + 1).alias("v")
    )
    row = ranking.concentration(df, "seller_id", "v").first()
    values = sorted(range(1, sellers + 1), reverse=True)
    assert row.total_gmv_revenue_eligible == sum(values)
    assert row.top_5_seller_gmv == sum(values[:5])
    assert row.top_50_seller_gmv == sum(values[:50])
    assert row.top_10_share == pytest.approx(sum(values[:10]) / sum(values))


def test_concentration_of_nothing_has_no_row(spark):
    df = frame(spark, "seller_id string, v double")
    assert ranking.concentration(df, "seller_id", "v").count() == 0


def test_row_counts(spark):
    counts = {r.table_name: r.row_count for r in shop(spark).row_counts().collect()}
    assert len(counts) == 17
    assert counts["raw.order_items"] == 7
    assert counts["marts.fact_order_items"] == 6
    assert counts["marts.dim_dates"] == 60
    assert counts["kpi.seller_concentration"] == 1
    assert counts["kpi.customer_cohort_retention"] == 3
    assert "raw.category_translation" not in counts


# Columns of the published tables.
PUBLISHED = {
    "kpi_headline": "total_orders revenue_eligible_orders gmv_all_orders gmv_revenue_eligible"
    " aov_revenue_eligible cancellation_rate avg_review_score avg_delivery_days on_time_rate",
    "kpi_monthly": "month_start total_orders revenue_eligible_orders gmv_all_orders"
    " gmv_revenue_eligible aov_revenue_eligible cancellation_rate avg_review_score"
    " avg_delivery_days on_time_delivery_rate",
    "kpi_weekly_ops": "week_start total_orders revenue_eligible_orders gmv_all_orders"
    " gmv_revenue_eligible aov_revenue_eligible cancellation_rate avg_review_score"
    " avg_delivery_days on_time_delivery_rate",
    "kpi_active_customers_monthly": "month_start active_customers",
    "kpi_customer_cohort_retention": "cohort_month order_month month_number cohort_size"
    " active_customers retention_rate",
    "kpi_category_performance": "category orders gmv_revenue_eligible"
    " avg_item_value_revenue_eligible",
    "kpi_delay_vs_reviews": "delay_bucket orders avg_review_score",
    "kpi_state_performance": "customer_state orders gmv_all_orders gmv_revenue_eligible"
    " avg_review_score avg_delivery_days",
    "kpi_payment_mix": "payment_type payment_records payment_value avg_payment_value",
    "kpi_seller_concentration": "total_gmv_revenue_eligible top_5_seller_gmv top_10_seller_gmv"
    " top_50_seller_gmv top_5_share top_10_share top_50_share",
    "kpi_join_risk_demo": "naive_gmv trusted_gmv_all_orders trusted_gmv_revenue_eligible"
    " gmv_overstatement_vs_all_orders",
    "kpi_seller_performance": "seller_state seller_id orders gmv_revenue_eligible"
    " avg_order_gmv_revenue_eligible",
    "kpi_seller_operational_risk": "seller_id seller_state orders_all orders_revenue_eligible"
    " gmv_revenue_eligible avg_order_gmv_revenue_eligible late_delivery_rate cancellation_rate"
    " avg_review_score",
    "data_quality_summary": "check_name issue_rows",
    "model_row_counts": "table_name row_count",
}


def test_published_columns(spark):
    reports = shop(spark).reports()
    assert set(reports) == set(PUBLISHED)
    for name, build in reports.items():
        assert build().columns == PUBLISHED[name].split(), name
