"""Dashboard data, monitors and BI measures."""

from datetime import date, datetime

import pytest

from tests.rows import bag, by, frame
from tests.shop import shop
from trustmart.operators import dashboard, kpis, monitors


def test_trend_drops_thin_months(spark):
    monthly = frame(spark, "month_start string, total_orders bigint", ("a", 100), ("b", 101))
    assert bag(dashboard.trend(monthly)) == [("b", 101)]


def test_missing_delay_bucket_stays_as_null_row(spark):
    delays = frame(
        spark,
        "delay_bucket string, orders bigint, avg_review_score double",
        ("Not Delivered", 2, 1.0),
    )
    rows = dashboard.delay_spine(delays).orderBy("bucket_order").collect()
    assert [r.delay_bucket for r in rows] == [
        "On time or early",
        "1-3 days late",
        "4-7 days late",
        "8+ days late",
        "Not Delivered",
    ]
    assert [r.orders for r in rows] == [None, None, None, None, 2]


def test_top_n_breaks_ties_by_key(spark):
    states = frame(
        spark, "customer_state string, orders bigint", ("b", 1), ("a", 1), ("c", 2), ("d", None)
    )
    top = [r.customer_state for r in dashboard.top_states_by_orders(states, 2).collect()]
    assert top == ["c", "a"]


def test_payment_share(spark):
    rows = by(dashboard.payment_share(shop(spark).payment_mix()), "payment_type")
    assert rows["voucher"].value_share == pytest.approx(24 / 183.5)
    assert sum(r.value_share for r in rows.values()) == pytest.approx(1)


def test_kpi_cards(spark):
    head = frame(
        spark,
        "gmv_revenue_eligible double, total_orders bigint, aov_revenue_eligible double,"
        " cancellation_rate double",
        (15740216.93, 99441, 160.28897, 0.012409),
    )
    values = {r.title: r.value for r in dashboard.kpi_cards(head).collect()}
    assert values == {
        "Primary GMV": "R$15.74M",
        "Orders": "99,441",
        "Primary AOV": "R$160.29",
        "Cancellation Rate": "1.2%",
    }


def test_repeat_rate_leaves_unknown_people_out(spark):
    (row,) = monitors.repeat_rate(shop(spark).orders_of_people).collect()
    assert (row.total_customers, row.repeat_customers, row.repeat_customer_rate) == (2, 2, 1.0)


@pytest.mark.parametrize(("as_of", "status"), [(5, "OK"), (6, "WARN")])
def test_freshness(spark, as_of, status):
    m = shop(spark)
    (row,) = monitors.freshness(m.orders, date(2018, 1, as_of)).collect()
    assert row.latest_ts == datetime(2018, 1, 3, 10)
    assert (row.lag_days, row.status) == (as_of - 3, status)


def test_freshness_without_data_warns(spark):
    facts = frame(spark, "order_purchase_ts timestamp_ntz")
    assert monitors.freshness(facts, date(2018, 1, 1)).first().status == "WARN"


def test_volume_anomaly_counts_empty_days(spark):
    days = [datetime(2020, 1, d) for d in (1, 1, 2, 4, 5, 5, 5, 5, 5, 5, 5, 5)]
    facts = frame(spark, "order_purchase_ts timestamp_ntz", *[(d,) for d in days])
    rows = by(monitors.volume_anomaly(facts, window=3, z=3.0), "date_day")
    assert [rows[date(2020, 1, d)].orders for d in range(1, 6)] == [2, 1, 0, 1, 8]
    first, last = rows[date(2020, 1, 1)], rows[date(2020, 1, 5)]
    assert (first.history_days, first.z_score, first.is_anomaly) == (0, None, 0)
    # The three days before: 1, 0 and 1.
    assert last.history_days == 3
    assert last.trailing_mean == pytest.approx(2 / 3)
    assert last.trailing_stddev == pytest.approx((1 / 3) ** 0.5)
    assert last.is_anomaly == 1


def test_drift(spark):
    df = frame(spark, "m string, a double, b double", ("x", 1.0, 5.0), ("y", 2.0, None))
    rows = bag(monitors.kpi_drift(df, {"a": (0, 1), "b": (0, 9)}, ["m"]).select("m", "kpi", "status"))
    assert rows == [
        ("x", "a", "IN_BAND"),
        ("x", "b", "IN_BAND"),
        ("y", "a", "DRIFT"),
        ("y", "b", "DRIFT"),
    ]


def test_slicers(spark):
    m = shop(spark)
    november = monitors.apply_slicers(
        m.orders,
        {"order_status": ["delivered", "canceled"]},
        {"order_purchase_ts": (datetime(2017, 11, 1), datetime(2017, 11, 30))},
    )
    assert {r.order_id for r in november.collect()} == {"o1", "o3"}
    primary = monitors.apply_slicers(m.orders, revenue_view="primary")
    assert kpis.headline(primary).first().total_orders == 3
    with pytest.raises(ValueError, match="revenue view"):
        monitors.apply_slicers(m.orders, revenue_view="net")


def test_slices_through_customers_and_items(spark):
    m = shop(spark)
    of_rio = monitors.orders_of_customers(m.orders, m.customers.filter("customer_state = 'RJ'"))
    assert {r.order_id for r in of_rio.collect()} == {"o1", "o2"}
    with_s3 = monitors.orders_with_items(m.orders, m.order_lines.filter("seller_id = 's3'"))
    assert {r.order_id for r in with_s3.collect()} == {"o3", "o6"}


def test_slicer_filters_reach_the_scan(small_model, spark):
    fact = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    sliced = monitors.apply_slicers(fact, {"o_orderstatus": "F"})
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan


def test_weekly_watch(spark):
    rows = by(monitors.weekly_watch(shop(spark).orders), "week_start")
    week = rows[date(2017, 12, 25)]
    # One delivery without an estimate: it counts as 8+ days late.
    assert (week.total_orders, week.late_4_plus_share) == (1, 1.0)
    assert week.on_time_delivery_rate is None
    assert rows[date(2017, 11, 27)].late_4_plus_share is None


def test_category_reviews(spark):
    m = shop(spark)
    rows = by(monitors.category_reviews(m.order_lines, m.orders, m.products), "category")
    assert (rows["home"].orders, rows["home"].avg_review_score) == (2, 4.25)
    assert (rows["unknown"].orders, rows["unknown"].reviewed_orders) == (2, 1)


def test_bi_measures(spark):
    m = shop(spark)
    row = monitors.bi_measures(m.orders, m.order_lines).first()
    assert row.top_10_seller_gmv_share == 1.0
    assert row.revenue_eligible_orders == 3
