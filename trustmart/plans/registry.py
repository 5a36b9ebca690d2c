"""Every registered query: the Spark plan and, next to it, the independent SQL statement."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustmart.functions.clean import blank_to_null, norm_lower, norm_upper, parse_ts, zip5
from trustmart.functions.metrics import as_reported
from trustmart.operators import contracts, cube, dashboard, kpis, marts, monitors, people, quality, staging
from trustmart.operators.dedupe import asc_last, dedupe_keep_first, desc_last
from trustmart.plans.model import MOST_LINES, Model
from trustmart.plans.oracle import order_kpis_sql, statement
from trustmart.sources.adapter import DriverTables
from trustmart.sources.layers import (
    KPI,
    MARTS,
    STAGING,
    Buckets,
    Layers,
    PublicationLog,
    dealt,
    export,
    require_single_row,
    shared_folder,
    written,
)
from trustmart.sources.monthly import MonthlyFacts
from trustmart.sources.raw import read_raw, register
from trustmart.sources.winners import KeyedWinners, merged_in_batches

Plan = Callable[[Model], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Plan], Plan]:
    """Registers a plan over the model together with the SQL that must give the same rows."""

    def add(plan: Plan) -> Plan:
        QUERIES[name] = plan
        ORACLES[name] = sql
        return plan

    return add


def _everything(table: str, *money: str) -> str:
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in money)
    return f"SELECT * REPLACE ({casts}) FROM {table}" if money else f"SELECT * FROM {table}"


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex[:12]}"


# --- sources and sinks ----------------------------------------------------------------------


@query("csv_roundtrip", "SELECT * FROM raw_order_reviews")
def csv_roundtrip(m: Model) -> DataFrame:
    """Reviews (quotes and commas in free text) written as CSV and read back as a raw table."""
    reviews = m.raw("order_reviews")
    folder = _run_folder(reviews.sparkSession)
    (
        reviews.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(f"{folder}/order_reviews.csv")
    )
    stored = read_raw(reviews.sparkSession, folder, "order_reviews")
    return stored.withColumn("review_score", F.col("review_score").cast("int"))


@query("layer_roundtrip", "SELECT * FROM stg_orders")
def layer_roundtrip(m: Model) -> DataFrame:
    """A staging table replaced in its layer and read back from there."""
    spark = m.stg_orders.sparkSession
    layers = Layers(spark, _run_folder(spark), "trustmart_check_").create([STAGING])
    return layers.materialize(STAGING, "stg_orders", m.stg_orders)


@query("kpi_export_roundtrip", "SELECT * FROM kpi_monthly")
def kpi_export_roundtrip(m: Model) -> DataFrame:
    """A KPI table written by the report sink and read again."""
    monthly = m.monthly()
    layers = Layers(monthly.sparkSession, _run_folder(monthly.sparkSession))
    export(monthly, layers.path(KPI, "kpi_monthly"))
    return layers.read(KPI, "kpi_monthly")


@query("registered_view", "SELECT order_id, customer_id, order_status FROM raw_orders")
def registered_view(m: Model) -> DataFrame:
    """Raw orders under a name of their own, asked with SQL."""
    orders = m.raw("orders")
    register(orders, "vw_raw_orders")
    return orders.sparkSession.sql("SELECT order_id, customer_id, order_status FROM vw_raw_orders")


@query("single_row_guard", "SELECT * FROM kpi_headline")
def single_row_guard(m: Model) -> DataFrame:
    return require_single_row(m.headline())


# --- cleansing ------------------------------------------------------------------------------


@query(
    "dedupe_items",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST) = 1""",
)
def dedupe_items(m: Model) -> DataFrame:
    lines = m.source.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return dedupe_keep_first(
        lines,
        ["l_orderkey", "l_linenumber"],
        [desc_last("l_shipdate"), asc_last("l_partkey"), asc_last("l_suppkey")],
    )


@query(
    "dedupe_payments",
    """
    SELECT order_id, payment_sequential, payment_value::DOUBLE AS payment_value
    FROM raw_order_payments
    QUALIFY row_number() OVER (PARTITION BY order_id, payment_sequential
                               ORDER BY payment_value DESC NULLS LAST) = 1""",
)
def dedupe_payments(m: Model) -> DataFrame:
    payments = m.raw("order_payments").select("order_id", "payment_sequential", "payment_value")
    return as_reported(
        dedupe_keep_first(
            payments, ["order_id", "payment_sequential"], [desc_last("payment_value")]
        )
    )


_ORDER_TIMES = {
    "purchase_ts": "order_purchase_timestamp",
    "approved_ts": "order_approved_at",
    "carrier_ts": "order_delivered_carrier_date",
    "delivered_ts": "order_delivered_customer_date",
    "estimated_ts": "order_estimated_delivery_date",
}


@query(
    "parse_timestamps",
    "SELECT order_id, "
    + ", ".join(
        f"try_strptime({raw}, '%Y-%m-%d %H:%M:%S') AS {out}" for out, raw in _ORDER_TIMES.items()
    )
    + ", try_strptime(left(order_purchase_timestamp, 10), '%Y-%m-%d %H:%M:%S') AS date_only_ts"
    " FROM raw_orders",
)
def parse_timestamps(m: Model) -> DataFrame:
    return m.raw("orders").select(
        "order_id",
        *[parse_ts(raw).alias(out) for out, raw in _ORDER_TIMES.items()],
        parse_ts(F.substring("order_purchase_timestamp", 1, 10)).alias("date_only_ts"),
    )


@query(
    "normalize_codes",
    """
    SELECT order_status, city, state, count(*) AS orders
    FROM (SELECT lower(trim(r.order_status)) AS order_status, lower(trim(c.customer_city)) AS city,
                 upper(trim(c.customer_state)) AS state
          FROM raw_orders AS r JOIN raw_customers AS c USING (customer_id))
    GROUP BY ALL""",
)
def normalize_codes(m: Model) -> DataFrame:
    return (
        m.raw("orders")
        .join(m.raw("customers"), "customer_id")
        .groupBy(
            norm_lower("order_status").alias("order_status"),
            norm_lower("customer_city").alias("city"),
            norm_upper("customer_state").alias("state"),
        )
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "zip_pad",
    """
    SELECT customer_id, lpad(customer_zip_code_prefix, 5, '0') AS zip,
           lpad(customer_id || customer_id || customer_id, 5, '0') AS cut
    FROM raw_customers""",
)
def zip_pad(m: Model) -> DataFrame:
    tripled = F.concat("customer_id", "customer_id", "customer_id")
    return m.raw("customers").select(
        "customer_id", zip5("customer_zip_code_prefix").alias("zip"), zip5(tripled).alias("cut")
    )


@query(
    "blank_to_null",
    """
    SELECT review_id, nullif(trim(review_comment_title), '') AS title,
           nullif(trim(review_comment_message), '') AS message
    FROM raw_order_reviews""",
)
def blank_titles(m: Model) -> DataFrame:
    return m.raw("order_reviews").select(
        "review_id",
        blank_to_null("review_comment_title").alias("title"),
        blank_to_null("review_comment_message").alias("message"),
    )


# --- staging and marts ----------------------------------------------------------------------

_MODEL_TABLES = {
    "stage_orders": ("stg_orders", ()),
    "stage_order_items": ("stg_order_items", ("price", "freight_value")),
    "stage_order_payments": ("stg_order_payments", ("payment_value",)),
    "stage_order_reviews": ("stg_order_reviews", ()),
    "stage_customers": ("stg_customers", ()),
    "stage_products": ("stg_products", ()),
    "stage_sellers": ("stg_sellers", ()),
    "stage_geolocation_zip": ("stg_geolocation_zip", ()),
    "dim_customers": ("dim_customers", ()),
    "dim_sellers": ("dim_sellers", ()),
    "dim_dates": ("dim_dates", ()),
    "fact_order_items": ("fact_order_items", ("price", "freight_value", "gmv")),
    "fact_orders": (
        "fact_orders",
        (
            "item_price_value",
            "item_freight_value",
            "item_gmv",
            "revenue_eligible_gmv",
            "payment_value_total",
        ),
    ),
}


def _order_buckets(spark: SparkSession) -> Buckets:
    return Buckets("order_id", int(spark.conf.get("spark.sql.shuffle.partitions")))


def _dealt_by_order(m: Model, most_lines: int = MOST_LINES) -> Model:
    by_order = _order_buckets(m.raw("orders").sparkSession)
    return m.dealt_by_order(lambda df: dealt(df, by_order), by_order.count, most_lines)


def _model_table(attribute: str) -> Plan:
    return lambda m: as_reported(getattr(m, attribute))


for _name, (_attribute, _money) in _MODEL_TABLES.items():
    query(_name, _everything(_attribute, *_money))(_model_table(_attribute))


@query("fact_orders", ORACLES["fact_orders"])
def fact_orders(m: Model) -> DataFrame:
    """Order facts; orders, items and payments are shuffled by order id once."""
    return as_reported(_dealt_by_order(m).fact_orders)


query(
    "dim_geography",
    """
    SELECT zip_code_prefix, primary_city AS city, primary_state AS state,
           avg_latitude AS latitude, avg_longitude AS longitude
    FROM stg_geolocation_zip""",
)(lambda m: m.dim_geography)

query(
    "dim_products",
    """
    SELECT *, product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3
    FROM stg_products""",
)(lambda m: m.dim_products)

query(
    "item_rollup", _everything("item_rollup", "item_price_value", "item_freight_value", "item_gmv")
)(lambda m: as_reported(marts.rollup_items(m.fact_order_items)))

query("payment_rollup", _everything("payment_rollup", "payment_value_total"))(
    lambda m: as_reported(marts.rollup_payments(m.stg_order_payments))
)

query("review_rollup", "SELECT * FROM review_rollup")(
    lambda m: marts.rollup_reviews(m.stg_order_reviews)
)


query(
    "order_sequence",
    "SELECT order_id, customer_unique_id, customer_order_sequence FROM fact_orders",
)(Model.order_sequence)

query(
    "order_seller_performance",
    _everything("seller_orders", "seller_item_revenue", "seller_freight_revenue", "seller_gmv"),
)(lambda m: as_reported(m.order_seller_performance()))


# --- KPIs -----------------------------------------------------------------------------------

query("kpi_headline", "SELECT * FROM kpi_headline")(Model.headline)
query("kpi_monthly", "SELECT * FROM kpi_monthly")(Model.monthly)
query("kpi_weekly", "SELECT * FROM kpi_weekly")(Model.weekly)
query(
    "kpi_active_customers",
    """
    SELECT date_trunc('month', order_purchase_ts)::DATE AS month_start,
           count(DISTINCT customer_unique_id) AS active_customers
    FROM fact_orders GROUP BY month_start""",
)(Model.active_customers)
query("kpi_cohort_retention", "SELECT * FROM retention")(Model.cohort_retention)
query("kpi_delay_vs_reviews", "SELECT * FROM kpi_delay")(Model.delay_vs_reviews)
query("kpi_category", "SELECT * FROM kpi_category")(Model.category_performance)
query("kpi_seller", "SELECT * FROM kpi_seller")(Model.seller_performance)
query("kpi_state", "SELECT * FROM kpi_state")(Model.state_performance)
query("kpi_payment_mix", "SELECT * FROM kpi_payment")(Model.payment_mix)
query("kpi_seller_concentration", "SELECT * FROM kpi_concentration")(Model.seller_concentration)
query("join_risk_demo", "SELECT * FROM join_risk")(Model.join_risk)

_SELLER_RISK_SQL = """
    SELECT p.seller_id, s.seller_state, count(*) AS orders_all,
           count(*) FILTER (earning) AS orders_revenue_eligible,
           coalesce(sum(order_gmv) FILTER (earning), 0)::DOUBLE AS gmv_revenue_eligible,
           sum(order_gmv) FILTER (earning)::DOUBLE / count(order_gmv) FILTER (earning)
               AS avg_order_gmv_revenue_eligible,
           avg(coalesce(is_on_time_delivery = 0, FALSE)::INTEGER) AS late_delivery_rate,
           avg(is_canceled_or_unavailable) AS cancellation_rate,
           avg(avg_review_score) AS avg_review_score
    FROM (SELECT i.seller_id, o.order_id, sum(i.gmv) AS order_gmv,
                 any_value(o.is_revenue_eligible_order) = 1 AS earning,
                 any_value(o.is_on_time_delivery) AS is_on_time_delivery,
                 any_value(o.is_canceled_or_unavailable) AS is_canceled_or_unavailable,
                 any_value(o.avg_review_score) AS avg_review_score
          FROM fact_order_items AS i JOIN fact_orders AS o USING (order_id)
          GROUP BY i.seller_id, o.order_id) AS p
    LEFT JOIN stg_sellers AS s ON s.seller_id = p.seller_id
    GROUP BY p.seller_id, s.seller_state HAVING count(*) >= {min_orders}"""

query("kpi_seller_risk", _SELLER_RISK_SQL.format(min_orders=450))(lambda m: m.seller_risk(450))
query("kpi_seller_risk_default", _SELLER_RISK_SQL.format(min_orders=30))(Model.seller_risk)


@query(
    "headline_all_orders",
    """
    SELECT count(*) AS total_orders, sum(coalesce(item_gmv, 0))::DOUBLE AS total_gmv,
           sum(coalesce(item_gmv, 0))::DOUBLE / count(*) AS aov,
           avg(is_canceled_or_unavailable) AS cancellation_rate,
           avg(avg_review_score) AS avg_review_score, avg(delivery_days) AS avg_delivery_days,
           avg(is_on_time_delivery) AS on_time_delivery_rate
    FROM fact_orders""",
)
def headline_all_orders(m: Model) -> DataFrame:
    return kpis.headline_all_orders(m.orders)


_COUNTED = {
    "raw.orders": "raw_orders",
    "raw.order_items": "raw_order_items",
    "raw.order_payments": "raw_order_payments",
    "raw.order_reviews": "raw_order_reviews",
    "raw.customers": "raw_customers",
    "raw.products": "raw_products",
    "raw.sellers": "raw_sellers",
    "raw.geolocation": "raw_geolocation",
    "marts.fact_orders": "fact_orders",
    "marts.fact_order_items": "fact_order_items",
    "marts.dim_customers": "dim_customers",
    "marts.dim_products": "stg_products",
    "marts.dim_sellers": "dim_sellers",
    "marts.dim_dates": "dim_dates",
    "kpi.seller_concentration": "kpi_concentration",
    "kpi.weekly_ops": "kpi_weekly",
    "kpi.customer_cohort_retention": "retention",
}

query(
    "model_row_counts",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"
        for name, table in _COUNTED.items()
    ),
)(Model.row_counts)


# --- over facts that are stored by order ----------------------------------------------------


def _stored_by_order(m: Model, most_lines: int = MOST_LINES) -> tuple[DataFrame, DataFrame, bool]:
    """Item and order facts, stored in buckets by order id as a publication stores them, and whether
    the items are in buckets, too.

    Raw rows are dealt by order once, and orders sum up their lines from the stored item facts. Where an
    order has too many rows for one task, rows are de-duplicated and joined under their own keys, and
    the item facts are stored plainly, as in a publication.
    """
    spark = m.raw("orders").sparkSession
    layers = Layers(spark, _run_folder(spark), "trustmart_check_")
    by_order = _order_buckets(spark)
    by = _dealt_by_order(m, most_lines)
    if by.deal:
        items = layers.write_bucketed(MARTS, "fact_order_items", by.fact_order_items, by_order)
    else:
        items = layers.write(MARTS, "fact_order_items", by.fact_order_items)
    orders = marts.order_facts(by.stg_orders, items, by.payment_values, by.stg_order_reviews)
    if not by.deal:
        orders = dealt(orders, by_order)
    return items, layers.write_bucketed(MARTS, "fact_orders", orders, by_order), by.deal is not None


def _facts_by_order(m: Model, most_lines: int = MOST_LINES) -> tuple[DataFrame, DataFrame]:
    return _stored_by_order(m, most_lines)[:2]


query("stored_seller_risk", ORACLES["kpi_seller_risk"])(
    lambda m: kpis.seller_risk(*_facts_by_order(m), m.sellers, 450)
)


@query("stored_category", ORACLES["kpi_category"])
def stored_category(m: Model, most_lines: int = MOST_LINES) -> DataFrame:
    items, orders, in_place = _stored_by_order(m, most_lines)
    return kpis.category_performance(items, orders, m.products, in_place)


@query("stored_seller_concentration", ORACLES["kpi_seller_concentration"])
def stored_seller_concentration(m: Model, most_lines: int = MOST_LINES) -> DataFrame:
    items, orders, in_place = _stored_by_order(m, most_lines)
    return kpis.seller_concentration(items, orders, in_place=in_place)


# --- data quality and contracts -------------------------------------------------------------

query("data_quality_summary", "SELECT * FROM dq")(Model.data_quality)

for _check in quality.ORDER_CHECKS:
    query(f"check_{_check}", f"SELECT * FROM dq WHERE check_name = '{_check}'")(
        lambda m, c=_check: quality.order_checks(m.stg_orders).filter(F.col("check_name") == c)
    )

query(
    f"check_{quality.DUPLICATE_ORDERS}",
    f"SELECT * FROM dq WHERE check_name = '{quality.DUPLICATE_ORDERS}'",
)(lambda m: quality.duplicate_orders(m.raw("orders")))
query(
    f"check_{quality.DUPLICATE_ITEMS}",
    f"SELECT * FROM dq WHERE check_name = '{quality.DUPLICATE_ITEMS}'",
)(lambda m: quality.duplicate_items(m.raw("order_items")))
query(
    f"check_{quality.DUPLICATE_ZIPS}",
    f"SELECT * FROM dq WHERE check_name = '{quality.DUPLICATE_ZIPS}'",
)(lambda m: quality.duplicate_zips(m.raw("geolocation")))

query(
    "gmv_reconciliation",
    """
    SELECT i.gmv::DOUBLE AS item_level_gmv, o.gmv::DOUBLE AS order_level_gmv,
           (i.gmv - o.gmv)::DOUBLE AS difference_should_be_zero
    FROM (SELECT sum(gmv) AS gmv FROM fact_order_items) AS i
    CROSS JOIN (SELECT sum(item_gmv) AS gmv FROM fact_orders) AS o""",
)(lambda m: contracts.gmv_reconciliation(m.fact_order_items, m.orders))

query("contract_results", "SELECT * FROM contract_results")(Model.contract_results)
query(
    "contract_summary",
    """
    SELECT count(*) AS total_tests, count(*) FILTER (status = 'FAIL') AS failed_tests,
           count(*) FILTER (status = 'FAIL' AND severity = 'critical') AS critical_failed
    FROM contract_results""",
)(lambda m: contracts.summarize(m.contract_results()))


@query(
    "publication_gate",
    """
    SELECT 'clean' AS run, count(*) FILTER (status = 'FAIL' AND severity = 'critical')
               AS critical_failed,
           count(*) FILTER (status = 'FAIL' AND severity = 'critical') = 0 AS released
    FROM contract_results
    UNION ALL
    SELECT 'no products', count(*) FILTER (severity = 'critical' AND (status = 'FAIL'
               OR test_name = 'Fact Order Items product foreign key integrity')), false
    FROM contract_results""",
)
def publication_gate(m: Model) -> DataFrame:
    """What the gate releases: the tables as they are, and the same without any product.

    The contracts read stored facts, as in a publication. No fact looks at products, so both runs have
    the same ones.
    """
    spark = m.raw("orders").sparkSession
    log = PublicationLog(spark, _run_folder(spark))
    without = Model(lambda name: m.raw(name).filter(F.lit(name != "products")))
    items, orders = _facts_by_order(m)
    runs = []
    for run, model in (("clean", m), ("no products", without)):
        model.fact_order_items, model.orders = items, orders
        path = f"{log.run_path(run)}/summary"
        export(contracts.summarize(model.contract_results()), path)
        summary = spark.read.parquet(path)
        try:
            contracts.gate(summary)
            log.release(run)
        except contracts.PublicationBlocked:
            pass
        released = F.lit(log.is_released(run))
        runs.append(summary.select(F.lit(run).alias("run"), "critical_failed", released.alias("released")))
    return runs[0].unionByName(runs[1])


# --- dashboard ------------------------------------------------------------------------------

query("page1_trend", "SELECT * FROM kpi_monthly WHERE total_orders > 180")(
    lambda m: dashboard.trend(m.monthly(), 180)
)

query("page1_trend_default", "SELECT * FROM kpi_monthly WHERE total_orders > 100")(
    lambda m: dashboard.trend(m.monthly())
)

query(
    "page2_delay_spine",
    """
    SELECT b.delay_bucket, b.bucket_order, k.orders, k.avg_review_score
    FROM (VALUES ('On time or early', 1::BIGINT), ('1-3 days late', 2), ('4-7 days late', 3),
                 ('8+ days late', 4), ('Not Delivered', 5)) AS b(delay_bucket, bucket_order)
    LEFT JOIN kpi_delay AS k ON k.delay_bucket = b.delay_bucket""",
)(lambda m: dashboard.delay_spine(m.delay_vs_reviews()))

query(
    "top_states_by_orders",
    "SELECT * FROM kpi_state ORDER BY orders DESC, customer_state LIMIT 10",
)(lambda m: dashboard.top_states_by_orders(m.state_performance()))
query(
    "top_states_by_gmv",
    "SELECT * FROM kpi_state ORDER BY gmv_revenue_eligible DESC, customer_state LIMIT 10",
)(lambda m: dashboard.top_states_by_gmv(m.state_performance()))
query(
    "top_categories",
    "SELECT * FROM kpi_category ORDER BY gmv_revenue_eligible DESC, category LIMIT 12",
)(lambda m: dashboard.top_categories(m.category_performance()))
query(
    "top_sellers",
    "SELECT * FROM kpi_seller ORDER BY gmv_revenue_eligible DESC, seller_id LIMIT 12",
)(lambda m: dashboard.top_sellers(m.seller_performance()))
query(
    "payment_share",
    """
    SELECT k.*, k.payment_value / t.total AS value_share
    FROM kpi_payment AS k
    CROSS JOIN (SELECT sum(payment_value)::DOUBLE AS total FROM stg_order_payments) AS t""",
)(lambda m: dashboard.payment_share(m.payment_mix()))
query("dq_sorted", "SELECT * FROM dq ORDER BY issue_rows DESC, check_name")(
    lambda m: dashboard.sort_findings(m.data_quality())
)
query(
    "kpi_cards",
    """
    SELECT 'Primary GMV' AS title, printf('R$%.2fM', gmv_revenue_eligible / 1000000) AS value,
           'Revenue-eligible orders only' AS subtitle FROM kpi_headline
    UNION ALL
    SELECT 'Orders', format('{:,}', total_orders), 'All order statuses' FROM kpi_headline
    UNION ALL
    SELECT 'Primary AOV', printf('R$%.2f', aov_revenue_eligible),
           'Revenue-eligible GMV / eligible orders' FROM kpi_headline
    UNION ALL
    SELECT 'Cancellation Rate', printf('%.1f%%', cancellation_rate * 100),
           'Canceled + unavailable' FROM kpi_headline""",
)(lambda m: dashboard.kpi_cards(m.headline()))
query(
    "join_risk_panel",
    """
    SELECT unnest(['Naive join GMV', 'Trusted GMV (all orders)', 'Overstatement risk']) AS label,
           unnest([format('R${:,}', round(naive_gmv)::BIGINT),
                   format('R${:,}', round(trusted_gmv_all_orders)::BIGINT),
                   format('R${:,}', round(gmv_overstatement_vs_all_orders)::BIGINT)]) AS value
    FROM join_risk""",
)(lambda m: dashboard.join_risk_panel(m.join_risk()))


# --- monitors and BI measures ---------------------------------------------------------------

query(
    "repeat_customer_rate",
    """
    SELECT count(*) AS total_customers, count(*) FILTER (n > 1) AS repeat_customers,
           count(*) FILTER (n > 1)::DOUBLE / count(*) AS repeat_customer_rate
    FROM (SELECT customer_unique_id, count(*) AS n FROM fact_orders
          WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id)""",
)(lambda m: monitors.repeat_rate(m.orders_of_people))

query(
    "freshness",
    """
    SELECT max(order_purchase_ts) AS latest_ts, DATE '2001-08-05' AS as_of,
           DATE '2001-08-05' - max(order_purchase_ts)::DATE AS lag_days,
           if(DATE '2001-08-05' - max(order_purchase_ts)::DATE <= 2, 'OK', 'WARN') AS status
    FROM fact_orders""",
)(lambda m: monitors.freshness(m.orders, date(2001, 8, 5)))

query(
    "volume_anomaly",
    """
    SELECT date_day, orders, history_days, trailing_mean, trailing_stddev,
           (orders - trailing_mean) / nullif(trailing_stddev, 0) AS z_score,
           if(coalesce(abs((orders - trailing_mean) / nullif(trailing_stddev, 0)) > 3, FALSE), 1, 0)
               AS is_anomaly
    FROM (SELECT date_day, n AS orders, count(*) OVER past AS history_days,
                 (sum(n) OVER past)::DOUBLE / nullif(count(*) OVER past, 0) AS trailing_mean,
                 sqrt((count(*) OVER past * sum(n * n) OVER past
                       - (sum(n) OVER past) * (sum(n) OVER past))::DOUBLE
                      / nullif((count(*) OVER past * (count(*) OVER past - 1))::DOUBLE, 0))
                     AS trailing_stddev
          FROM daily
          WINDOW past AS (ORDER BY date_day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))""",
)(lambda m: monitors.volume_anomaly(m.stg_orders))

_BANDS = {"gmv_revenue_eligible": (20_000_000.0, 35_000_000.0), "cancellation_rate": (0.0, 0.15)}

query(
    "kpi_drift",
    "\nUNION ALL\n".join(
        f"SELECT month_start, '{kpi}' AS kpi, {kpi} AS value, {low}::DOUBLE AS lower_bound,"
        f" {high}::DOUBLE AS upper_bound,"
        f" if({kpi} BETWEEN {low} AND {high}, 'IN_BAND', 'DRIFT') AS status FROM kpi_monthly"
        for kpi, (low, high) in _BANDS.items()
    ),
)(lambda m: monitors.kpi_drift(m.monthly(), _BANDS, ["month_start"]))

query(
    "bi_measures",
    """
    SELECT h.revenue_eligible_orders, h.gmv_all_orders, h.gmv_revenue_eligible,
           h.aov_revenue_eligible, h.cancellation_rate, h.avg_review_score, h.avg_delivery_days,
           h.on_time_rate AS on_time_delivery_rate,
           c.top_10_share AS top_10_seller_gmv_share
    FROM kpi_headline AS h CROSS JOIN kpi_concentration AS c""",
)(lambda m: monitors.bi_measures(m.orders, m.order_lines))

_SLICED_HEADLINE_SQL = """
    SELECT count(*) AS total_orders,
           count(*) FILTER (is_revenue_eligible_order = 1) AS revenue_eligible_orders,
           coalesce(sum(coalesce(item_gmv, 0)), 0)::DOUBLE AS gmv_all_orders,
           sum(revenue_eligible_gmv)::DOUBLE AS gmv_revenue_eligible,
           sum(revenue_eligible_gmv)::DOUBLE
               / nullif(count(*) FILTER (is_revenue_eligible_order = 1), 0) AS aov_revenue_eligible,
           avg(is_canceled_or_unavailable) AS cancellation_rate,
           avg(avg_review_score) AS avg_review_score, avg(delivery_days) AS avg_delivery_days,
           avg(is_on_time_delivery) AS on_time_rate
    FROM fact_orders WHERE """


@query(
    "sliced_headline",
    _SLICED_HEADLINE_SQL
    + """order_purchase_ts BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31 23:59:59'
          AND order_status IN ('delivered', 'shipped')
          AND customer_id IN (SELECT customer_id FROM stg_customers
                              WHERE customer_state IN ('EUROPE', 'ASIA'))""",
)
def sliced_headline(m: Model) -> DataFrame:
    """Headline for a date range, two statuses and two customer states."""
    chosen = monitors.apply_slicers(m.customers, {"customer_state": ["EUROPE", "ASIA"]})
    orders = monitors.apply_slicers(
        m.orders,
        {"order_status": ["delivered", "shipped"]},
        {"order_purchase_ts": (datetime(1996, 1, 1), datetime(1999, 12, 31, 23, 59, 59))},
    )
    return kpis.headline(monitors.orders_of_customers(orders, chosen))


@query(
    "sliced_headline_items",
    _SLICED_HEADLINE_SQL
    + """is_revenue_eligible_order = 1
          AND order_id IN (SELECT i.order_id FROM fact_order_items AS i
                           JOIN stg_products AS p USING (product_id)
                           JOIN stg_sellers AS s ON s.seller_id = i.seller_id
                           WHERE p.product_category_name_en = 'promo'
                             AND s.seller_state = 'ASIA')""",
)
def sliced_headline_items(m: Model) -> DataFrame:
    """Primary headline of orders that hold a line of one category from sellers of one state."""
    products = monitors.apply_slicers(m.products, {"product_category_name_en": "promo"})
    sellers = monitors.apply_slicers(m.sellers, {"seller_state": "ASIA"})
    lines = monitors.sliced_items(m.order_lines, products, sellers)
    orders = monitors.apply_slicers(m.orders, revenue_view="primary")
    return kpis.headline(monitors.orders_with_items(orders, lines))


query(
    "weekly_watch",
    """
    SELECT date_trunc('week', order_purchase_ts)::DATE AS week_start, count(*) AS total_orders,
           avg(is_on_time_delivery) AS on_time_delivery_rate,
           count(*) FILTER (delay_bucket IN ('4-7 days late', '8+ days late'))::DOUBLE
               / nullif(count(delivery_days), 0) AS late_4_plus_share,
           avg(is_canceled_or_unavailable) AS cancellation_rate,
           avg(avg_review_score) FILTER (delay_bucket = 'On time or early')
               AS review_on_time_or_early,
           avg(avg_review_score) FILTER (delay_bucket = '1-3 days late') AS review_1_3_days_late,
           avg(avg_review_score) FILTER (delay_bucket = '4-7 days late') AS review_4_7_days_late,
           avg(avg_review_score) FILTER (delay_bucket = '8+ days late') AS review_8_plus_days_late,
           avg(avg_review_score) FILTER (delay_bucket = 'Not Delivered') AS review_not_delivered
    FROM delays GROUP BY week_start""",
)(lambda m: monitors.weekly_watch(m.orders))

query(
    "category_reviews",
    """
    SELECT category, count(*) AS orders, count(avg_review_score) AS reviewed_orders,
           avg(avg_review_score) AS avg_review_score
    FROM (SELECT DISTINCT coalesce(p.product_category_name_en, 'unknown') AS category,
                 o.order_id, o.avg_review_score
          FROM fact_order_items AS i
          JOIN fact_orders AS o ON o.order_id = i.order_id AND o.is_revenue_eligible_order = 1
          LEFT JOIN stg_products AS p ON p.product_id = i.product_id)
    GROUP BY category""",
)(lambda m: monitors.category_reviews(m.order_lines, m.orders, m.products))


# --- batch by batch, month by month ----------------------------------------------------------


def _in_batches(m: Model, table: str) -> DataFrame:
    """A staging table from three batches of its raw rows, the last of which is committed twice."""
    raw_name, typed = {
        "stg_orders": ("orders", staging.typed_orders),
        "stg_order_items": ("order_items", staging.typed_order_items),
    }[table]
    raw = m.raw(raw_name)
    numbered = raw.withColumn("__batch", F.pmod(F.xxhash64(*raw.columns), F.lit(3)))
    # Copies stay in: a commit drops them in the shuffle that merges.
    parts = [typed(numbered.filter(F.col("__batch") == i).drop("__batch")) for i in (2, 0, 1, 1)]
    spark = raw.sparkSession
    winners = KeyedWinners(spark, _run_folder(spark), parts[0].schema, staging.RULES[table])
    return merged_in_batches(winners, list(zip(("two", "zero", "one", "one"), parts, strict=True)))


query("incremental_orders", ORACLES["stage_orders"])(lambda m: _in_batches(m, "stg_orders"))
query("incremental_order_items", ORACLES["stage_order_items"])(
    lambda m: as_reported(_in_batches(m, "stg_order_items"))
)


@query("sliced_headline_by_month", ORACLES["sliced_headline"])
def sliced_headline_by_month(m: Model) -> DataFrame:
    """The sliced headline over facts that are stored by month: the slicer's months are read."""
    spark = m.stg_orders.sparkSession
    store = MonthlyFacts(spark, _run_folder(spark), m.orders.schema)
    store.create(m.orders)
    first, last = datetime(1996, 1, 1), datetime(1999, 12, 31, 23, 59, 59)
    chosen = monitors.apply_slicers(m.customers, {"customer_state": ["EUROPE", "ASIA"]})
    orders = monitors.apply_slicers(
        store.read(first, last), {"order_status": ["delivered", "shipped"]}, {"order_purchase_ts": (first, last)}
    )
    return kpis.headline(monitors.orders_of_customers(orders, chosen))


# --- folded from stored sums and bitmaps ------------------------------------------------------


def _cube(m: Model) -> DataFrame:
    """The daily cube, stored: the reports below read nothing else."""
    return written(m.daily_cube, "daily-cube")


query("cube_headline", ORACLES["kpi_headline"])(lambda m: cube.headline(_cube(m)))
query("cube_monthly", ORACLES["kpi_monthly"])(lambda m: cube.period_kpis(_cube(m), "month"))
query("cube_weekly", ORACLES["kpi_weekly"])(lambda m: cube.period_kpis(_cube(m), "week"))
query("cube_delay_vs_reviews", ORACLES["kpi_delay_vs_reviews"])(lambda m: cube.delay_vs_reviews(_cube(m)))
query("cube_weekly_watch", ORACLES["weekly_watch"])(lambda m: cube.weekly_watch(_cube(m)))
query(
    "cube_levels",
    "\nUNION ALL\n".join(
        [
            *[
                f"SELECT '{unit}' AS level, date_trunc('{unit}', order_purchase_ts)::DATE AS period_start,"
                f" NULL AS delay_bucket, {order_kpis_sql('on_time_delivery_rate')} FROM delays GROUP BY 2"
                for unit in cube.UNITS
            ],
            f"SELECT 'bucket', NULL, delay_bucket, {order_kpis_sql('on_time_delivery_rate')} FROM delays"
            " GROUP BY delay_bucket",
        ]
    ),
)(lambda m: cube.levels(_cube(m)))


def _bitmaps(m: Model) -> DataFrame:
    """Month bitmaps of all orders, made from two batches; the second brings people of its own."""
    orders = m.orders_of_people.select("order_purchase_ts", "customer_unique_id")
    active = written(people.activity(orders), "activity")
    late = F.year("month_start") >= 1995
    batches = active.filter(~F.coalesce(late, F.lit(True))), active.filter(F.coalesce(late, F.lit(True)))
    # One number reaches the driver.
    parts = people.parts_for(active.filter("person is not null").count())
    numbers = written(people.numbered(batches[0], "person", parts), "numbers")
    more = written(people.numbered(batches[1], "person", parts, numbers), "more-numbers")
    maps = [people.month_bitmaps(part, known) for part, known in zip(batches, (numbers, more), strict=True)]
    return written(people.merged(maps[0].unionByName(maps[1])), "bitmaps")


@query(
    "active_customers_by_unit",
    "\nUNION ALL\n".join(
        f"SELECT '{unit}' AS unit, date_trunc('{unit}', order_purchase_ts)::DATE AS period_start,"
        " count(DISTINCT customer_unique_id) AS active_customers FROM fact_orders GROUP BY period_start"
        for unit in ("month", "quarter", "year")
    ),
)
def active_customers_by_unit(m: Model) -> DataFrame:
    """Distinct customers of months, quarters and years, folded from one set of month bitmaps."""
    maps = _bitmaps(m)

    def of(unit: str) -> DataFrame:
        rows = people.active_customers(maps, unit).withColumnRenamed(f"{unit}_start", "period_start")
        return rows.select(F.lit(unit).alias("unit"), "period_start", "active_customers")

    return of("month").unionByName(of("quarter")).unionByName(of("year"))


query("repeat_rate_by_bitmaps", ORACLES["repeat_customer_rate"])(lambda m: people.repeat_rate(_bitmaps(m)))


# --- access ---------------------------------------------------------------------------------


class DriverModel(Model):
    """The lazy model over one directory of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.source = DriverTables(spark, sf_dir)
        super().__init__(self.source.raw)


def model_over(spark: SparkSession, sf_dir: str) -> DriverModel:
    """A model of the tables as they are now. Each query gets its own: a model stores order places on
    the way, which would be out of date as soon as a file changes."""
    return DriverModel(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plan(model_over(spark, sf_dir))

    return {name: runner(plan) for name, plan in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in ORACLES.items()}
