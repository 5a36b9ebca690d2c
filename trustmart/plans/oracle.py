"""Independent SQL statements of every registered query, for a second engine.

Each statement is assembled from the common table expressions it needs. They state the definition
directly (literal many-to-many join, window over all rows, one scan per check) where the Spark
operators take a cheaper route to the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Collection

TS = "'%Y-%m-%d %H:%M:%S'"


def _ts(col: str) -> str:
    return f"try_strptime({col}, {TS})"


CTES: dict[str, str] = {
    # --- raw tables out of the driver tables ---
    "raw_orders": f"""
        SELECT o_orderkey::VARCHAR AS order_id,
               o_custkey::VARCHAR AS customer_id,
               CASE WHEN o_orderstatus = 'F' THEN ' Delivered '
                    WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'CANCELED'
                    WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'unavailable'
                    ELSE 'shipped' END AS order_status,
               strftime(bought, {TS}) AS order_purchase_timestamp,
               strftime(bought + INTERVAL 1 HOUR, {TS}) AS order_approved_at,
               CASE WHEN o_orderstatus = 'F'
                    THEN strftime(bought + INTERVAL 2 DAY, {TS}) END
                   AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0
                    THEN strftime(bought + to_days((5 + o_orderkey % 31)::INTEGER), {TS}) END
                   AS order_delivered_customer_date,
               strftime(o_orderdate + to_days((20 + o_orderkey % 11)::INTEGER), {TS})
                   AS order_estimated_delivery_date
        FROM (SELECT *, o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS bought FROM orders)""",
    "raw_order_items": f"""
        SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS order_item_id,
               l_partkey::VARCHAR AS product_id, l_suppkey::VARCHAR AS seller_id,
               strftime(l_shipdate, {TS}) AS shipping_limit_date,
               l_extendedprice::DECIMAL(14,2) AS price,
               l_extendedprice::DECIMAL(14,2) * l_tax::DECIMAL(4,2) AS freight_value
        FROM lineitem""",
    "raw_order_payments": """
        SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN 'Credit_Card ' WHEN 'R' THEN 'boleto'
                                 ELSE 'voucher' END AS payment_type,
               trunc(l_quantity)::INTEGER AS payment_installments,
               l_extendedprice::DECIMAL(14,2) AS payment_value
        FROM lineitem""",
    "raw_order_reviews": f"""
        SELECT event_id::VARCHAR AS review_id, (event_id - event_id % 2)::VARCHAR AS order_id,
               (1 + floor(value)::BIGINT % 5)::INTEGER AS review_score,
               CASE WHEN event_id % 3 = 0 THEN ' ' ELSE event_type END AS review_comment_title,
               props AS review_comment_message,
               strftime(ts, {TS}) AS review_creation_date,
               strftime(ts + INTERVAL 1 DAY, {TS}) AS review_answer_timestamp
        FROM events""",
    "places": """
        SELECT n_nationkey, n_name, r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw_customers": """
        SELECT c_custkey::VARCHAR AS customer_id,
               (c_custkey - c_custkey % 2)::VARCHAR AS customer_unique_id,
               c_nationkey::VARCHAR AS customer_zip_code_prefix,
               ' ' || n_name AS customer_city, lower(r_name) AS customer_state
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "raw_sellers": """
        SELECT s_suppkey::VARCHAR AS seller_id, s_nationkey::VARCHAR AS seller_zip_code_prefix,
               ' ' || n_name AS seller_city, lower(r_name) AS seller_state
        FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "raw_products": """
        SELECT p_partkey::VARCHAR AS product_id, p_type AS product_category_name,
               length(p_name)::INTEGER AS product_name_lenght,
               p_size * 10 AS product_description_lenght, p_size % 5 AS product_photos_qty,
               p_retailprice AS product_weight_g, p_size::DOUBLE AS product_length_cm,
               (p_size + 1)::DOUBLE AS product_height_cm, (p_size + 2)::DOUBLE AS product_width_cm
        FROM part""",
    "raw_category_translation": """
        SELECT DISTINCT p_type AS product_category_name,
               lower(p_type) AS product_category_name_english
        FROM part WHERE p_type <> 'ECONOMY'""",
    "raw_geolocation": """
        SELECT nationkey::VARCHAR AS geolocation_zip_code_prefix,
               acctbal::DECIMAL(12,2) * 0.01 AS geolocation_lat,
               acctbal::DECIMAL(12,2) * -0.005 AS geolocation_lng,
               place AS geolocation_city, r_name AS geolocation_state
        FROM (SELECT c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS place
              FROM customer
              UNION ALL
              SELECT s_nationkey, s_acctbal, 'depot' FROM supplier)
        JOIN places ON nationkey = n_nationkey""",
    # --- staging ---
    "stg_orders": f"""
        SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
               {_ts('order_purchase_timestamp')} AS order_purchase_ts,
               {_ts('order_approved_at')} AS order_approved_ts,
               {_ts('order_delivered_carrier_date')} AS delivered_carrier_ts,
               {_ts('order_delivered_customer_date')} AS delivered_customer_ts,
               {_ts('order_estimated_delivery_date')} AS estimated_delivery_ts
        FROM raw_orders AS r
        QUALIFY row_number() OVER (
            PARTITION BY order_id
            ORDER BY order_purchase_ts DESC NULLS LAST, customer_id NULLS LAST,
                     lower(trim(r.order_status)) NULLS LAST) = 1""",
    "stg_order_items": f"""
        SELECT order_id, order_item_id, product_id, seller_id,
               {_ts('shipping_limit_date')} AS shipping_limit_ts, price, freight_value
        FROM raw_order_items
        QUALIFY row_number() OVER (
            PARTITION BY order_id, order_item_id
            ORDER BY shipping_limit_ts DESC NULLS LAST, seller_id NULLS LAST,
                     product_id NULLS LAST, price DESC NULLS LAST,
                     freight_value DESC NULLS LAST) = 1""",
    "stg_order_payments": """
        SELECT order_id, payment_sequential, lower(trim(r.payment_type)) AS payment_type,
               payment_installments, payment_value
        FROM raw_order_payments AS r
        QUALIFY row_number() OVER (
            PARTITION BY order_id, payment_sequential
            ORDER BY payment_value DESC NULLS LAST, lower(trim(r.payment_type)) NULLS LAST,
                     payment_installments DESC NULLS LAST) = 1""",
    "stg_order_reviews": f"""
        SELECT review_id, order_id, review_score,
               nullif(trim(r.review_comment_title), '') AS review_comment_title,
               nullif(trim(r.review_comment_message), '') AS review_comment_message,
               {_ts('review_creation_date')} AS review_creation_ts,
               {_ts('review_answer_timestamp')} AS review_answer_ts
        FROM raw_order_reviews AS r
        QUALIFY row_number() OVER (
            PARTITION BY review_id
            ORDER BY review_answer_ts DESC NULLS LAST, order_id NULLS LAST,
                     review_score DESC NULLS LAST) = 1""",
    "stg_customers": """
        SELECT customer_id, customer_unique_id,
               lpad(r.customer_zip_code_prefix, 5, '0') AS customer_zip_code_prefix,
               lower(trim(r.customer_city)) AS customer_city,
               upper(trim(r.customer_state)) AS customer_state
        FROM raw_customers AS r
        QUALIFY row_number() OVER (
            PARTITION BY customer_id
            ORDER BY customer_unique_id NULLS LAST, lpad(r.customer_zip_code_prefix, 5, '0'),
                     upper(trim(r.customer_state)), lower(trim(r.customer_city))) = 1""",
    "stg_sellers": """
        SELECT seller_id, lpad(r.seller_zip_code_prefix, 5, '0') AS seller_zip_code_prefix,
               lower(trim(r.seller_city)) AS seller_city,
               upper(trim(r.seller_state)) AS seller_state
        FROM raw_sellers AS r
        QUALIFY row_number() OVER (
            PARTITION BY seller_id
            ORDER BY lpad(r.seller_zip_code_prefix, 5, '0'), upper(trim(r.seller_state)),
                     lower(trim(r.seller_city))) = 1""",
    "stg_products": """
        SELECT product_id, p.product_category_name AS product_category_name_pt,
               coalesce(t.product_category_name_english, 'unknown') AS product_category_name_en,
               product_name_lenght AS product_name_length,
               product_description_lenght AS product_description_length,
               product_photos_qty, product_weight_g, product_length_cm, product_height_cm,
               product_width_cm
        FROM raw_products AS p LEFT JOIN raw_category_translation AS t
          ON t.product_category_name = p.product_category_name""",
    "stg_geolocation_zip": """
        SELECT lpad(geolocation_zip_code_prefix, 5, '0') AS zip_code_prefix,
               sum(geolocation_lat)::DOUBLE / count(geolocation_lat) AS avg_latitude,
               sum(geolocation_lng)::DOUBLE / count(geolocation_lng) AS avg_longitude,
               mode() WITHIN GROUP (ORDER BY lower(trim(geolocation_city))) AS primary_city,
               mode() WITHIN GROUP (ORDER BY upper(trim(geolocation_state))) AS primary_state
        FROM raw_geolocation GROUP BY ALL""",
    # --- marts ---
    "dim_customers": """
        SELECT c.*, g.avg_latitude AS latitude, g.avg_longitude AS longitude,
               h.first_order_ts, h.last_order_ts, h.total_orders
        FROM stg_customers AS c
        LEFT JOIN (SELECT customer_id, min(order_purchase_ts) AS first_order_ts,
                          max(order_purchase_ts) AS last_order_ts, count(*) AS total_orders
                   FROM stg_orders GROUP BY customer_id) AS h USING (customer_id)
        LEFT JOIN stg_geolocation_zip AS g ON g.zip_code_prefix = c.customer_zip_code_prefix""",
    "dim_sellers": """
        SELECT s.*, g.avg_latitude AS latitude, g.avg_longitude AS longitude
        FROM stg_sellers AS s
        LEFT JOIN stg_geolocation_zip AS g ON g.zip_code_prefix = s.seller_zip_code_prefix""",
    "fact_order_items": """
        SELECT i.order_id, i.order_item_id, o.customer_id, i.product_id, i.seller_id,
               o.order_status, o.order_purchase_ts::DATE AS purchase_date, i.shipping_limit_ts,
               i.price, i.freight_value, i.price + i.freight_value AS gmv
        FROM stg_order_items AS i JOIN stg_orders AS o USING (order_id)""",
    "item_rollup": """
        SELECT order_id, count(*) AS item_count, sum(price) AS item_price_value,
               sum(freight_value) AS item_freight_value, sum(gmv) AS item_gmv
        FROM fact_order_items GROUP BY order_id""",
    "payment_rollup": """
        SELECT order_id, sum(payment_value) AS payment_value_total,
               count(*) AS payment_record_count
        FROM stg_order_payments GROUP BY order_id""",
    "review_rollup": """
        SELECT order_id, avg(review_score) AS avg_review_score, count(*) AS review_count
        FROM stg_order_reviews GROUP BY order_id""",
    "fact_orders": """
        SELECT o.order_id, o.customer_id, c.customer_unique_id, o.order_status,
               o.order_purchase_ts, o.order_approved_ts, o.delivered_carrier_ts,
               o.delivered_customer_ts, o.estimated_delivery_ts,
               item_count, item_price_value, item_freight_value, item_gmv,
               if(earns, item_gmv, 0) AS revenue_eligible_gmv,
               payment_value_total, payment_record_count, avg_review_score, review_count,
               o.delivered_customer_ts::DATE - o.order_purchase_ts::DATE AS delivery_days,
               o.estimated_delivery_ts::DATE - o.order_purchase_ts::DATE
                   AS estimated_delivery_days,
               (o.delivered_customer_ts <= o.estimated_delivery_ts)::INTEGER
                   AS is_on_time_delivery,
               if(o.order_status IN ('canceled', 'unavailable'), 1, 0)
                   AS is_canceled_or_unavailable,
               if(earns, 1, 0) AS is_revenue_eligible_order,
               row_number() OVER (PARTITION BY c.customer_unique_id
                                  ORDER BY o.order_purchase_ts NULLS LAST, o.order_id)
                   AS customer_order_sequence
        FROM (SELECT s.*, i.* EXCLUDE (order_id), p.* EXCLUDE (order_id), r.* EXCLUDE (order_id),
                     coalesce(s.order_status NOT IN ('canceled', 'unavailable')
                              AND i.item_gmv IS NOT NULL, FALSE) AS earns
              FROM stg_orders AS s
              LEFT JOIN item_rollup AS i ON i.order_id = s.order_id
              LEFT JOIN payment_rollup AS p ON p.order_id = s.order_id
              LEFT JOIN review_rollup AS r ON r.order_id = s.order_id) AS o
        LEFT JOIN stg_customers AS c ON c.customer_id = o.customer_id""",
    "dim_dates": """
        SELECT d::DATE AS date_day, year(d) AS year_num, month(d) AS month_num,
               strftime(d, '%Y-%m') AS year_month, day(d) AS day_of_month, week(d) AS week_num,
               dayofweek(d) AS day_of_week_num, dayname(d) AS day_of_week_name,
               if(dayofweek(d) IN (0, 6), 1, 0) AS is_weekend
        FROM (SELECT unnest(generate_series(min(order_purchase_ts)::DATE,
                                            max(order_purchase_ts)::DATE, INTERVAL 1 DAY)) AS d
              FROM stg_orders)""",
    "seller_orders": """
        SELECT i.seller_id, i.order_id, o.order_status, o.order_purchase_ts::DATE AS purchase_date,
               sum(i.price) AS seller_item_revenue, sum(i.freight_value) AS seller_freight_revenue,
               sum(i.gmv) AS seller_gmv, count(*) AS seller_item_count
        FROM fact_order_items AS i JOIN fact_orders AS o USING (order_id) GROUP BY ALL""",
    # --- KPI tables that other statements build on ---
    "delays": """
        SELECT *, CASE WHEN delivery_days IS NULL THEN 'Not Delivered'
                       WHEN late <= 0 THEN 'On time or early'
                       WHEN late <= 3 THEN '1-3 days late'
                       WHEN late <= 7 THEN '4-7 days late'
                       ELSE '8+ days late' END AS delay_bucket
        FROM (SELECT *, delivery_days - estimated_delivery_days AS late FROM fact_orders)""",
    "kpi_delay": """
        SELECT delay_bucket, count(*) AS orders, avg(avg_review_score) AS avg_review_score
        FROM delays GROUP BY delay_bucket""",
    "kpi_category": """
        SELECT coalesce(p.product_category_name_en, 'unknown') AS category,
               count(DISTINCT i.order_id) AS orders, sum(i.gmv)::DOUBLE AS gmv_revenue_eligible,
               sum(i.gmv)::DOUBLE / count(i.gmv) AS avg_item_value_revenue_eligible
        FROM fact_order_items AS i
        JOIN fact_orders AS o ON o.order_id = i.order_id AND o.is_revenue_eligible_order = 1
        LEFT JOIN stg_products AS p ON p.product_id = i.product_id
        GROUP BY category""",
    "kpi_seller": """
        SELECT s.seller_state, v.seller_id, count(DISTINCT v.order_id) AS orders,
               sum(v.seller_gmv)::DOUBLE AS gmv_revenue_eligible,
               sum(v.seller_gmv)::DOUBLE / count(v.seller_gmv) AS avg_order_gmv_revenue_eligible
        FROM seller_orders AS v
        JOIN fact_orders AS o ON o.order_id = v.order_id AND o.is_revenue_eligible_order = 1
        LEFT JOIN stg_sellers AS s ON s.seller_id = v.seller_id
        GROUP BY s.seller_state, v.seller_id""",
    "kpi_state": """
        SELECT c.customer_state, count(DISTINCT o.order_id) AS orders,
               sum(coalesce(o.item_gmv, 0))::DOUBLE AS gmv_all_orders,
               sum(o.revenue_eligible_gmv)::DOUBLE AS gmv_revenue_eligible,
               avg(o.avg_review_score) AS avg_review_score, avg(o.delivery_days) AS avg_delivery_days
        FROM fact_orders AS o LEFT JOIN dim_customers AS c USING (customer_id)
        GROUP BY c.customer_state""",
    "kpi_payment": """
        SELECT payment_type, count(*) AS payment_records, sum(payment_value)::DOUBLE AS payment_value,
               sum(payment_value)::DOUBLE / count(payment_value) AS avg_payment_value
        FROM stg_order_payments GROUP BY payment_type""",
    "eligible_seller_gmv": """
        SELECT i.seller_id, sum(i.gmv) AS gmv
        FROM fact_order_items AS i JOIN fact_orders AS o USING (order_id)
        WHERE o.is_revenue_eligible_order = 1 GROUP BY i.seller_id""",
    "ranked_sellers": """
        SELECT gmv, row_number() OVER (ORDER BY gmv DESC, seller_id) AS place
        FROM eligible_seller_gmv""",
    "kpi_concentration": """
        SELECT sum(gmv)::DOUBLE AS total_gmv_revenue_eligible,
               sum(gmv) FILTER (place <= 5)::DOUBLE AS top_5_seller_gmv,
               sum(gmv) FILTER (place <= 10)::DOUBLE AS top_10_seller_gmv,
               sum(gmv) FILTER (place <= 50)::DOUBLE AS top_50_seller_gmv,
               top_5_seller_gmv / total_gmv_revenue_eligible AS top_5_share,
               top_10_seller_gmv / total_gmv_revenue_eligible AS top_10_share,
               top_50_seller_gmv / total_gmv_revenue_eligible AS top_50_share
        FROM ranked_sellers""",
    "naive_join": """
        SELECT sum(i.price + i.freight_value) AS naive
        FROM stg_order_items AS i JOIN stg_order_payments AS p USING (order_id)""",
    "join_risk": """
        SELECT any_value(naive)::DOUBLE AS naive_gmv,
               sum(item_gmv)::DOUBLE AS trusted_gmv_all_orders,
               sum(revenue_eligible_gmv)::DOUBLE AS trusted_gmv_revenue_eligible,
               (any_value(naive) - sum(item_gmv))::DOUBLE AS gmv_overstatement_vs_all_orders
        FROM fact_orders CROSS JOIN naive_join""",
    "dq": """
        SELECT unnest(['orders_missing_purchase_timestamp', 'orders_missing_customer_id',
                       'orders_missing_delivered_customer_date_for_delivered_status',
                       'orders_with_estimated_delivery_before_purchase']) AS check_name,
               unnest([count(*) FILTER (order_purchase_ts IS NULL),
                       count(*) FILTER (customer_id IS NULL),
                       count(*) FILTER (order_status = 'delivered'
                                        AND delivered_customer_ts IS NULL),
                       count(*) FILTER (estimated_delivery_ts < order_purchase_ts)]) AS issue_rows
        FROM stg_orders
        UNION ALL BY NAME
        SELECT 'duplicate_order_ids_raw' AS check_name,
               count(*) - count(DISTINCT order_id) AS issue_rows FROM raw_orders
        UNION ALL BY NAME
        SELECT 'duplicate_order_item_keys_raw' AS check_name,
               count(*) - count(DISTINCT (order_id, order_item_id)) AS issue_rows
        FROM raw_order_items
        UNION ALL BY NAME
        SELECT 'duplicate_geolocation_zip_prefix_raw' AS check_name,
               count(*) - count(DISTINCT lpad(geolocation_zip_code_prefix, 5, '0')) AS issue_rows
        FROM raw_geolocation""",
    "cohorts": """
        SELECT *, date_trunc('month', order_purchase_ts)::DATE AS order_month,
               date_trunc('month', min(order_purchase_ts)
                          OVER (PARTITION BY customer_unique_id))::DATE AS cohort_month
        FROM fact_orders WHERE customer_unique_id IS NOT NULL""",
    "retention": """
        SELECT a.cohort_month, a.order_month,
               (year(a.order_month) * 12 + month(a.order_month)
                - year(a.cohort_month) * 12 - month(a.cohort_month))::BIGINT AS month_number,
               any_value(b.cohort_size) AS cohort_size,
               count(DISTINCT a.customer_unique_id) AS active_customers,
               count(DISTINCT a.customer_unique_id)::DOUBLE / any_value(b.cohort_size)
                   AS retention_rate
        FROM cohorts AS a
        JOIN (SELECT cohort_month, count(DISTINCT customer_unique_id) AS cohort_size
              FROM cohorts GROUP BY cohort_month) AS b ON b.cohort_month = a.cohort_month
        GROUP BY a.cohort_month, a.order_month""",
    "daily": """
        SELECT date_day, count(o.order_purchase_ts) AS n
        FROM dim_dates LEFT JOIN stg_orders AS o ON o.order_purchase_ts::DATE = date_day
        GROUP BY date_day""",
}


def order_kpis_sql(on_time: str) -> str:
    return f"""count(*) AS total_orders,
        count(*) FILTER (is_revenue_eligible_order = 1) AS revenue_eligible_orders,
        sum(coalesce(item_gmv, 0))::DOUBLE AS gmv_all_orders,
        sum(revenue_eligible_gmv)::DOUBLE AS gmv_revenue_eligible,
        sum(revenue_eligible_gmv)::DOUBLE
            / nullif(count(*) FILTER (is_revenue_eligible_order = 1), 0) AS aov_revenue_eligible,
        avg(is_canceled_or_unavailable) AS cancellation_rate,
        avg(avg_review_score) AS avg_review_score, avg(delivery_days) AS avg_delivery_days,
        avg(is_on_time_delivery) AS {on_time}"""


CTES["kpi_headline"] = f"SELECT {order_kpis_sql('on_time_rate')} FROM fact_orders"
for _unit in ("month", "week"):
    CTES[f"kpi_{_unit}ly"] = f"""
        SELECT date_trunc('{_unit}', order_purchase_ts)::DATE AS {_unit}_start,
        {order_kpis_sql('on_time_delivery_rate')}
        FROM fact_orders GROUP BY {_unit}_start"""


def _contract_rows() -> str:
    """Observed number and verdict of every contract; names and texts come from the contracts."""
    from trustmart.operators.contracts import CONTRACTS

    eligible = "is_revenue_eligible_order = 1"
    total = "SELECT sum({0}) FROM {1}"
    known = "(is_on_time_delivery IS NOT NULL)::INTEGER"
    observed = {
        "order_key_excess": (
            "SELECT count(*) - count(DISTINCT order_id) FROM fact_orders",
            "v = 0",
        ),
        "item_key_excess": (
            "SELECT count(*) - count(DISTINCT (order_id, order_item_id)) FROM fact_order_items",
            "v = 0",
        ),
        "orders_without_customer": (
            "SELECT count(*) FROM fact_orders AS f WHERE NOT EXISTS (SELECT 1 FROM dim_customers"
            " AS c WHERE c.customer_id = f.customer_id)",
            "v = 0",
        ),
        "items_without_product": (
            "SELECT count(*) FROM fact_order_items AS f WHERE NOT EXISTS (SELECT 1 FROM"
            " stg_products AS p WHERE p.product_id = f.product_id)",
            "v = 0",
        ),
        "gmv_gap_all": (
            f"SELECT ({total.format('gmv', 'fact_order_items')})"
            f" - ({total.format('item_gmv', 'fact_orders')})",
            "abs(v) < 0.01",
        ),
        "gmv_gap_eligible": (
            "SELECT (SELECT sum(gmv) FROM eligible_seller_gmv)"
            f" - ({total.format('revenue_eligible_gmv', 'fact_orders')})",
            "abs(v) < 0.01",
        ),
        "eligible_orders": (f"SELECT count(*) FROM fact_orders WHERE {eligible}", "v > 0"),
        "excluded_revenue": (
            "SELECT coalesce(sum(revenue_eligible_gmv), 0) FROM fact_orders"
            " WHERE order_status IN ('canceled', 'unavailable')",
            "abs(v) < 0.01",
        ),
        "delivered_coverage": (
            f"SELECT avg({known}) FROM fact_orders WHERE order_status = 'delivered'",
            "v >= 0.995",
        ),
        "headline_aov_gap": (
            "SELECT aov_revenue_eligible - gmv_revenue_eligible / revenue_eligible_orders"
            " FROM kpi_headline",
            "abs(v) < 0.000001",
        ),
        "monthly_gmv_gap": (
            "SELECT (SELECT sum(gmv_revenue_eligible::DECIMAL(28,4))::DOUBLE FROM kpi_monthly)"
            " - (SELECT gmv_revenue_eligible FROM kpi_headline)",
            "abs(v) < 0.01",
        ),
        "monthly_orders_gap": (
            "SELECT (SELECT sum(revenue_eligible_orders) FROM kpi_monthly)"
            " - (SELECT revenue_eligible_orders FROM kpi_headline)",
            "abs(v) < 0.01",
        ),
        "monthly_aov_gap": (
            "SELECT (SELECT aov_revenue_eligible FROM kpi_headline) - (SELECT"
            " sum(gmv_revenue_eligible::DECIMAL(28,4))::DOUBLE / sum(revenue_eligible_orders)"
            " FROM kpi_monthly)",
            "abs(v) < 0.000001",
        ),
        "cancellation_rate": (
            "SELECT avg(is_canceled_or_unavailable) FROM fact_orders",
            "v BETWEEN 0 AND 0.2",
        ),
        "on_time_coverage": (f"SELECT avg({known}) FROM fact_orders", "v >= 0.9"),
        "review_gap": (
            "SELECT avg(avg_review_score) FILTER (is_on_time_delivery = 1)"
            " - avg(avg_review_score) FILTER (is_on_time_delivery = 0) FROM fact_orders",
            "v > 0",
        ),
        "payment_ratio": (
            "SELECT sum(payment_value_total)::DOUBLE / nullif(sum(item_gmv)::DOUBLE, 0)"
            " FROM fact_orders",
            "v BETWEEN 0.9 AND 1.15",
        ),
    }

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    rows = []
    for c in CONTRACTS:
        query, rule = observed[c.observed]
        rows.append(
            f"SELECT {quoted(c.name)} AS test_name, {quoted(c.severity)} AS severity,"
            f" if({rule}, 'PASS', 'FAIL') AS status, v AS observed_value,"
            f" {quoted(c.threshold)} AS threshold, {quoted(c.rationale)} AS rationale"
            f" FROM (SELECT ({query})::DOUBLE AS v)"
        )
    return "\nUNION ALL\n".join(rows)


CTES["contract_results"] = _contract_rows()


def statement(tail: str, given: Collection[str] = ()) -> str:
    """``tail`` with the common table expressions it uses, directly or through others.

    ``given`` names expressions that exist as tables already and are left out.
    """
    ctes = {name: sql for name, sql in CTES.items() if name not in given}
    needed: set[str] = set()
    pending = [tail]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & ctes.keys() - needed:
            needed.add(name)
            pending.append(ctes[name])
    # A table expression may only use the ones before it.
    order: list[str] = []

    def place(name: str) -> None:
        if name in order:
            return
        for other in re.findall(r"\w+", ctes[name]):
            if other in ctes and other != name:
                place(other)
        order.append(name)

    for name in ctes:
        if name in needed:
            place(name)
    if not order:
        return tail
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in order) + "\n" + tail
