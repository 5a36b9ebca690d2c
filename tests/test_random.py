"""Random shops full of NULLs, copies and missing parents: Spark plans against their SQL."""

from __future__ import annotations

import random

import duckdb
import pytest

from tests import oracle_check
from trustmart.plans import oracle, registry
from trustmart.plans.model import Model
from trustmart.sources.raw import RAW_COLUMNS

QUERIES = (
    "stage_orders",
    "stage_order_items",
    "stage_order_payments",
    "stage_order_reviews",
    "stage_customers",
    "stage_sellers",
    "stage_geolocation_zip",
    "dim_customers",
    "dim_dates",
    "fact_order_items",
    "fact_orders",
    "order_seller_performance",
    "kpi_headline",
    "kpi_monthly",
    "kpi_weekly",
    "kpi_active_customers",
    "kpi_cohort_retention",
    "kpi_seller_risk_default",
    "kpi_delay_vs_reviews",
    "kpi_category",
    "kpi_seller",
    "kpi_state",
    "kpi_payment_mix",
    "kpi_seller_concentration",
    "join_risk_demo",
    "data_quality_summary",
    "contract_results",
    "model_row_counts",
    "volume_anomaly",
    "weekly_watch",
    "category_reviews",
    "repeat_customer_rate",
)

TYPES = {
    "order_item_id": "INTEGER",
    "price": "DECIMAL(14,2)",
    "freight_value": "DECIMAL(14,2)",
    "payment_sequential": "INTEGER",
    "payment_installments": "INTEGER",
    "payment_value": "DECIMAL(14,2)",
    "review_score": "INTEGER",
    "geolocation_lat": "DECIMAL(9,4)",
    "geolocation_lng": "DECIMAL(9,4)",
    "product_name_lenght": "INTEGER",
    "product_description_lenght": "INTEGER",
    "product_photos_qty": "INTEGER",
    "product_weight_g": "DOUBLE",
    "product_length_cm": "DOUBLE",
    "product_height_cm": "DOUBLE",
    "product_width_cm": "DOUBLE",
}


def random_rows(seed: int) -> dict[str, list[tuple]]:
    rnd = random.Random(seed)

    def maybe(value, missing=0.08):
        return None if rnd.random() < missing else value

    def an_id(kind: str, n: int, missing=0.03):
        # Low numbers are far more frequent than high ones.
        return maybe(f"{kind}{int(n * rnd.random() ** 3)}", missing)

    def ts(missing=0.1):
        if rnd.random() < 0.04:
            return rnd.choice(["", "2017-13-01 00:00:00", "2017-01-01", "soon"])
        day = f"2017-{rnd.randint(1, 5):02d}-{rnd.randint(1, 28):02d}"
        return maybe(f"{day} {rnd.randint(0, 23):02d}:00:{rnd.randint(0, 59):02d}", missing)

    def money():
        return maybe(f"{rnd.randint(0, 99999) / 100:.2f}")

    status = ["delivered", " Delivered", "CANCELED ", "unavailable", "shipped"]
    city = ["rio", " Rio", "sampa", "", "niteroi"]
    state = ["rj", "SP ", " mg"]

    def zipped():
        return maybe(str(rnd.choice([1, 22, 333, 44444, 555555])))

    return {
        "orders": [
            (an_id("o", 300), an_id("c", 90), maybe(rnd.choice(status)), *(ts() for _ in range(5)))
            for _ in range(500)
        ],
        "order_items": [
            (an_id("o", 330), str(rnd.randint(1, 3)), an_id("p", 40), an_id("s", 12), ts(), money(), money())
            for _ in range(900)
        ],
        "order_payments": [
            (
                an_id("o", 330),
                str(rnd.randint(1, 3)),
                maybe(rnd.choice(["boleto", " Boleto", "voucher"])),
                maybe(str(rnd.randint(1, 9))),
                money(),
            )
            for _ in range(700)
        ],
        "order_reviews": [
            (an_id("r", 300), an_id("o", 330), maybe(str(rnd.randint(1, 5))), maybe(" "), maybe("x"), ts(), ts())
            for _ in range(400)
        ],
        "customers": [
            (an_id("c", 80), an_id("u", 50, 0.15), zipped(), maybe(rnd.choice(city)), maybe(rnd.choice(state)))
            for _ in range(160)
        ],
        "products": [
            (f"p{i}", maybe(rnd.choice(["casa", "livro", "som"])), *(["3"] * 7)) for i in range(35)
        ],
        "sellers": [
            (an_id("s", 10), zipped(), maybe(rnd.choice(city)), maybe(rnd.choice(state)))
            for _ in range(30)
        ],
        "geolocation": [
            (
                zipped(),
                maybe(f"{rnd.randint(-300000, 0) / 10000:.4f}"),
                maybe(f"{rnd.randint(-600000, 0) / 10000:.4f}"),
                maybe(rnd.choice(city)),
                maybe(rnd.choice(state)),
            )
            for _ in range(300)
        ],
        "category_translation": [("casa", "home"), ("livro", "book")],
    }


@pytest.fixture(scope="module", params=[1, 2])
def shops(request, spark):
    rows = random_rows(request.param)
    con = duckdb.connect()
    frames = {}
    for table, columns in RAW_COLUMNS.items():
        frames[table] = spark.createDataFrame(
            rows[table], ", ".join(f"{c} string" for c in columns)
        ).repartition(5)
        con.execute(
            f"CREATE TABLE raw_{table} ("
            + ", ".join(f"{c} {TYPES.get(c, 'VARCHAR')}" for c in columns)
            + ")"
        )
        con.executemany(
            f"INSERT INTO raw_{table} VALUES ({', '.join('?' * len(columns))})", rows[table]
        )
    return Model(frames.__getitem__), con


@pytest.mark.parametrize("name", QUERIES)
def test_random_shop(spark, shops, name):
    model, con = shops
    sql = oracle.statement(registry.ORACLES[name], {f"raw_{t}" for t in RAW_COLUMNS})
    same, _, note = oracle_check.compare(
        spark, con, "", lambda *_: registry.QUERIES[name](model), sql
    )
    assert same, note
