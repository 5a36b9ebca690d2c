from datetime import datetime
from decimal import Decimal

import pytest

from tests.rows import bag, by, frame
from trustmart.operators import staging

ORDER = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string,"
    " order_approved_at string, order_delivered_carrier_date string,"
    " order_delivered_customer_date string, order_estimated_delivery_date string"
)
T1, T2 = "2020-01-01 10:00:00", "2020-01-02 10:00:00"


def order(order_id, customer="c", status="delivered", bought=T1, delivered=None, estimated=None):
    return (order_id, customer, status, bought, None, None, delivered, estimated)


def test_latest_purchase_wins_and_null_purchase_loses(spark):
    raw = frame(
        spark,
        ORDER,
        order("a", "c1", bought=None),
        order("a", "c2", bought=T1),
        order("a", "c3", bought=T2),
        order("b", "c4", bought=None),
    )
    rows = by(staging.stage_orders(raw), "order_id")
    assert rows["a"].customer_id == "c3"
    assert rows["b"].customer_id == "c4"


def test_order_ties_put_null_customer_last(spark):
    raw = frame(spark, ORDER, order("a", None), order("a", "z"), order("a", "m", " SHIPPED "))
    row = staging.stage_orders(raw).first()
    assert (row.customer_id, row.order_status) == ("m", "shipped")


def test_customer_ties_put_null_unique_id_last(spark):
    raw = frame(
        spark,
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string,"
        " customer_city string, customer_state string",
        ("c", None, "1", " Rio ", "rj"),
        ("c", "u", "2", " Campinas", "sp "),
    )
    assert bag(staging.stage_customers(raw)) == [("c", "u", "00002", "campinas", "SP")]


ITEM = (
    "order_id string, order_item_id string, product_id string, seller_id string,"
    " shipping_limit_date string, price string, freight_value string"
)


def test_item_winner(spark):
    raw = frame(
        spark,
        ITEM,
        ("a", "1", "p2", "s1", T1, "5.00", "1.00"),
        ("a", "1", "p1", "s1", T1, "5.00", "1.00"),
        ("a", "1", "p1", "s1", T1, "7.50", "0.10"),
        ("a", "1", "p1", "s1", T1, "7.50", "0.20"),
        ("a", "1", "p0", "s0", None, "9.00", "1.00"),
        ("a", "2", "p", "s", T2, None, None),
    )
    rows = by(staging.stage_order_items(raw), "order_item_id")
    assert (rows[1].product_id, rows[1].price, rows[1].freight_value) == (
        "p1",
        Decimal("7.5000"),
        Decimal("0.2000"),
    )
    assert rows[2].price is None


def test_bad_price_fails(spark):
    raw = frame(spark, ITEM, ("a", "1", "p", "s", T1, "five", "1"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_order_items(raw).collect()


def test_payment_winner_is_dearest_then_type_then_most_instalments(spark):
    raw = frame(
        spark,
        "order_id string, payment_sequential string, payment_type string,"
        " payment_installments string, payment_value string",
        ("a", "1", "voucher", "1", "10"),
        ("a", "1", " Boleto", "1", "10"),
        ("a", "1", "boleto", "3", "10"),
        ("a", "1", "boleto", "9", None),
    )
    assert bag(staging.stage_order_payments(raw)) == [("a", 1, "boleto", 3, Decimal("10.0000"))]


def test_reviews_are_keyed_on_review_id_alone(spark):
    raw = frame(
        spark,
        "review_id string, order_id string, review_score string, review_comment_title string,"
        " review_comment_message string, review_creation_date string,"
        " review_answer_timestamp string",
        ("r", "o1", "5", " ", "ok\nfine", T1, T1),
        ("r", "o2", "1", "bad", "", T1, T2),
    )
    (row,) = staging.stage_order_reviews(raw).collect()
    assert (row.order_id, row.review_score, row.review_comment_message) == ("o2", 1, None)
    assert row.review_answer_ts == datetime(2020, 1, 2, 10)


def test_duplicate_translation_fans_products_out(spark):
    products = frame(
        spark,
        "product_id string, product_category_name string, product_name_lenght string,"
        " product_description_lenght string, product_photos_qty string, product_weight_g string,"
        " product_length_cm string, product_height_cm string, product_width_cm string",
        ("p1", "casa", "1", "2", "3", "4", "5", "6", "7"),
        ("p2", None, None, None, None, None, None, None, None),
    )
    translation = frame(
        spark,
        "product_category_name string, product_category_name_english string",
        ("casa", "home"),
        ("casa", "house"),
    )
    rows = bag(
        staging.stage_products(products, translation).select(
            "product_id", "product_category_name_en"
        )
    )
    assert rows == [("p1", "home"), ("p1", "house"), ("p2", "unknown")]


def test_geolocation_modes_break_ties_by_name_and_skip_null(spark):
    raw = frame(
        spark,
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string,"
        " geolocation_city string, geolocation_state string",
        ("1", "1.0", "-1.0", "b", "sp"),
        ("1", "2.0", "-2.0", " B", "sp"),
        ("00001", "3.0", None, "a", "rj"),
        ("00001", "4.0", "-4.5", "A ", None),
        ("2", None, None, None, None),
    )
    rows = by(staging.stage_geolocation_zip(raw), "zip_code_prefix")
    assert tuple(rows["00001"]) == ("00001", 2.5, -2.5, "a", "SP")
    assert tuple(rows["00002"]) == ("00002", None, None, None, None)


def test_staging_is_idempotent(spark, small_model):
    once = small_model.stg_order_items
    again = staging.stage_order_items(
        once.withColumnRenamed("shipping_limit_ts", "shipping_limit_date")
    )
    assert bag(again) == bag(once)


def test_staging_does_not_depend_on_row_order(spark, small_model):
    raw = small_model.raw("order_items")
    assert bag(staging.stage_order_items(raw.repartition(7, "price"))) == bag(
        small_model.stg_order_items
    )


def test_payment_values_are_those_of_the_rows_that_win(spark):
    raw = frame(
        spark,
        "order_id string, payment_sequential string, payment_type string, payment_installments string, payment_value string",
        ("a", "1", "card", "1", "9.5"), ("a", "1", "boleto", "3", "10.0"), ("a", "1", "card", "2", "10.0"), ("a", "1", "card", "2", None),
        ("a", "2", "card", "2", None), ("a", "2", "boleto", "1", None), ("a", None, "card", "1", "1.0"), (None, "1", "card", "1", "-3.0"),
    )
    winners = staging.stage_order_payments(raw).select("order_id", "payment_sequential", "payment_value")
    values = staging.payment_values(raw)
    assert values.schema == winners.schema and bag(values) == bag(winners)
    assert bag(staging.payment_values(raw, deal=lambda df: df.repartition(3, "order_id"))) == bag(winners)
