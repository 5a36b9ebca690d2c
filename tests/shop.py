"""A hand-written shop: raw tables small enough to check by eye."""

from __future__ import annotations

from trustmart.plans.model import Model
from trustmart.sources.raw import RAW_COLUMNS

CUSTOMERS = [
    ("c1", "u1", "1", " Rio ", "rj"),
    ("c2", "u1", "1", "rio", "rj"),
    ("c3", "u2", "2", "sampa", "sp"),
    ("c4", None, "2", "sampa", "sp"),
    ("c9", "u9", "9", "nowhere", "zz"),
]
# order, customer, status, purchase, delivered, estimated
ORDERS = [
    # On time by date, late by timestamp: delivered at 09:00 on the estimated day.
    ("o1", "c1", "delivered", "2017-11-05 10:00:00", "2017-11-10 09:00:00", "2017-11-10 00:00:00"),
    # Same person, over the year's end.
    ("o2", "c2", "delivered", "2018-01-03 10:00:00", "2018-01-05 08:00:00", "2018-01-20 00:00:00"),
    ("o3", "c3", " CANCELED ", "2017-11-06 10:00:00", None, "2017-11-20 00:00:00"),
    # No items at all.
    ("o4", "c3", "shipped", "2017-12-01 00:00:00", None, "2017-12-24 00:00:00"),
    # Unknown status, with items.
    ("o5", "c4", None, "2017-11-30 23:59:59", None, None),
    # Delivered without an estimate.
    ("o6", "c4", "delivered", "2017-12-31 12:00:00", "2018-01-01 01:00:00", None),
]
ITEMS = [
    ("o1", "1", "p1", "s1", "2017-11-06 00:00:00", "10.00", "1.50"),
    ("o1", "2", "p2", "s2", "2017-11-06 00:00:00", "20.00", "2.50"),
    ("o2", "1", "p1", "s1", "2018-01-04 00:00:00", "5.25", "0.25"),
    ("o3", "1", "p3", "s3", "2017-11-07 00:00:00", "100.00", "0"),
    ("o5", "1", "p1", "s1", "2017-12-01 00:00:00", "7.00", "0"),
    ("o6", "1", "p2", "s3", "2018-01-01 00:00:00", "40.00", "4.00"),
    # No such order.
    ("o-lost", "1", "p1", "s1", "2017-11-06 00:00:00", "999.00", "0"),
]
PAYMENTS = [
    ("o1", "1", "credit_card", "1", "10.00"),
    ("o1", "2", " Voucher", "1", "14.00"),
    ("o1", "3", "voucher", "1", "10.00"),
    ("o2", "1", "boleto", "1", "5.50"),
    ("o3", "1", "boleto", "1", "100.00"),
    ("o6", "1", "boleto", "2", "44.00"),
]
REVIEWS = [
    ("r1", "o1", "2", None, "late", "2017-11-11 00:00:00", "2017-11-12 00:00:00"),
    ("r2", "o1", "5", "ok", " ", "2017-11-11 00:00:00", "2017-11-12 00:00:00"),
    ("r3", "o2", "5", None, None, "2018-01-06 00:00:00", "2018-01-07 00:00:00"),
    ("r4", "o3", "1", None, None, "2017-11-21 00:00:00", "2017-11-22 00:00:00"),
]
PRODUCTS = [
    ("p1", "casa", "4", "10", "1", "100", "2", "3", "4"),
    ("p2", "livro", "5", "10", "1", "100", "2", "3", None),
    ("p3", None, None, None, None, None, None, None, None),
]
SELLERS = [
    ("s1", "1", "rio", "rj"),
    ("s2", "2", "sampa", "sp"),
    ("s3", "2", "sampa", "sp"),
]
GEO = [
    ("1", "-22.5", "-43.5", "rio", "rj"),
    ("1", "-23.5", "-42.5", "rio", "rj"),
    ("2", "-23.0", "-46.0", "sampa", "sp"),
]
TRANSLATION = [("casa", "home")]


def raw_tables(spark, **replaced):
    """Raw frames by name; keyword arguments replace the rows of a table."""
    rows = {
        "customers": CUSTOMERS,
        "orders": [(o, c, s, p, None, None, d, e) for o, c, s, p, d, e in ORDERS],
        "order_items": ITEMS,
        "order_payments": PAYMENTS,
        "order_reviews": REVIEWS,
        "products": PRODUCTS,
        "sellers": SELLERS,
        "geolocation": GEO,
        "category_translation": TRANSLATION,
    }
    if "orders" in replaced:
        replaced["orders"] = [(o, c, s, p, None, None, d, e) for o, c, s, p, d, e in replaced["orders"]]
    rows.update(replaced)
    return {
        name: spark.createDataFrame(
            rows[name], ", ".join(f"{column} string" for column in columns)
        )
        for name, columns in RAW_COLUMNS.items()
    }


def shop(spark, **replaced) -> Model:
    return Model(raw_tables(spark, **replaced).__getitem__)
