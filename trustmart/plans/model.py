"""The layered model: raw tables in, staging, marts, KPIs and checks out."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustmart.operators import contracts, cube, kpis, marts, quality, staging
from trustmart.sources.layers import MARTS, STAGING, overfull, written

Keep = Callable[[str, str, DataFrame], DataFrame]
#: Lines of one order, all of which one task holds, that item facts are still dealt by order for.
MOST_LINES = 5_000_000


def _table(layer: str):
    """A model table: built once, and passed through the model's storage if it has one."""

    def wrap(build: Callable[[Model], DataFrame]) -> cached_property:
        def get(self: Model) -> DataFrame:
            df = build(self)
            return self.keep(layer, build.__name__, df) if self.keep else df

        return cached_property(get)

    return wrap


# Tables in building order; those of one wave do not need each other.
WAVES = (
    (
        "stg_orders",
        "stg_order_items",
        "stg_order_payments",
        "stg_order_reviews",
        "stg_customers",
        "stg_products",
        "stg_sellers",
        "stg_geolocation_zip",
    ),
    ("dim_geography", "dim_products", "dim_dates", "fact_order_items", "order_keys"),
    ("dim_customers", "dim_sellers", "fact_orders"),
    ("daily_cube",),
)


class Model:
    """All tables over one set of raw tables.

    Without ``keep`` every table is a lazy plan and a query computes just what it reads. With
    ``keep`` (a function that stores a table and returns the stored one) each staging and mart
    table is written once and later tables read it back, which also cuts the lineage.

    With ``deal`` (a function that deals rows by order id) orders, items and payments are dealt before
    their duplicates go, so that each is shuffled once for de-duplication, roll-ups and joins by order.
    """

    def __init__(
        self, raw: Callable[[str], DataFrame], keep: Keep | None = None, deal: staging.Deal | None = None
    ):
        self.raw = raw
        self.keep = keep
        self.deal = deal

    def dealt_by_order(self, deal: staging.Deal, parts: int, most_lines: int = MOST_LINES) -> Model:
        """A lazy model over the same raw tables whose rows are dealt by order; this model itself where
        an order has so many rows, or copies of rows, that the fullest of ``parts`` tasks would hold more
        than ``most_lines`` above the mean. Order ids are read for that."""
        tables = ("orders", "order_items", "order_payments")
        if overfull([self.raw(name) for name in tables], "order_id", parts) > most_lines:
            return self
        return Model(self.raw, deal=deal)

    # --- staging ---

    @_table(STAGING)
    def stg_orders(self):
        return staging.stage_orders(self.raw("orders"), deal=self.deal)

    @_table(STAGING)
    def stg_order_items(self):
        return staging.stage_order_items(self.raw("order_items"), deal=self.deal)

    @_table(STAGING)
    def stg_order_payments(self):
        return staging.stage_order_payments(self.raw("order_payments"))

    @_table(STAGING)
    def stg_order_reviews(self):
        return staging.stage_order_reviews(self.raw("order_reviews"))

    @_table(STAGING)
    def stg_customers(self):
        return staging.stage_customers(self.raw("customers"))

    @_table(STAGING)
    def stg_products(self):
        return staging.stage_products(self.raw("products"), self.raw("category_translation"))

    @_table(STAGING)
    def stg_sellers(self):
        return staging.stage_sellers(self.raw("sellers"))

    @_table(STAGING)
    def stg_geolocation_zip(self):
        return staging.stage_geolocation_zip(self.raw("geolocation"))

    # --- marts ---

    @_table(MARTS)
    def dim_geography(self):
        return marts.dim_geography(self.stg_geolocation_zip)

    @_table(MARTS)
    def dim_customers(self):
        return marts.dim_customers(self.stg_customers, self.stg_orders, self.dim_geography)

    @_table(MARTS)
    def dim_sellers(self):
        return marts.dim_sellers(self.stg_sellers, self.dim_geography)

    @_table(MARTS)
    def dim_products(self):
        return marts.dim_products(self.stg_products)

    @_table(MARTS)
    def dim_dates(self):
        return marts.dim_dates(self.stg_orders)

    @_table(MARTS)
    def fact_order_items(self):
        return marts.fact_order_items(self.stg_order_items, self.stg_orders, self.deal is not None)

    @_table(MARTS)
    def fact_orders(self):
        return marts.fact_orders(self._bare_orders(), self._numbered())

    def _numbered(self) -> DataFrame:
        # A lazy model, too, writes these narrow rows: numbers follow from stored places.
        return marts.number_orders(self.order_keys, lambda df: written(df, "order-places"))

    def _bare_orders(self) -> DataFrame:
        return marts.order_facts(
            self.stg_orders, self.order_lines, self.payment_values, self.stg_order_reviews
        )

    @_table(MARTS)
    def daily_cube(self):
        return cube.daily_cube(self.orders)

    # --- what the KPIs read ---
    # Over stored tables these are the marts themselves. In a lazy model they are the same rows
    # without the parts a KPI cannot need, so that nothing is computed only to be thrown away.

    @cached_property
    def order_lines(self) -> DataFrame:
        """Items with GMV. Lines of unknown orders fall out where they meet the orders."""
        return self.fact_order_items if self.keep else marts.with_item_gmv(self.stg_order_items)

    @cached_property
    def payment_values(self) -> DataFrame:
        """Payments for roll-ups by order; in a lazy model without kind and instalments."""
        if self.keep:
            return self.stg_order_payments
        return staging.payment_values(self.raw("order_payments"), deal=self.deal)

    @cached_property
    def orders(self) -> DataFrame:
        """Order facts; in a lazy model without the person and the order number."""
        return self.fact_orders if self.keep else self._bare_orders()

    @_table(STAGING)
    def order_keys(self):
        """Who ordered when. Numbering hot persons reads this several times, so it is stored."""
        return marts.order_keys(self.stg_orders, self.stg_customers)

    @cached_property
    def orders_of_people(self) -> DataFrame:
        """Orders with their person, for customer KPIs."""
        return self.fact_orders if self.keep else self.order_keys

    @cached_property
    def customers(self) -> DataFrame:
        return self.dim_customers if self.keep else self.stg_customers

    @cached_property
    def sellers(self) -> DataFrame:
        return self.dim_sellers if self.keep else self.stg_sellers

    @cached_property
    def products(self) -> DataFrame:
        return self.dim_products if self.keep else self.stg_products

    # --- KPIs ---

    def order_sequence(self) -> DataFrame:
        """The order number alone."""
        if self.keep:
            return self.fact_orders.select(
                "order_id", "customer_unique_id", "customer_order_sequence"
            )
        return self._numbered()

    def order_seller_performance(self) -> DataFrame:
        return marts.order_seller_performance(self.order_lines, self.orders)

    def headline(self) -> DataFrame:
        return cube.headline(self.daily_cube) if self.keep else kpis.headline(self.orders)

    def _of_periods(self, unit: str) -> DataFrame:
        if self.keep:
            return cube.period_kpis(self.daily_cube, unit)
        return kpis.period_kpis(self.orders, unit)

    def monthly(self) -> DataFrame:
        return self._of_periods("month")

    def weekly(self) -> DataFrame:
        return self._of_periods("week")

    def active_customers(self) -> DataFrame:
        return kpis.active_customers(self.orders_of_people)

    def cohort_retention(self, key: str = "customer_unique_id") -> DataFrame:
        return kpis.cohort_retention(self.orders_of_people, key)

    def seller_risk(self, min_orders: int = 30) -> DataFrame:
        return kpis.seller_risk(self.order_lines, self.orders, self.sellers, min_orders)

    def delay_vs_reviews(self) -> DataFrame:
        if self.keep:
            return cube.delay_vs_reviews(self.daily_cube)
        return kpis.delay_vs_reviews(self.orders)

    def category_performance(self) -> DataFrame:
        return kpis.category_performance(self.order_lines, self.orders, self.products)

    def seller_performance(self) -> DataFrame:
        return kpis.seller_performance(self.order_lines, self.orders, self.sellers)

    def state_performance(self) -> DataFrame:
        return kpis.state_performance(self.orders, self.customers)

    def payment_mix(self) -> DataFrame:
        return kpis.payment_mix(self.stg_order_payments)

    def seller_concentration(self) -> DataFrame:
        return kpis.seller_concentration(self.order_lines, self.orders)

    def join_risk(self) -> DataFrame:
        return kpis.fan_out_audit(self.stg_order_items, self.stg_order_payments, self.orders)

    def data_quality(self) -> DataFrame:
        return quality.data_quality_summary(
            self.stg_orders, self.raw("orders"), self.raw("order_items"), self.raw("geolocation")
        )

    def row_counts(self, exported: Callable[[str], DataFrame] | None = None) -> DataFrame:
        """Rows of every table; ``exported`` reads KPI tables that have been written already."""

        def kpi(name: str, build: Callable[[], DataFrame]) -> DataFrame:
            return exported(name) if exported else build()

        raw = (
            "orders",
            "order_items",
            "order_payments",
            "order_reviews",
            "customers",
            "products",
            "sellers",
            "geolocation",
        )
        return kpis.row_counts(
            {
                **{f"raw.{name}": self.raw(name) for name in raw},
                "marts.fact_orders": self.fact_orders,
                "marts.fact_order_items": self.fact_order_items,
                "marts.dim_customers": self.dim_customers,
                "marts.dim_products": self.dim_products,
                "marts.dim_sellers": self.dim_sellers,
                "marts.dim_dates": self.dim_dates,
                "kpi.seller_concentration": kpi(
                    "kpi_seller_concentration", self.seller_concentration
                ),
                "kpi.weekly_ops": kpi("kpi_weekly_ops", self.weekly),
                "kpi.customer_cohort_retention": kpi(
                    "kpi_customer_cohort_retention", self.cohort_retention
                ),
            }
        )

    def contract_results(
        self,
        headline: DataFrame | None = None,
        monthly: DataFrame | None = None,
        of_orders: DataFrame | None = None,
        of_items: DataFrame | None = None,
    ) -> DataFrame:
        """Contract results; pass the written KPI tables to test what will be published, and the
        metrics that were observed while the facts were written.

        A lazy model tests its facts without person and order number, which no contract looks at.
        """
        orders, items = self.orders, self.fact_order_items
        observations = contracts.observe(
            orders,
            items,
            self.customers,
            self.products,
            headline if headline is not None else self.headline(),
            monthly if monthly is not None else self.monthly(),
            of_orders=of_orders,
            of_items=of_items,
        )
        return contracts.run_contracts(observations)

    def reports(self) -> dict[str, Callable[[], DataFrame]]:
        """Every exported KPI table by its published name."""
        return {
            "kpi_headline": self.headline,
            "kpi_monthly": self.monthly,
            "kpi_weekly_ops": self.weekly,
            "kpi_active_customers_monthly": self.active_customers,
            "kpi_customer_cohort_retention": self.cohort_retention,
            "kpi_seller_operational_risk": self.seller_risk,
            "kpi_delay_vs_reviews": self.delay_vs_reviews,
            "kpi_category_performance": self.category_performance,
            "kpi_seller_performance": self.seller_performance,
            "kpi_state_performance": self.state_performance,
            "kpi_payment_mix": self.payment_mix,
            "kpi_seller_concentration": self.seller_concentration,
            "data_quality_summary": self.data_quality,
            "kpi_join_risk_demo": self.join_risk,
            "model_row_counts": self.row_counts,
        }
