"""Data behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustmart.functions.metrics import DELAY_BUCKETS, bucket_rank
from trustmart.operators.ranking import share, top_n


def trend(kpi_monthly: DataFrame, min_orders: int = 100) -> DataFrame:
    """Months with more than ``min_orders`` orders; thin first and last months drop out."""
    return kpi_monthly.filter(F.col("total_orders") > min_orders)


def delay_spine(kpi_delay: DataFrame) -> DataFrame:
    """All five delay buckets in order, NULL figures where a bucket has no orders."""
    spine = kpi_delay.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(b) for b in DELAY_BUCKETS])).alias("__bucket")
    )
    return spine.join(kpi_delay, F.col("__bucket") == F.col("delay_bucket"), "left").select(
        F.col("__bucket").alias("delay_bucket"),
        bucket_rank("__bucket").cast("bigint").alias("bucket_order"),
        "orders",
        "avg_review_score",
    )


def top_states_by_orders(kpi_state: DataFrame, n: int = 10) -> DataFrame:
    return top_n(kpi_state, "orders", n, "customer_state")


def top_states_by_gmv(kpi_state: DataFrame, n: int = 10) -> DataFrame:
    return top_n(kpi_state, "gmv_revenue_eligible", n, "customer_state")


def top_categories(kpi_category: DataFrame, n: int = 12) -> DataFrame:
    return top_n(kpi_category, "gmv_revenue_eligible", n, "category")


def top_sellers(kpi_seller: DataFrame, n: int = 12) -> DataFrame:
    return top_n(kpi_seller, "gmv_revenue_eligible", n, "seller_id")


def payment_share(kpi_payment: DataFrame) -> DataFrame:
    # Exact total, so that shares do not depend on the order payment types are added up in.
    exact = kpi_payment.withColumn("__value", F.col("payment_value").cast("decimal(30,6)"))
    return share(exact, "__value", "value_share").drop("__value")


def sort_findings(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.col("issue_rows").desc(), F.col("check_name"))


def pages(kpi: Callable[[str], DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """The data of every page element by name, from the published KPI tables that ``kpi`` reads."""
    return {
        "page1_cards": lambda: kpi_cards(kpi("kpi_headline")),
        "page1_trend": lambda: trend(kpi("kpi_monthly")),
        "page2_delay_spine": lambda: delay_spine(kpi("kpi_delay_vs_reviews")),
        "page2_top_states_by_orders": lambda: top_states_by_orders(kpi("kpi_state_performance")),
        "page3_top_categories": lambda: top_categories(kpi("kpi_category_performance")),
        "page3_top_sellers": lambda: top_sellers(kpi("kpi_seller_performance")),
        "page3_top_states_by_gmv": lambda: top_states_by_gmv(kpi("kpi_state_performance")),
        "page3_payment_share": lambda: payment_share(kpi("kpi_payment_mix")),
        "page4_findings": lambda: sort_findings(kpi("data_quality_summary")),
        "page4_join_risk": lambda: join_risk_panel(kpi("kpi_join_risk_demo")),
    }


def kpi_cards(headline: DataFrame) -> DataFrame:
    """The four headline cards as display text."""
    # Published titles and subtitles.
    millions = F.format_string("R$%.2fM", F.col("gmv_revenue_eligible") / 1_000_000)
    cards = [
        ("Primary GMV", millions, "Revenue-eligible orders only"),
        ("Orders", F.format_string("%,d", F.col("total_orders")), "All order statuses"),
        (
            "Primary AOV",
            F.format_string("R$%.2f", F.col("aov_revenue_eligible")),
            "Revenue-eligible GMV / eligible orders",
        ),
        (
            "Cancellation Rate",
            F.format_string("%.1f%%", F.col("cancellation_rate") * 100),
            "Canceled + unavailable",
        ),
    ]
    return headline.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(title).alias("title"), value.alias("value"), F.lit(sub).alias("subtitle")
                    )
                    for title, value, sub in cards
                ]
            )
        )
    )


def join_risk_panel(join_risk: DataFrame) -> DataFrame:
    """The reliability notes of the data-quality page as display text."""
    # Published labels.
    notes = [
        ("Naive join GMV", "naive_gmv"),
        ("Trusted GMV (all orders)", "trusted_gmv_all_orders"),
        ("Overstatement risk", "gmv_overstatement_vs_all_orders"),
    ]
    return join_risk.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("label"),
                        F.format_string("R$%,.0f", F.col(column)).alias("value"),
                    )
                    for label, column in notes
                ]
            )
        )
    )
