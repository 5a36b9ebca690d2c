"""Data contracts on the built model, and the gate that blocks publication."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustmart.functions.metrics import EXCLUDED_STATUSES, is_excluded, ratio

CRITICAL, WARNING, INFO = "critical", "warning", "info"


@dataclass(frozen=True)
class Contract:
    """A named rule on one observed number. ``observed`` names a column of the observations."""

    observed: str
    name: str
    severity: str
    rule: Callable[[Column], Column]
    threshold: str
    rationale: str


def _is_zero(x: Column) -> Column:
    return x == 0


def _is_positive(x: Column) -> Column:
    return x > 0


def _within(tolerance: float) -> Callable[[Column], Column]:
    return lambda x: F.abs(x) < tolerance


def _at_least(bound: float) -> Callable[[Column], Column]:
    return lambda x: x >= bound


def _between(low: float, high: float) -> Callable[[Column], Column]:
    return lambda x: x.between(low, high)


# Published names, severities, thresholds and rationales, in reporting order.
CONTRACTS: tuple[Contract, ...] = (
    Contract(
        "order_key_excess",
        "Fact Orders has one row per order",
        CRITICAL,
        _is_zero,
        "must equal 0",
        "Order grain must be one row per order_id.",
    ),
    Contract(
        "item_key_excess",
        "Fact Order Items has unique item keys",
        CRITICAL,
        _is_zero,
        "must equal 0",
        "Item grain must be one row per (order_id, order_item_id).",
    ),
    Contract(
        "orders_without_customer",
        "Fact Orders customer foreign key integrity",
        CRITICAL,
        _is_zero,
        "must equal 0",
        "Orders should always map to a customer dimension row.",
    ),
    Contract(
        "items_without_product",
        "Fact Order Items product foreign key integrity",
        CRITICAL,
        _is_zero,
        "must equal 0",
        "Order items should always map to a product dimension row.",
    ),
    Contract(
        "gmv_gap_all",
        "All-orders GMV reconciles between item and order facts",
        CRITICAL,
        _within(0.01),
        "absolute difference < 0.01",
        "Order-level GMV must reconcile to item-level GMV.",
    ),
    Contract(
        "gmv_gap_eligible",
        "Revenue-eligible GMV reconciles across grains",
        CRITICAL,
        _within(0.01),
        "absolute difference < 0.01",
        "Primary revenue KPI must match whether computed from items or orders.",
    ),
    Contract(
        "eligible_orders",
        "Revenue-eligible order count is non-zero",
        CRITICAL,
        _is_positive,
        "> 0",
        "Primary revenue KPIs cannot be published with zero qualifying orders.",
    ),
    Contract(
        "excluded_revenue",
        "Primary revenue excludes canceled and unavailable orders",
        CRITICAL,
        _within(0.01),
        "absolute value < 0.01",
        "Canceled/unavailable orders are operational outcomes and should not inflate commercial "
        "KPIs.",
    ),
    Contract(
        "delivered_coverage",
        "Delivered orders have expected on-time logic coverage",
        WARNING,
        _at_least(0.995),
        ">= 0.995",
        "Delivered orders should almost always have enough timestamp data for on-time "
        "classification.",
    ),
    Contract(
        "headline_aov_gap",
        "Headline AOV matches defined formula",
        CRITICAL,
        _within(1e-6),
        "absolute difference < 0.000001",
        "AOV must equal revenue-eligible GMV divided by revenue-eligible order count.",
    ),
    Contract(
        "monthly_gmv_gap",
        "Monthly primary GMV reconciles to headline primary GMV",
        CRITICAL,
        _within(0.01),
        "absolute difference < 0.01",
        "Roll-up checks prevent hidden leakage between monthly reporting and headline KPIs.",
    ),
    Contract(
        "monthly_orders_gap",
        "Monthly revenue-eligible order count reconciles to headline",
        CRITICAL,
        _within(0.01),
        "absolute difference < 0.01",
        "Primary order volume denominator should align across all executive summary layers.",
    ),
    Contract(
        "monthly_aov_gap",
        "Monthly and headline AOV align under weighted definition",
        WARNING,
        _within(1e-6),
        "absolute difference < 0.000001",
        "Prevents averaging bias from unweighted monthly AOV rollups.",
    ),
    Contract(
        "cancellation_rate",
        "Cancellation rate remains in expected operating band",
        WARNING,
        _between(0.0, 0.2),
        "between 0 and 0.20",
        "A broad sanity check to catch severe status-mapping regressions.",
    ),
    Contract(
        "on_time_coverage",
        "On-time KPI coverage remains healthy",
        WARNING,
        _at_least(0.90),
        ">= 0.90",
        "Most orders should be evaluable for on-time delivery after model logic.",
    ),
    Contract(
        "review_gap",
        "Late deliveries depress review score (directional test)",
        INFO,
        _is_positive,
        "> 0",
        "On-time deliveries should show higher review scores than late deliveries.",
    ),
    Contract(
        "payment_ratio",
        "Payment value to GMV ratio remains plausible",
        WARNING,
        _between(0.90, 1.15),
        "between 0.90 and 1.15",
        "Detects major revenue/payment mismatches after transformations.",
    ),
)


# --- observations ---------------------------------------------------------------------------

def order_metrics(excluded: Sequence[str] = EXCLUDED_STATUSES) -> list[Column]:
    """Everything the contracts need from the order fact but its keys: aggregates of one pass, which
    can be observed while the fact is written."""
    known = F.col("is_on_time_delivery").isNotNull()
    coverage = F.when(known, F.lit(1.0)).otherwise(F.lit(0.0))

    def review_if(flag: int) -> Column:
        return F.avg(F.when(F.col("is_on_time_delivery") == flag, F.col("avg_review_score")))

    canceled = F.when(F.col("is_canceled_or_unavailable") == 1, F.lit(1.0)).otherwise(F.lit(0.0))
    return [
        F.sum("item_gmv").alias("order_gmv"),
        F.sum("revenue_eligible_gmv").alias("order_gmv_eligible"),
        F.count(F.when(F.col("is_revenue_eligible_order") == 1, 1)).alias("eligible_orders"),
        # No excluded order at all means nothing leaked.
        F.coalesce(
            F.sum(
                F.when(is_excluded(excluded=excluded), F.coalesce("revenue_eligible_gmv", F.lit(0)))
            ),
            F.lit(0),
        ).alias("excluded_revenue"),
        F.avg(F.when(F.col("order_status") == "delivered", coverage)).alias("delivered_coverage"),
        F.avg(canceled).alias("cancellation_rate"),
        F.avg(coverage).alias("on_time_coverage"),
        (review_if(1) - review_if(0)).alias("review_gap"),
        ratio(F.sum("payment_value_total"), F.sum("item_gmv")).alias("payment_ratio"),
    ]


def item_metrics() -> list[Column]:
    """What the contracts need from the item fact but its keys."""
    return [F.sum("gmv").alias("items_gmv")]


def _observe_items(items: DataFrame) -> DataFrame:
    return items.agg(*item_metrics())


def _observe_keys(items: DataFrame, facts: DataFrame) -> DataFrame:
    """Both grain checks and the item-level GMV of eligible orders, in one pass by order id.

    Lines are summed per order before the join, and over facts that are stored by order nothing is
    shuffled. A repeated order counts once for each of its rows, as the plain join of both facts would.
    """
    eligible = F.count(F.when(F.col("is_revenue_eligible_order") == 1, 1))
    orders = facts.groupBy(F.col("order_id").alias("__order")).agg(
        F.count(F.lit(1)).alias("order_rows"), eligible.cast("decimal(19,0)").alias("eligible_rows")
    )
    lines = (
        items.groupBy("order_id", "order_item_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("gmv").alias("gmv"))
        .groupBy("order_id")
        .agg(F.sum("n").alias("line_rows"), F.count(F.lit(1)).alias("line_keys"), F.sum("gmv").alias("gmv"))
    )
    both = orders.join(lines, F.col("__order") == F.col("order_id"), "full")
    none = F.lit(0).cast("bigint")
    return both.agg(
        # Rows without an order id are all excess.
        F.coalesce(F.sum(F.col("order_rows") - F.col("__order").isNotNull().cast("bigint")), none).alias(
            "order_key_excess"
        ),
        F.coalesce(F.sum(F.col("line_rows") - F.col("line_keys")), none).alias("item_key_excess"),
        F.sum(F.when(F.col("eligible_rows") > 0, F.col("gmv") * F.col("eligible_rows"))).alias("items_gmv_eligible"),
    )


def _orphans(df: DataFrame, key: str, parents: DataFrame, name: str) -> DataFrame:
    """Rows whose key has no parent. Rows are counted per key before the join."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(parents.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(name)
    )


def _observe_reports(headline: DataFrame, monthly: DataFrame) -> DataFrame:
    """Headline against its own formula and against the monthly table."""
    h = headline.select(
        F.col("gmv_revenue_eligible").alias("h_gmv"),
        F.col("revenue_eligible_orders").alias("h_orders"),
        F.col("aov_revenue_eligible").alias("h_aov"),
    )
    m = monthly.agg(
        # Months are summed as exact decimals, so the result does not depend on their order.
        F.sum(F.col("gmv_revenue_eligible").cast("decimal(38,10)")).cast("double").alias("m_gmv"),
        F.sum("revenue_eligible_orders").alias("m_orders"),
    )
    expected = F.coalesce(ratio(F.col("h_gmv"), F.col("h_orders")), F.lit(0.0))
    weighted = F.coalesce(ratio(F.col("m_gmv"), F.col("m_orders")), F.lit(0.0))
    return h.crossJoin(F.broadcast(m)).select(
        (F.col("h_aov") - expected).alias("headline_aov_gap"),
        (F.col("m_gmv") - F.col("h_gmv")).alias("monthly_gmv_gap"),
        (F.col("m_orders") - F.col("h_orders")).alias("monthly_orders_gap"),
        (F.col("h_aov") - weighted).alias("monthly_aov_gap"),
    )


def observe(
    facts: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    headline: DataFrame,
    monthly: DataFrame,
    excluded: Sequence[str] = EXCLUDED_STATUSES,
    of_orders: DataFrame | None = None,
    of_items: DataFrame | None = None,
) -> DataFrame:
    """One row with every number the contracts look at. All joins here are of one-row frames.

    ``excluded`` names the statuses that the order facts were built to leave out of revenue.
    ``of_orders`` and ``of_items`` hold ``order_metrics`` and ``item_metrics`` where these were observed
    while the facts were written; then each fact is read twice only, by its key and by its foreign key.
    """
    parts = [
        of_items if of_items is not None else _observe_items(items),
        _observe_keys(items, facts),
        _orphans(facts, "customer_id", customers, "orders_without_customer"),
        _orphans(items, "product_id", products, "items_without_product"),
        _observe_reports(headline, monthly),
    ]
    row = of_orders if of_orders is not None else facts.agg(*order_metrics(excluded))
    for part in parts:
        row = row.crossJoin(F.broadcast(part))
    return row.withColumns(
        {
            "gmv_gap_all": F.col("items_gmv") - F.col("order_gmv"),
            "gmv_gap_eligible": F.col("items_gmv_eligible") - F.col("order_gmv_eligible"),
        }
    )


def gmv_reconciliation(items: DataFrame, facts: DataFrame) -> DataFrame:
    """Total GMV by items and by orders, side by side; the difference should be zero."""
    by_orders = facts.agg(F.sum("item_gmv").alias("orders_gmv"))
    return _observe_items(items).crossJoin(F.broadcast(by_orders)).select(
        F.col("items_gmv").cast("double").alias("item_level_gmv"),
        F.col("orders_gmv").cast("double").alias("order_level_gmv"),
        (F.col("items_gmv") - F.col("orders_gmv"))
        .cast("double")
        .alias("difference_should_be_zero"),
    )


# --- results and gate -----------------------------------------------------------------------


def run_contracts(
    observations: DataFrame, contracts: Sequence[Contract] = CONTRACTS
) -> DataFrame:
    """One row per contract with PASS or FAIL. A missing observation fails."""

    def result(c: Contract) -> Column:
        seen = F.col(c.observed).cast("double")
        passed = F.coalesce(c.rule(seen), F.lit(False))
        return F.struct(
            F.lit(c.name).alias("test_name"),
            F.lit(c.severity).alias("severity"),
            F.when(passed, "PASS").otherwise("FAIL").alias("status"),
            seen.alias("observed_value"),
            F.lit(c.threshold).alias("threshold"),
            F.lit(c.rationale).alias("rationale"),
        )

    return observations.select(F.inline(F.array(*[result(c) for c in contracts])))


def summarize(results: DataFrame) -> DataFrame:
    failed = F.col("status") == "FAIL"
    return results.agg(
        F.count(F.lit(1)).alias("total_tests"),
        F.count(F.when(failed, 1)).alias("failed_tests"),
        F.count(F.when(failed & (F.col("severity") == CRITICAL), 1)).alias("critical_failed"),
    )


class PublicationBlocked(RuntimeError):
    """A critical contract failed; nothing is promoted."""


def caveat(summary: DataFrame) -> str | None:
    """What readers of a released run should know; None if every contract has passed."""
    (row,) = summary.collect()
    if not row["failed_tests"]:
        return None
    return f"{row['failed_tests']} of {row['total_tests']} data contracts failed without blocking"


def gate(summary: DataFrame) -> None:
    """Raises when any critical contract failed. Collects exactly one row."""
    (row,) = summary.collect()
    if row["critical_failed"] > 0:
        raise PublicationBlocked(
            f"{row['critical_failed']} of {row['total_tests']} data contracts failed critically"
        )
