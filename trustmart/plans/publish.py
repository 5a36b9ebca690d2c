"""One publication run: build, report, test, and release only if no critical contract fails."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from trustmart.operators import dashboard, monitors
from trustmart.operators.contracts import caveat, gate, item_metrics, order_metrics, summarize
from trustmart.operators.kpis import report_order
from trustmart.operators.marts import order_seller_performance
from trustmart.plans.model import MOST_LINES, WAVES, Model
from trustmart.sources.layers import (
    CONTRACTS,
    KPI,
    MARTS,
    MONITORS,
    PAGES,
    RAW,
    STAGING,
    Buckets,
    Layers,
    PublicationLog,
    dealt,
    export,
    largest_group,
    observed,
    observed_row,
    require_single_row,
)
from trustmart.sources.raw import RAW_COLUMNS, register

# Independent tables are written by a few jobs at a time, so that a small one does not leave the
# cluster waiting.
JOBS_AT_ONCE = 4
#: What is observed of a fact while it is written.
METRICS = {"fact_orders": order_metrics, "fact_order_items": item_metrics}
#: Bands that the monthly KPIs are expected to keep.
BANDS = {"cancellation_rate": (0.0, 0.2), "on_time_delivery_rate": (0.8, 1.0)}


def _side_by_side(job: Callable[..., object], names: Iterable) -> None:
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        list(pool.map(job, names))


def publish(
    spark: SparkSession,
    raw: Callable[[str], DataFrame],
    root: str,
    run_id: str,
    csv_path: str | None = None,
    land_raw: bool = False,
    prefix: str = "trustmart_",
    note: str | None = None,
    as_of: date | None = None,
    bands: Mapping[str, tuple[float, float]] = BANDS,
    buckets: int | None = None,
    most_lines: int = MOST_LINES,
) -> DataFrame:
    """Run everything under ``root/runs/<run_id>`` and release it; returns the contract results.

    The run also holds the data of the dashboard pages and the monitors: freshness as of ``as_of``
    (today), daily volume, monthly KPIs against ``bands``, and the status of the three. ``note`` goes
    into the log; where contracts that do not block have failed, the log names their number if
    nobody has written a note.

    Staging, marts and reports are written as Parquet inside the run's own folder. The contracts
    then read the written reports. A critical failure raises ``PublicationBlocked``: the results
    stay readable in the run's folder and readers keep the previous release, in the catalogue, the
    view and the CSV files too: these change after the gate only. With ``csv_path`` the
    released reports are also exported as sorted CSV with a header. ``land_raw`` first stores the
    raw tables as Parquet too: worth it for CSV input, which would else be parsed once per reader,
    and in one task where it is multi-line. The run's tables are registered in the databases
    ``<prefix>raw``, ``<prefix>staging`` and ``<prefix>marts``.

    Of two runs that are going on at once the first to finish is released; the other raises
    ``StaleCommit`` and leaves names and files as they are. Names follow the log's entry: a driver lost
    in between leaves them behind it, and ``PublicationLog.name_tables`` catches up.

    Both facts are stored in ``buckets`` (by default as many as the session's shuffle partitions) by
    order id, so that the reports and contracts that bring them together shuffle neither of them. Item
    facts are stored plainly where one order has more than ``most_lines`` lines, as these would fill one
    bucket. What the contracts need of the facts besides their keys is observed while they are written.
    """
    log = PublicationLog(spark, root)
    if log.is_released(run_id):
        raise ValueError(f"run {run_id} is released and cannot be written again")
    before = log.newest()
    layers = Layers(spark, log.run_path(run_id), prefix).create()
    kept: dict[tuple[str, str], Buckets | None] = {}
    seen: dict[str, DataFrame] = {}
    by_order = Buckets("order_id", buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def layout(name: str) -> Buckets | None:
        if name == "fact_order_items":
            lines = largest_group(layers.read(STAGING, "stg_order_items"), by_order.key)
            return by_order if lines <= most_lines else None
        return by_order if name == "fact_orders" else None

    def keep(layer: str, name: str, df: DataFrame) -> DataFrame:
        kept[layer, name] = layout(name)
        if name not in METRICS:
            return layers.write(layer, name, df)
        metrics = METRICS[name]()
        schema = df.agg(*metrics).schema
        if kept[layer, name]:
            df, watch = observed(dealt(df, by_order), name, metrics)
            stored = layers.write_bucketed(layer, name, df, by_order)
        else:
            df, watch = observed(df, name, metrics)
            stored = layers.write(layer, name, df)
        seen[name] = observed_row(spark, watch, schema)
        return stored

    if land_raw:
        source = raw
        _side_by_side(lambda name: keep(RAW, name, source(name)), RAW_COLUMNS)
        raw = partial(layers.read, RAW)
    model = Model(raw, keep=keep)
    for wave in WAVES:
        _side_by_side(lambda table: getattr(model, table), wave)

    kpi = partial(layers.read, KPI)

    def store(layer: str, tables: Mapping[str, Callable[[], DataFrame]]) -> None:
        _side_by_side(lambda name: export(tables[name](), layers.path(layer, name)), tables)

    reports = model.reports()
    # The counts look at reports that have been exported.
    counts = {"model_row_counts": lambda: model.row_counts(kpi)}
    store(KPI, {name: build for name, build in reports.items() if name not in counts})
    store(KPI, counts)

    results_path = layers.path(CONTRACTS, "data_contract_test_results")
    summary_path = layers.path(CONTRACTS, "data_contract_test_summary")
    export(
        model.contract_results(
            require_single_row(kpi("kpi_headline")),
            kpi("kpi_monthly"),
            seen["fact_orders"],
            seen["fact_order_items"],
        ),
        results_path,
    )
    results = spark.read.parquet(results_path)
    export(summarize(results), summary_path)
    summary = spark.read.parquet(summary_path)
    gate(summary)

    page_data = dashboard.pages(kpi)
    store(PAGES, page_data)
    watched = {
        "freshness": lambda: monitors.freshness(model.orders, as_of or date.today()),
        "volume_anomaly": lambda: monitors.volume_anomaly(model.orders),
        "kpi_drift": lambda: monitors.kpi_drift(kpi("kpi_monthly"), bands, ["month_start"]),
    }
    store(MONITORS, watched)
    seen = [layers.read(MONITORS, name) for name in watched]
    store(MONITORS, {"monitor_status": lambda: monitors.monitor_status(*seen)})

    # Nothing of this run is to be seen before here.
    tables = {f"{layer}/{name}": layout_of for (layer, name), layout_of in kept.items()}
    tables |= {f"{KPI}/{name}": None for name in reports} | {f"{PAGES}/{name}": None for name in page_data}
    tables |= {f"{MONITORS}/{name}": None for name in (*watched, "monitor_status")}
    log.release(run_id, note or caveat(summary), before.number if before else 0, tables)
    log.name_tables(prefix)
    facts = [spark.table(f"{layers.database(MARTS)}.{t}") for t in ("fact_order_items", "fact_orders")]
    register(order_seller_performance(*facts), "vw_order_seller_performance")
    if csv_path:
        folder = csv_path.rstrip("/")
        files = [
            *[(KPI, name) for name in reports],
            (CONTRACTS, "data_contract_test_results"),
            (CONTRACTS, "data_contract_test_summary"),
            (MONITORS, "monitor_status"),
            *[(PAGES, name) for name in page_data],
        ]
        _side_by_side(
            lambda file: export(
                layers.read(*file),
                f"{folder}/{file[1]}",
                "csv",
                report_order(file[1]) if file[0] == KPI else (),
            ),
            files,
        )
    return results
