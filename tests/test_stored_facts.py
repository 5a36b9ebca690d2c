"""Facts that are stored by order, metrics observed while they are written, models that follow the files."""

import re
import shutil

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.rows import bag, frame
from tests.shop import raw_tables, shop
from trustmart.functions.metrics import as_reported
from trustmart.operators import contracts, kpis, marts, monitors
from trustmart.plans import registry
from trustmart.plans.publish import publish
from trustmart.sources.layers import Buckets, Layers, PublicationLog, dealt, overfull, written_observed


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """The catalogue's facts and dimensions after a publication in three buckets."""
    root = str(tmp_path_factory.mktemp("stored"))
    publish(spark, raw_tables(spark).__getitem__, root, "run-1", prefix="stored_", buckets=3)
    return lambda name: spark.table(f"stored_marts.{name}")


REPORTS = {
    "seller_risk": lambda t: kpis.seller_risk(t("fact_order_items"), t("fact_orders"), t("dim_sellers"), 1),
    "category": lambda t: kpis.category_performance(t("fact_order_items"), t("fact_orders"), t("dim_products")),
    "seller": lambda t: kpis.seller_performance(t("fact_order_items"), t("fact_orders"), t("dim_sellers")),
    "concentration": lambda t: kpis.seller_concentration(t("fact_order_items"), t("fact_orders")),
    "category_reviews": lambda t: monitors.category_reviews(t("fact_order_items"), t("fact_orders"), t("dim_products")),
    "contract_keys": lambda t: contracts._observe_keys(t("fact_order_items"), t("fact_orders")),
}


@pytest.mark.parametrize("name", REPORTS)
def test_reports_over_stored_facts_do_not_shuffle_them_by_order(spark, published, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = REPORTS[name](published)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert not re.findall(r"hashpartitioning\((?:__order|order_id)#\d+L?(?:, order_item_id#\d+)?, \d+", plan)
        assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
        model = shop(spark)
        lazy = {"fact_order_items": model.order_lines, "fact_orders": model.orders, "dim_sellers": model.sellers}
        assert bag(report) == bag(REPORTS[name](lambda t: lazy.get(t, model.products)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_working_name_is_gone_and_its_plan_still_reads(spark, tmp_path):
    layers = Layers(spark, str(tmp_path), "gone_").create(["marts"])
    by_a = Buckets("a", 4)
    rows = [(f"k{i % 9}", i) for i in range(50)] + [(None, 1)]
    stored = layers.write_bucketed("marts", "t", dealt(frame(spark, "a string, b int", *rows), by_a), by_a)
    assert spark.sql("SHOW TABLES IN gone_work").filter("not isTemporary").count() == 0
    assert bag(stored) == bag(spark.createDataFrame(rows, "a string, b int"))
    layers.write_bucketed("marts", "t", dealt(frame(spark, "a string, b int", ("x", 2)), by_a), by_a)
    layers.register("marts", "t", by_a)
    assert bag(spark.table("gone_marts.t")) == [("x", 2)]
    assert "Num Buckets" in {r.col_name for r in spark.sql("DESCRIBE EXTENDED gone_marts.t").collect()}


def _exchanges(df) -> list[str]:
    """What is shuffled by hash, as the plan says before it runs."""
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", df._jdf.queryExecution().executedPlan().toString())


def test_rows_dealt_by_order_are_shuffled_once(spark):
    """De-duplication, roll-ups and joins by order share one shuffle of orders, items and payments each."""
    by_order = Buckets("order_id", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = shop(spark)
        by = plain.dealt_by_order(lambda df: dealt(df, by_order), by_order.count)
        assert len(_exchanges(by.fact_order_items)) == 2 and len(_exchanges(plain.fact_order_items)) == 4
        # Reviews are de-duplicated by their own key first.
        assert len(_exchanges(by.orders)) == 5 and len(_exchanges(plain.orders)) > 5
        assert bag(by.fact_order_items) == bag(plain.fact_order_items) and bag(by.orders) == bag(plain.orders)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_facts_sum_payments_without_sorting_them(spark):
    model = shop(spark)
    by = model.dealt_by_order(lambda df: dealt(df, Buckets("order_id", 4)), 4)
    for orders in (model.orders, by.orders):
        assert re.search(r"HashAggregate\(keys=\[order_id#\d+, payment_sequential#\d+\]", _plan(orders))
        assert not re.search(r"(Sort|Window\w*) \[.*payment_sequential", _plan(orders))
    kept = ("order_id", "payment_value_total", "payment_record_count")
    totals = marts.rollup_payments(model.stg_order_payments)
    assert bag(by.orders.select(*kept).dropna()) == bag(totals.join(model.stg_orders, "order_id", "left_semi").select(*kept).dropna())


def test_keys_and_amounts_are_stored_without_a_dictionary(spark, tmp_path):
    by_a = Buckets("a", 2)
    rows = frame(spark, "a string, b decimal(16,4), c string", *[(f"k{i}", None, "x") for i in range(50)])
    stored = Layers(spark, str(tmp_path), "plain_").write_bucketed("marts", "t", dealt(rows, by_a), by_a)
    (file, *_) = [f[len("file:") :] for f in stored.inputFiles()]
    group = pq.ParquetFile(file).metadata.row_group(0)
    with_dictionary = {group.column(i).path_in_schema for i in range(3) if any("DICT" in e for e in group.column(i).encodings)}
    assert with_dictionary == {"c"} and bag(stored) == bag(rows)


def test_stored_lines_meet_their_orders_as_they_are_read(spark):
    """Lines in buckets are not summed before the join; lines that are stored plainly still are."""
    expected = bag(registry.model_over(spark, SMALL).category_performance())
    for most_lines, summed in ((10**6, False), (0, True)):
        report = registry.stored_category(registry.model_over(spark, SMALL), most_lines)
        assert bool(re.search(r"HashAggregate\(keys=\[order_id#\d+, product_id#\d+\]", _plan(report))) == summed
        assert bag(report) == expected


def test_sellers_of_stored_lines_are_summed_once(spark):
    expected = bag(registry.model_over(spark, SMALL).seller_concentration())
    for most_lines, summed in ((10**6, False), (0, True)):
        report = registry.stored_seller_concentration(registry.model_over(spark, SMALL), most_lines)
        assert bool(re.search(r"HashAggregate\(keys=\[seller_id#\d+, order_id#\d+\]", _plan(report))) == summed
        assert bag(report) == expected


def test_fact_orders_are_dealt_by_order(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = registry.queries()["fact_orders"](spark, SMALL)
        plain = as_reported(registry.model_over(spark, SMALL).fact_orders)
        assert len(_exchanges(facts)) < len(_exchanges(plain))
        assert bag(facts.drop("avg_review_score")) == bag(plain.drop("avg_review_score"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_gate_tests_facts_that_are_stored_once(spark, monkeypatch):
    stored, tested = [], []
    facts, results = registry._facts_by_order, registry.Model.contract_results
    monkeypatch.setattr(registry, "_facts_by_order", lambda m: stored.append(facts(m)) or stored[-1])
    monkeypatch.setattr(registry.Model, "contract_results", lambda m: tested.append((m.fact_order_items, m.orders)) or results(m))
    rows = {r.run: r for r in registry.queries()["publication_gate"](spark, SMALL).collect()}
    assert len(stored) == 1 and tested == [stored[0], stored[0]]
    assert rows["clean"].released and not rows["no products"].released
    assert rows["no products"].critical_failed == rows["clean"].critical_failed + 1


def test_an_order_of_too_many_rows_is_not_dealt_by_order(spark):
    one = [(f"o{i}",) for i in range(400)]
    hot = frame(spark, "order_id string", *one, *[("hot",)] * 900)
    assert 700 < overfull([frame(spark, "order_id string", *one), hot], "order_id", 8) < 900
    assert overfull([hot.limit(0)], "order_id", 8) == 0
    model = registry.model_over(spark, SMALL)
    assert model.dealt_by_order(lambda df: df, 4, most_lines=0) is model
    items, orders = registry._facts_by_order(model, most_lines=0)
    assert bag(items) == bag(model.fact_order_items) and bag(orders.drop("avg_review_score")) == bag(
        model.orders.drop("avg_review_score")
    )


def test_an_order_of_too_many_lines_leaves_the_item_facts_plain(spark, tmp_path):
    publish(spark, raw_tables(spark).__getitem__, str(tmp_path), "run-1", prefix="plain_", buckets=3, most_lines=1)
    details = lambda t: {r.col_name for r in spark.sql(f"DESCRIBE EXTENDED plain_marts.{t}").collect()}
    assert "Num Buckets" not in details("fact_order_items") and "Num Buckets" in details("fact_orders")
    log = PublicationLog(spark, str(tmp_path))
    assert bag(log.read_kpi("kpi_category_performance")) == bag(shop(spark).category_performance())


@pytest.mark.parametrize("rows", ["all", "none"])
def test_observed_metrics_are_those_of_an_aggregate(spark, rows):
    model = shop(spark)
    for facts, metrics in ((model.orders, contracts.order_metrics()), (model.fact_order_items, contracts.item_metrics())):
        facts = facts if rows == "all" else facts.filter("order_id = 'no such order'")
        stored, row = written_observed(facts, "test-observed", metrics)
        assert row.collect() == facts.agg(*metrics).collect()
        assert bag(stored) == bag(facts)


def test_key_checks_count_repeated_and_missing_keys(spark):
    orders = frame(spark, "order_id string, is_revenue_eligible_order int", ("a", 1), ("a", 1), ("b", 0), (None, 1), (None, 0))
    items = frame(
        spark,
        "order_id string, order_item_id int, gmv double",
        ("a", 1, 5.0), ("a", 1, 5.0), ("a", 2, 1.0), ("b", 1, 7.0), (None, None, 9.0), (None, None, 9.0), ("c", 1, 3.0),
    ).withColumn("gmv", F.col("gmv").cast("decimal(16,4)"))
    (row,) = contracts._observe_keys(items, orders).collect()
    # One more row of order a, two rows without an id; the doubled order doubles its lines.
    assert (row.order_key_excess, row.item_key_excess, float(row.items_gmv_eligible)) == (3, 2, 22.0)
    (none,) = contracts._observe_keys(items.limit(0), orders.limit(0)).collect()
    assert (none.order_key_excess, none.item_key_excess, none.items_gmv_eligible) == (0, 0, None)


def test_a_query_sees_files_that_have_changed(spark, tmp_path):
    folder = str(tmp_path / "tables")
    shutil.copytree(SMALL, folder)
    query = registry.queries()["fact_orders"]
    before = query(spark, folder).count()
    orders = pq.read_table(f"{folder}/orders.parquet")
    at = orders.schema.get_field_index("o_orderkey")
    more = orders.slice(0, 40)
    keys = pc.add(more.column(at), pc.add(pc.max(orders.column(at)), 1)).cast(orders.schema.field(at).type)
    pq.write_table(pa.concat_tables([orders, more.set_column(at, orders.schema.field(at), keys)]), f"{folder}/orders.parquet")
    after = query(spark, folder).collect()
    assert len(after) == before + 40 and all(r.customer_order_sequence for r in after)
