"""CSV source, layers, report sinks and the publication run."""

from datetime import date

import pytest

from tests import shop as data
from tests.rows import bag, frame
from tests.shop import raw_tables, shop
from trustmart.operators import dashboard
from trustmart.operators.contracts import PublicationBlocked
from trustmart.plans.publish import publish
from trustmart.sources.layers import (
    Layers,
    PublicationLog,
    export,
    require_single_row,
    shared_folder,
)
from trustmart.sources.raw import read_raw, register

HEADER = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"


def test_quoted_multi_line_csv(spark, tmp_path):
    (tmp_path / "order_reviews.csv").write_text(
        HEADER + 'r1,o1,5,,"two\nlines, and ""quotes""",2020-01-01 00:00:00,\nr2,007,4,ok,x,,\n'
    )
    rows = {r.review_id: r for r in read_raw(spark, str(tmp_path), "order_reviews").collect()}
    assert rows["r1"].review_comment_message == 'two\nlines, and "quotes"'
    assert rows["r1"].review_comment_title is None
    assert rows["r2"].order_id == "007"


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "shop_sellers_dataset.csv").write_text(
        "﻿seller_state,extra,seller_id,seller_city,seller_zip_code_prefix\nsp,x,s1,a,01001\n",
        encoding="utf-8",
    )
    df = read_raw(spark, str(tmp_path), "sellers", "shop_{table}_dataset.csv")
    assert bag(df) == [("s1", "01001", "a", "sp")]
    with pytest.raises(ValueError, match="unknown raw table"):
        read_raw(spark, str(tmp_path), "nope")


def test_register(spark):
    register(frame(spark, "a int", (1,)), "a_view")
    assert spark.table("a_view").count() == 1


def test_layers_replace_tables(spark, tmp_path):
    layers = Layers(spark, str(tmp_path), "t1_").create()
    layers.materialize("marts", "t", frame(spark, "a int", (1,), (2,)))
    stored = layers.materialize("marts", "t", frame(spark, "a int", (3,)))
    assert bag(stored) == [(3,)]
    assert bag(spark.table("t1_marts.t")) == [(3,)]


def test_csv_export_is_sorted_and_has_a_header(spark, tmp_path):
    df = frame(spark, "a int, b string", (2, "x"), (1, 'say "hi"'), (3, None))
    export(df, str(tmp_path / "out"), "csv", [df.a.asc()])
    export(df, str(tmp_path / "out"), "csv", [df.a.asc()])
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert sorted(back.columns) == ["a", "b"]
    assert back.count() == 3
    with pytest.raises(ValueError, match="format"):
        export(df, str(tmp_path / "x"), "xls")


@pytest.mark.parametrize("n", [0, 1, 2])
def test_single_row_guard(spark, n):
    guarded = require_single_row(spark.range(n).selectExpr("id", "id * 2 AS b"))
    if n == 1:
        assert bag(guarded) == [(0, 0)]
    else:
        with pytest.raises(Exception, match="exactly one row"):
            guarded.collect()


class Named:
    """Stands for a session whose cluster names a shared folder."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder}


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(Named("s3a://bucket/shared/")) == "s3a://bucket/shared"
    assert shared_folder(Named(None)) == shared_folder(Named(None))


def test_waves_hold_every_table():
    from trustmart.plans.model import WAVES, Model

    tables = {n for n in vars(Model) if n.startswith(("stg_", "dim_", "fact_"))}
    assert sorted(t for wave in WAVES for t in wave) == sorted(tables | {"order_keys", "daily_cube"})


def test_publication(spark, tmp_path):
    root = str(tmp_path / "store")
    log = PublicationLog(spark, root)

    results = publish(spark, raw_tables(spark).__getitem__, root, "run-1", str(tmp_path / "csv"))
    assert results.count() == 17
    assert log.latest() == "run-1"
    assert bag(log.read_kpi("kpi_monthly")) == bag(shop(spark).monthly())
    lines = sorted((tmp_path / "csv" / "kpi_monthly").glob("part-*"))
    text = "".join(p.read_text() for p in lines)
    assert text.startswith("month_start,total_orders")
    files = {p.name for p in (tmp_path / "csv").iterdir()}
    pages = dashboard.pages(log.read_kpi)
    extra = {"data_contract_test_results", "data_contract_test_summary", "monitor_status"}
    assert files == set(shop(spark).reports()) | extra | set(pages)
    for name, build in pages.items():
        assert bag(log.read("pages", name)) == bag(build()), name
    status = {r.monitor: r.status for r in log.read("monitors", "monitor_status").collect()}
    # The shop's newest order is years old.
    assert set(status) == {"freshness", "volume_anomaly", "kpi_drift"} and status["freshness"] == "WARN"
    failed = results.filter("status = 'FAIL'").count()
    assert log.note("run-1") == f"{failed} of 17 data contracts failed without blocking"

    # Every stored report equals the one a lazy model computes.
    for name, build in shop(spark).reports().items():
        assert bag(log.read_kpi(name)) == bag(build()), name

    # A product that items point to is gone: critical, so the release stays.
    broken = raw_tables(spark, products=data.PRODUCTS[1:])
    with pytest.raises(PublicationBlocked):
        publish(spark, broken.__getitem__, root, "run-2")
    assert log.latest() == "run-1"
    assert spark.table("trustmart_marts.dim_products").count() == len(data.PRODUCTS)
    verdicts = spark.read.parquet(f"{root}/runs/run-2/contracts/data_contract_test_results")
    assert {r.test_name for r in verdicts.filter("status = 'FAIL' AND severity = 'critical'").collect()} == {
        "Fact Order Items product foreign key integrity"
    }

    with pytest.raises(ValueError, match="released"):
        publish(spark, raw_tables(spark).__getitem__, root, "run-1")

    fewer = [o for o in data.ORDERS if o[3] < "2018"]
    publish(spark, raw_tables(spark, orders=fewer).__getitem__, root, "run-3", land_raw=True, note="2017 only")
    assert log.latest() == "run-3"
    assert log.note("run-3") == "2017 only"
    assert spark.read.parquet(f"{root}/runs/run-3/raw/orders").count() == len(fewer)
    assert spark.table("vw_order_seller_performance").count() == 5
    counted = spark.sql("SELECT count(*) FROM trustmart_marts.fact_orders")
    assert counted.first()[0] == len(fewer)
    assert max(r.month_start for r in log.read_kpi("kpi_monthly").collect()) == date(2017, 12, 1)


def test_nothing_published_yet(spark, tmp_path):
    log = PublicationLog(spark, str(tmp_path))
    with pytest.raises(LookupError):
        log.read_kpi("kpi_monthly")


@pytest.mark.parametrize("row", ["s1,01001,sao paulo,SP,extra", "s1,01001,sao paulo"])
def test_malformed_csv_rows_fail(spark, tmp_path, row):
    (tmp_path / "sellers.csv").write_text(
        f"seller_id,seller_zip_code_prefix,seller_city,seller_state\ns0,01000,x,SP\n{row}\n"
    )
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|FAILFAST"):
        read_raw(spark, str(tmp_path), "sellers").select("seller_id").collect()
    assert read_raw(spark, str(tmp_path), "sellers", on_bad="PERMISSIVE").count() == 2
