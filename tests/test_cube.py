"""The daily cube against the reports over order facts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.rows import bag
from tests.shop import raw_tables, shop
from trustmart.operators import cube, kpis, monitors
from trustmart.plans.publish import publish
from trustmart.plans.registry import model_over
from trustmart.sources.layers import PublicationLog, written

REPORTS = {
    "headline": (cube.headline, kpis.headline),
    "monthly": (lambda c: cube.period_kpis(c, "month"), lambda f: kpis.period_kpis(f, "month")),
    "weekly": (lambda c: cube.period_kpis(c, "week"), lambda f: kpis.period_kpis(f, "week")),
    "delay_vs_reviews": (cube.delay_vs_reviews, kpis.delay_vs_reviews),
    "weekly_watch": (cube.weekly_watch, monitors.weekly_watch),
}

SCHEMA = """order_id string, order_purchase_ts timestamp_ntz, item_gmv decimal(16,4),
    revenue_eligible_gmv decimal(16,4), is_revenue_eligible_order int, is_canceled_or_unavailable int,
    avg_review_score double, delivery_days bigint, estimated_delivery_days bigint, is_on_time_delivery int"""


@pytest.fixture(scope="module")
def facts(spark):
    """Orders of which each column may be null, on few days, some of them without a time."""
    rng = random.Random(7)

    def maybe(value):
        return None if rng.random() < 0.15 else value

    def row(i):
        day = datetime(2017, 11, 20) + timedelta(days=rng.randrange(60), hours=rng.randrange(24))
        gmv = maybe(rng.randrange(10**7) / 10**4)
        eligible = int(gmv is not None and rng.random() < 0.8)
        score = maybe(rng.choice([1.0, 2.5, 3 + 1 / 3, 4 + 2 / 3, 5.0]))
        days, due = maybe(rng.randrange(30)), maybe(rng.randrange(20))
        return (str(i), maybe(day), gmv, gmv if eligible else 0.0, eligible, maybe(rng.randrange(2)), score, days, due, maybe(rng.randrange(2)))

    decimal = ("item_gmv", "revenue_eligible_gmv")
    plain = SCHEMA.replace("decimal(16,4)", "double")
    rows = spark.createDataFrame([row(i) for i in range(400)], plain)
    rows = rows.withColumns({c: F.col(c).cast("decimal(16,4)") for c in decimal})
    return written(rows, "test-cube-facts")


def close(df, other) -> bool:
    def rounded(rows):
        return [tuple(float(f"{v:.12g}") if isinstance(v, float) else v for v in row) for row in rows]

    return sorted(rounded(df.collect()), key=repr) == sorted(rounded(other.collect()), key=repr)


@pytest.mark.parametrize("name", REPORTS)
@pytest.mark.parametrize("rows", ["all", "none"])
def test_folds_of_the_cube_are_the_reports_over_orders(facts, name, rows):
    fold, report = REPORTS[name]
    orders = facts if rows == "all" else facts.limit(0)
    folded = fold(cube.daily_cube(orders))
    assert close(folded, report(orders))
    assert folded.schema.names == report(orders).schema.names
    assert [f.dataType for f in folded.schema] == [f.dataType for f in report(orders).schema]


def test_cubes_of_batches_add_up_bit_for_bit(facts):
    whole = cube.daily_cube(facts)
    parts = [cube.daily_cube(facts.filter(F.pmod(F.col("order_id").cast("int"), F.lit(3)) == i)) for i in (2, 0, 1)]
    assert bag(cube.merged(parts)) == bag(whole)
    assert cube.merged(parts).schema.names == whole.schema.names
    # Types stay as they are, merge after merge.
    assert [f.dataType for f in cube.merged([cube.merged(parts)]).schema] == [f.dataType for f in whole.schema]


def test_a_change_moves_orders_between_days_and_removes_them(facts):
    """Some orders go, some move by days, some change in amount, score and delivery, some are new."""
    number = F.col("order_id").cast("int")
    moved = facts.withColumns(
        {
            "order_purchase_ts": F.when(number < 40, F.col("order_purchase_ts") + F.expr("interval 9 days")).otherwise(
                F.col("order_purchase_ts")
            ),
            "item_gmv": F.when(number.between(30, 60), F.lit(3).cast("decimal(16,4)")).otherwise(F.col("item_gmv")),
            "delivery_days": F.when(number.between(50, 80), F.lit(None)).otherwise(F.col("delivery_days")),
            "avg_review_score": F.when(number.between(70, 90), F.lit(1 / 3)).otherwise(F.col("avg_review_score")),
        }
    )
    old, now = facts.filter(number < 380), moved.filter(number >= 10)
    touched = (number <= 90) | (number >= 380)
    step = cube.change(old.filter(touched), now.filter(touched))
    after = cube.merged([cube.daily_cube(old), step])
    for fold, _ in REPORTS.values():
        assert bag(fold(after)) == bag(fold(cube.daily_cube(now)))


def test_a_day_that_has_lost_all_orders_is_in_no_report(facts):
    gone = facts.filter("order_purchase_ts < timestamp_ntz'2017-12-01'")
    left = cube.merged([cube.daily_cube(facts), cube.change(gone, gone.limit(0))])
    rest = cube.daily_cube(facts.join(gone, "order_id", "left_anti"))
    assert bag(cube.period_kpis(left, "week")) == bag(cube.period_kpis(rest, "week"))
    assert bag(cube.levels(left)) == bag(cube.levels(rest))


def test_levels_hold_every_fold(facts):
    stored = cube.daily_cube(facts)
    levels = cube.levels(stored)
    month = levels.filter("level = 'month'").drop("level", "delay_bucket").withColumnRenamed("period_start", "month_start")
    assert bag(month) == bag(cube.period_kpis(stored, "month"))
    assert {r.level for r in levels.collect()} == {*cube.UNITS, "bucket"}
    assert cube.levels(stored.limit(0)).count() == 0


def test_five_reports_read_the_stored_cube_alone(spark):
    orders = model_over(spark, SMALL).orders
    stored = written(cube.daily_cube(orders), "test-cube")
    for fold, _ in REPORTS.values():
        files = fold(stored).inputFiles()
        assert files and set(files) == set(stored.inputFiles())


def test_a_publication_reports_from_its_cube(spark, tmp_path):
    publish(spark, raw_tables(spark).__getitem__, str(tmp_path), "run-1", prefix="cubed_", buckets=3)
    read = PublicationLog(spark, str(tmp_path)).read_kpi
    model = shop(spark)
    assert close(read("kpi_weekly_ops"), model.weekly())
    assert close(read("kpi_delay_vs_reviews"), model.delay_vs_reviews())
    assert close(cube.headline(spark.table("cubed_marts.daily_cube")), model.headline())
