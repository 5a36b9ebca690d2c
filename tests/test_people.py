"""Distinct customers from bitmaps against counting them."""

import random
import re
from datetime import datetime, timedelta

import pytest

from tests.rows import bag, frame
from trustmart.operators import kpis, monitors, people
from trustmart.sources.layers import written

ORDERS = "customer_unique_id string, order_purchase_ts timestamp_ntz"


@pytest.fixture(scope="module")
def orders(spark):
    rng = random.Random(11)

    def row():
        person = None if rng.random() < 0.1 else f"p{int(rng.random() ** 3 * 300)}"
        day = datetime(2016, 10, 1) + timedelta(days=rng.randrange(500))
        return person, None if rng.random() < 0.05 else day

    # A month in which nobody known ordered, and a person of one order without a time.
    rows = [row() for _ in range(900)] + [(None, datetime(2019, 3, 3)), ("timeless", None)]
    return written(frame(spark, ORDERS, *rows), "test-people-orders")


def bitmaps(orders, parts=3):
    active = people.activity(orders)
    return people.month_bitmaps(active, people.numbered(active, "person", parts))


@pytest.mark.parametrize("unit", ["month", "quarter", "year"])
@pytest.mark.parametrize("parts", [1, 3])
def test_months_fold_into_longer_units(orders, unit, parts):
    found = people.active_customers(bitmaps(orders, parts), unit)
    expected = kpis.active_customers(orders, unit)
    assert bag(found) == bag(expected) and found.columns == expected.columns


def test_weeks_do_not_fold_from_months(orders):
    with pytest.raises(ValueError):
        people.active_customers(bitmaps(orders), "week")


def test_repeat_rate(orders):
    assert bag(people.repeat_rate(bitmaps(orders))) == bag(monitors.repeat_rate(orders))


def test_no_orders(orders):
    none = bitmaps(orders.limit(0))
    assert people.active_customers(none, "month").count() == 0
    assert bag(people.repeat_rate(none)) == bag(monitors.repeat_rate(orders.limit(0)))


def test_later_people_leave_earlier_numbers_and_bitmaps_right(orders):
    active = written(people.activity(orders), "test-activity")
    first, rest = active.filter("month_start < date'2017-06-01'"), active.filter(
        "month_start >= date'2017-06-01' or month_start is null"
    )
    numbers = written(people.numbered(first, "person", 3), "test-numbers")
    more = written(people.numbered(rest, "person", 3, numbers), "test-more")
    assert set(bag(numbers)) <= set(bag(more))
    everyone = more.select("person").distinct().count()
    assert more.count() == everyone == more.select("part", "n").distinct().count()
    # Dense: the numbers of a part go from 1 to their count.
    assert all(r[1] == r[2] for r in more.groupBy("part").agg({"n": "max", "person": "count"}).collect())
    both = people.month_bitmaps(first, numbers).unionByName(people.month_bitmaps(rest, more))
    # A batch that comes twice changes nothing.
    both = people.merged(both.unionByName(people.month_bitmaps(first, more)))
    assert bag(people.active_customers(both, "year")) == bag(kpis.active_customers(orders, "year"))
    assert bag(people.repeat_rate(both)) == bag(monitors.repeat_rate(orders))


def test_more_people_than_one_bitmap_holds(spark):
    many = spark.range(70_000).selectExpr(
        "concat('p', id) AS customer_unique_id", "timestamp_ntz'2018-01-05' + make_interval(0, id % 5) AS order_purchase_ts"
    )
    maps = written(bitmaps(many, 2), "test-many")
    assert maps.select("part", "stretch").distinct().count() >= 3
    assert [tuple(r) for r in people.active_customers(maps, "year").collect()][0][1] == 70_000
    assert bag(people.repeat_rate(maps)) == [(70_000, 0, 0.0)]


def test_one_person_with_most_of_the_orders_is_one_row_a_month(spark):
    """The hot person meets the numbers after orders have been counted by month and person."""
    hot = spark.range(20_000).selectExpr(
        "if(id % 3 > 0, 'hot', concat('p', id)) AS customer_unique_id", "timestamp_ntz'2018-01-05' AS order_purchase_ts"
    )
    active = people.activity(hot)
    assert active.filter("person = 'hot'").count() == 1
    plan = active._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Window.*\n(?:.*\n)*?.*Aggregate", plan)
    assert bag(people.repeat_rate(bitmaps(hot))) == bag(monitors.repeat_rate(hot))


def test_parts_for():
    assert people.parts_for(0) == people.parts_for(people.PER_PART) == 1
    assert people.parts_for(people.PER_PART + 1) == 2
