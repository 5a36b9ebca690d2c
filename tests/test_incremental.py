"""Keyed winners batch by batch, and facts month by month."""

import os
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.rows import bag, frame
from trustmart.operators.dedupe import asc_last, desc_last
from trustmart.operators.staging import Rule
from trustmart.plans import registry
from trustmart.sources.monthly import MonthlyFacts
from trustmart.sources.winners import KeyedWinners, StaleCommit

RULE = Rule(("k",), lambda: [desc_last("v"), asc_last("a")])
SCHEMA = "k string, v int, a string, rest int"


def rows():
    found = [(f"k{i % 13}" if i % 17 else None, i * 7 % 5 if i % 4 else None, "xyz"[i % 3], i % 6) for i in range(200)]
    return found + [("hot", i % 40, "h", i) for i in range(3000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_and_repeated_give_one_full_run(spark, tmp_path, seed):
    df = frame(spark, SCHEMA, *rows())
    cut = df.withColumn("batch", F.pmod(F.xxhash64("k", "v", "a", "rest", F.lit(seed)), F.lit(4)))
    store = KeyedWinners(spark, str(tmp_path / "s"), df.schema, RULE, buckets=5)
    for name in (3, 0, 3, 2, 1, 0):
        first = f"b{name}" not in store.state()[2]
        assert store.commit(f"b{name}", cut.filter(F.col("batch") == name)) == first
    total = Rule(RULE.keys, lambda: [*RULE.order(), asc_last("rest")])
    assert bag(store.rows()) == bag(total.winners(df)) and len(bag(store.rows())) == 15


def test_only_touched_buckets_are_written(spark, tmp_path):
    df = frame(spark, SCHEMA, *rows())
    store = KeyedWinners(spark, str(tmp_path), df.schema, RULE, buckets=8)
    store.commit("all", df)
    where = store.state()[1]
    store.commit("one", frame(spark, SCHEMA, ("hot", 99, "new", 1)))
    moved = {b for b, v in store.state()[1].items() if where.get(b) != v}
    assert len(moved) == 1 and [tuple(r) for r in store.rows().filter("k = 'hot'").collect()] == [("hot", 99, "new", 1)]
    store.commit("none", df.limit(0))
    assert store.state()[0] == 3 and store.rows().count() == 15


def test_a_commit_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    """To the tasks that write them, at least one a bucket; nothing is shuffled again into its files."""
    seen = []
    for way in ("_by_bucket", "_by_key"):
        run = getattr(KeyedWinners, way)
        monkeypatch.setattr(KeyedWinners, way, lambda *a, run=run, way=way: seen.append((way, run(*a))) or seen[-1][1])
    df = frame(spark, SCHEMA, *rows())
    for folder, most in (("few", 5000), ("hot", 1000)):
        store = KeyedWinners(spark, str(tmp_path / folder), df.schema, RULE, buckets=3, most_rows=most)
        store.commit("all", df.filter("k <> 'k1' or k is null"))
        store.commit("rest", df.filter("k = 'k1'"))
        total = Rule(RULE.keys, lambda: [*RULE.order(), asc_last("rest")])
        assert bag(store.rows()) == bag(total.winners(df))
    assert [way for way, _ in seen] == ["_by_bucket", "_by_bucket", "_by_key", "_by_bucket"]
    # Two parts a bucket, for the session's four shuffle partitions; the hot key is cut down before its shuffle.
    plans = [merged._jdf.queryExecution().executedPlan().toString() for _, merged in seen[:3]]
    assert [len(re.findall(r"Exchange \w+", p)) for p in plans] == [1, 1, 2]
    assert all(re.search(r"Exchange \w+\(.*, 6\)", p) for p in plans[:2])
    assert "WindowGroupLimit" in plans[2][plans[2].rindex("Exchange") :]


def test_of_two_commits_at_once_one_wins(spark, tmp_path):
    df = frame(spark, SCHEMA, ("a", 1, "x", 1))
    one, other = (KeyedWinners(spark, str(tmp_path), df.schema, RULE) for _ in range(2))
    late = other.state()
    assert one.commit("first", df)
    other.state = lambda: late
    with pytest.raises(StaleCommit):
        other.commit("second", frame(spark, SCHEMA, ("a", 2, "y", 2)))
    del other.state
    assert one.state()[2] == ["first"] and other.commit("second", frame(spark, SCHEMA, ("a", 2, "y", 2)))
    assert bag(one.rows()) == [("a", 2, "y", 2)]


def test_no_batch_no_row(spark, tmp_path):
    store = KeyedWinners(spark, str(tmp_path), frame(spark, SCHEMA, *rows()).schema, RULE)
    assert store.rows().collect() == [] and store.state() == (0, {}, [])


FACT = "order_id string, order_purchase_ts timestamp, gmv int"


def at(month: int, day: int = 5):
    return datetime(2018, month, day, 12)


def files(root) -> dict:
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.startswith("part-")}


def test_changed_months_are_written_anew_and_others_left_alone(spark, tmp_path):
    old = [("a", at(1), 1), ("b", at(2), 2), ("c", at(3), 3), ("d", None, 4), ("e", at(4), 5)]
    store = MonthlyFacts(spark, str(tmp_path / "f"), frame(spark, FACT, *old).schema)
    store.create(frame(spark, FACT, *old))
    assert bag(store.read()) == bag(frame(spark, FACT, *old))
    before = files(tmp_path / "f")
    # b moves from February to March, e is gone, d gets a time; January is left alone.
    new = [("a", at(1), 1), ("b", at(3), 20), ("c", at(3), 3), ("d", at(3, 9), 4)]
    changed = frame(spark, "order_id string", ("b",), ("d",), ("e",), ("no such",))
    assert store.refresh(frame(spark, FACT, *new), changed) == {"2018-02", "2018-03", "2018-04", None}
    assert bag(store.read()) == bag(frame(spark, FACT, *new))
    after = files(tmp_path / "f")
    assert len(set(before.items()) & set(after.items())) == 1
    assert sorted(p for p in os.listdir(tmp_path / "f") if "=" in p) == ["purchase_month=2018-01", "purchase_month=2018-03"]
    store.refresh(frame(spark, FACT, *new), changed.limit(0))
    assert files(tmp_path / "f") == after
    store.create(frame(spark, FACT, ("z", at(7), 1)))
    assert bag(store.read()) == [("z", at(7), 1)]


def test_a_date_slicer_reads_its_months_only(spark, tmp_path):
    rows = [(f"o{m}", at(m), m) for m in range(1, 13)] + [("none", None, 0)]
    store = MonthlyFacts(spark, str(tmp_path), frame(spark, FACT, *rows).schema)
    assert store.read().collect() == []
    store.create(frame(spark, FACT, *rows))
    part = store.read(date(2018, 3, 31), date(2018, 5, 1))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan
    assert len(part.inputFiles()) == 13 and bag(part.select("gmv")) == [(3,), (4,), (5,)]
    assert part.filter("gmv > 0").count() == 3 and store.read(last=date(2018, 1, 1)).count() == 1


def test_a_model_over_months_equals_a_full_rebuild(spark, tmp_path):
    model = registry.model_over(spark, SMALL)
    facts = model.orders
    store = MonthlyFacts(spark, str(tmp_path), facts.schema)
    early = facts.filter("order_purchase_ts < '1996-01-01'")
    store.create(early)
    late = facts.filter("order_purchase_ts >= '1995-12-01'")
    store.refresh(facts, late)
    assert bag(store.read().select("order_id", "item_gmv")) == bag(facts.select("order_id", "item_gmv"))
