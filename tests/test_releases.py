"""Releases by version files: one winner, expiry, half-written files."""

import os
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest

from trustmart.sources.layers import Buckets, PublicationLog
from trustmart.sources.versions import StaleCommit, VersionFiles


@pytest.fixture
def log(spark, tmp_path):
    return PublicationLog(spark, str(tmp_path))


def run(log, name):
    log.spark.range(3).write.parquet(f"{log.run_path(name)}/kpi/t")
    return name


def test_a_release_names_its_tables_and_how_they_are_dealt(log):
    tables = {"kpi/t": None, "kpi/u": Buckets("id", 4)}
    run(log, "a")
    with pytest.raises(FileNotFoundError, match="kpi/u"):
        log.release("a", tables=tables)
    assert log.latest() is None
    log.spark.range(1).write.parquet(f"{log.run_path('a')}/kpi/u")
    log.release("a", "mind the gap", 0, tables)
    assert log.newest().tables == tables and log.note("a") == "mind the gap" and log.newest().number == 1
    assert log.read_kpi("t").count() == 3
    with pytest.raises(ValueError, match="released"):
        log.release("a")


@pytest.mark.parametrize("attempt", range(3))
def test_of_runs_that_publish_at_once_one_wins(log, attempt):
    def release(name):
        try:
            log.release(name, after=0)
            return name
        except StaleCommit:
            return None

    with ThreadPoolExecutor(6) as pool:
        won = [w for w in pool.map(release, [f"r{i}" for i in range(6)]) if w]
    assert len(won) == 1 and [r.run_id for r in log.releases()] == won
    # Whoever starts from the new release goes on from there.
    log.release("next", after=log.newest().number)
    assert log.latest() == "next"


def test_expiry_keeps_the_newest_releases_and_what_is_being_written(log):
    for name in ("a", "b", "c"):
        log.release(run(log, name))
    run(log, "blocked")
    time.sleep(1.1)
    limit = datetime.now(UTC)
    time.sleep(1.1)
    run(log, "going on")
    assert sorted(log.expire(2, limit)) == ["a", "blocked"]
    assert {p.name for p in Path(log.run_path("")).iterdir()} == {"b", "c", "going on"}
    assert [r.run_id for r in log.releases()] == ["b", "c"]
    # A run that has been expired cannot come back; one that is going on can be released.
    with pytest.raises(ValueError, match="expired"):
        log.release("blocked")
    log.release("going on", after=3)
    assert log.expire(3, limit + timedelta(days=1)) == []
    with pytest.raises(ValueError):
        log.expire(0)


def test_expiry_does_not_make_a_run_stale(log):
    for name in ("a", "b"):
        log.release(run(log, name))
    started_from = log.newest().number
    log.expire(1)
    log.release("c", after=started_from)
    assert [(r.run_id, r.number) for r in log.releases()] == [("b", 2), ("c", 3)]


def test_a_file_that_was_lost_half_way_is_passed_over(log):
    log.release("a")
    lost = Path(log.path, "v000000002.txt")
    lost.write_text('{"releases": [], "go')
    os.utime(lost, (0, 0))
    assert log.latest() == "a"
    log.release("b", after=1)
    assert [r.run_id for r in log.releases()] == ["a", "b"]
    assert VersionFiles(log.spark, log.path).numbers() == [3, 2, 1]


def test_a_version_is_created_once(spark, tmp_path):
    files = VersionFiles(spark, str(tmp_path / "versions"))
    assert files.newest() == (0, None)
    files.create(1, "x\nend\ny")
    assert files.newest() == (1, "x\nend\ny")
    with pytest.raises(StaleCommit):
        files.create(1, "z")


def test_a_writer_waits_for_a_file_that_is_being_written(spark, tmp_path):
    files = VersionFiles(spark, str(tmp_path), grace=60)
    files.create(1, "one")
    slow = tmp_path / "v000000002.txt"
    slow.write_text("tw")
    assert files.newest() == (2, "one")
    with ThreadPoolExecutor(1) as pool:
        waiting = pool.submit(files.newest, True)
        time.sleep(1)
        assert not waiting.done()
        slow.write_text("two\nend")
        assert waiting.result(timeout=30) == (2, "two")
