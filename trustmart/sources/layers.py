"""Layered storage, report sinks and the publication log."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from trustmart.sources.versions import StaleCommit, VersionFiles

RAW, STAGING, MARTS, KPI = "raw", "staging", "marts", "kpi"
CONTRACTS, PAGES, MONITORS = "contracts", "pages", "monitors"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="trustmart-")


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor sees: the one the cluster names in ``spark.checkpoint.dir``.

    Only where nothing is named and driver and executors are one process, as in tests, it is a local
    folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (named or _local_folder()).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new shared folder, which goes when the driver ends, and read back."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@dataclass(frozen=True)
class Buckets:
    """How a stored table is dealt out: by hash of ``key`` into ``count`` sorted files."""

    key: str
    count: int


def observed(df: DataFrame, name: str, metrics: Sequence[Column]) -> tuple[DataFrame, Observation]:
    """``df`` whose next action also works out ``metrics`` (aggregates), without another pass.

    Spark counts each task of an action's last stage once, however often it is run, so write the
    returned frame as it is: a shuffle behind this point could count rows of a repeated task twice.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    return df.observe(seen, *metrics), seen


def observed_row(spark: SparkSession, seen: Observation, schema: StructType) -> DataFrame:
    """The observed metrics as a frame of one row; the values have reached the driver."""
    found = seen.get
    return spark.createDataFrame([tuple(found[f.name] for f in schema)], schema)


def written_observed(df: DataFrame, name: str, metrics: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """``written`` and, from the same pass, the metrics as a frame of one row."""
    schema = df.agg(*metrics).schema
    watched, seen = observed(df, name, metrics)
    return written(watched, name), observed_row(df.sparkSession, seen, schema)


@dataclass(frozen=True)
class Layers:
    """Databases ``<prefix>raw``, ``<prefix>staging`` ... whose tables lie under one root folder."""

    spark: SparkSession
    root: str
    prefix: str = "trustmart_"

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def create(self, layers: Sequence[str] = (RAW, STAGING, MARTS, KPI)) -> Layers:
        for layer in layers:
            location = f"{self.root.rstrip('/')}/{layer}"
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} LOCATION '{location}'"
            )
        return self

    def materialize(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Replace a table by ``df``, name it in the catalogue and return the stored table."""
        stored = self.write(layer, name, df)
        self.register(layer, name)
        return stored

    def write(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Replace the files of a table by ``df``; the catalogue stays as it is.

        No extra shuffle: adaptive execution already sizes the partitions of the last stage.
        """
        df.write.mode("overwrite").parquet(self.path(layer, name))
        return self.read(layer, name)

    def write_bucketed(self, layer: str, name: str, df: DataFrame, buckets: Buckets) -> DataFrame:
        """Replace a table by ``df``, dealt into buckets that joins and groups by ``key`` read without
        a shuffle; the public name stays as it is.

        ``df`` should come with :func:`dealt`, one task a bucket. Spark learns the buckets of a table
        from its entry in the catalogue, so the table has a working name until its plan is made.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}work")
        table = f"{self.prefix}work.{layer}_{name}_{uuid.uuid4().hex[:12]}"
        # Keys and exact amounts hardly repeat: a dictionary of them is filled only to be given up.
        plain = [f.name for f in df.schema if f.name == buckets.key or isinstance(f.dataType, DecimalType)]
        (
            df.write.mode("overwrite")
            .format("parquet")
            .option("path", self.path(layer, name))
            .options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain})
            .bucketBy(buckets.count, buckets.key)
            .sortBy(buckets.key)
            .saveAsTable(table)
        )
        stored = self.spark.table(table)
        # An external table: its files stay, and the plan over them keeps the buckets.
        self.spark.sql(f"DROP TABLE {table}")
        return stored

    def register(self, layer: str, name: str, buckets: Buckets | None = None) -> None:
        """Let the table's name in the catalogue stand for the files of this root."""
        table = f"{self.database(layer)}.{name}"
        # An external table: dropping the name leaves the files of the former run alone.
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        if buckets is None:
            self.spark.catalog.createTable(table, path=self.path(layer, name), source="parquet")
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.read(layer, name).schema)
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{buckets.key}`)"
            f" SORTED BY (`{buckets.key}`) INTO {buckets.count} BUCKETS LOCATION '{self.path(layer, name)}'"
        )

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))


def dealt(df: DataFrame, buckets: Buckets) -> DataFrame:
    """``df`` in one task for each bucket."""
    return df.repartition(buckets.count, buckets.key)


def largest_group(df: DataFrame, key: str) -> int:
    """Rows of the most frequent key; counted before they are shuffled. One number reaches the driver."""
    most = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"]
    return most or 0


def overfull(frames: Sequence[DataFrame], key: str, parts: int) -> int:
    """Rows above the mean in the fullest of ``parts`` tasks that ``key`` is hashed into: what a hot key
    adds to the frame it is hottest in.

    Counted before anything is shuffled, all frames in one job; one number reaches the driver.
    """
    part = F.pmod(F.hash(F.col(key).cast("string")), F.lit(parts)).alias("part")
    # Each frame is counted by itself: frames with the same ids have the same plan, which Spark runs once.
    rows = [df.select(part).groupBy("part").agg(F.count(F.lit(1)).alias("n")) for df in frames]
    extra = [n.agg((F.max("n") - F.sum("n") / parts).alias("extra")) for n in rows]
    return int(reduce(DataFrame.unionByName, extra).agg(F.max("extra").alias("extra")).first()["extra"] or 0)


def export(
    df: DataFrame, path: str, fmt: str = "parquet", order_by: Sequence[Column] = ()
) -> None:
    """Write a report, replacing what was there. CSV gets a header; the sink is where rows sort."""
    if order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown report format: {fmt}")


def require_single_row(df: DataFrame) -> DataFrame:
    """``df`` itself, or a failed job if it does not hold exactly one row. Looks at two rows only."""
    rows = df.limit(2).agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
    row = F.when(F.size("rows") == 1, F.col("rows")[0]).otherwise(
        F.raise_error(F.lit("expected exactly one row"))
    )
    return rows.select(row.alias("row")).select("row.*")


@dataclass(frozen=True)
class Release:
    """A released run, the tables it consists of by ``layer/name``, and how these are dealt out."""

    run_id: str
    number: int
    published_at: str
    note: str | None
    tables: Mapping[str, Buckets | None]

    def as_dict(self) -> dict:
        dealt_out = {t: b and [b.key, b.count] for t, b in self.tables.items()}
        return {**vars(self), "tables": dealt_out}

    @classmethod
    def of(cls, entry: dict) -> Release:
        return cls(**{**entry, "tables": {t: b and Buckets(*b) for t, b in entry["tables"].items()}})


@dataclass(frozen=True)
class PublicationLog:
    """Releases under one root: readers follow the newest.

    The log is a list of small files, each of which holds all releases that are kept and is created by
    one writer only. A run becomes visible by one such file after everything else is written, so a job
    that dies half-way leaves the previous release in place, and of two runs that have started from
    the same release only one is released.
    """

    spark: SparkSession
    root: str

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/published"

    def run_path(self, run_id: str) -> str:
        return f"{self.root.rstrip('/')}/runs/{run_id}"

    def _state(self, to_write: bool = False) -> tuple[int, list[Release], list[str]]:
        """Newest version, releases kept, oldest first, and runs that have been expired."""
        version, text = VersionFiles(self.spark, self.path).newest(to_write)
        state = json.loads(text) if text else {"releases": [], "gone": []}
        return version, [Release.of(r) for r in state["releases"]], state["gone"]

    def _commit(self, change: Callable[[list[Release], list[str]], tuple[list[Release], list[str]]]) -> None:
        """Puts the changed state after the newest one; ``change`` is asked again if somebody else has
        been faster, and raises where the change is not possible any more."""
        while True:
            version, releases, gone = self._state(to_write=True)
            kept, expired = change(releases, gone)
            text = json.dumps({"releases": [r.as_dict() for r in kept], "gone": expired})
            try:
                return VersionFiles(self.spark, self.path).create(version + 1, text)
            except StaleCommit:
                continue

    def release(
        self,
        run_id: str,
        note: str | None = None,
        after: int | None = None,
        tables: Mapping[str, Buckets | None] | None = None,
    ) -> None:
        """Makes a run the newest one. ``note`` says what its readers should be warned of.

        With ``after``, the number of the release that the run has started from, raises ``StaleCommit``
        if another run has been released since. ``tables`` names what the run consists of; a table that
        is not there fails the release.
        """
        for table in tables or ():
            fs, folder = self._folder(f"{self.run_path(run_id)}/{table}")
            if not fs.exists(folder):
                raise FileNotFoundError(f"run {run_id} has no {table}")
        now = datetime.now(UTC).isoformat(timespec="microseconds")

        def added(releases: list[Release], gone: list[str]) -> tuple[list[Release], list[str]]:
            number = releases[-1].number if releases else 0
            if after is not None and number != after:
                raise StaleCommit(f"run {run_id} has started from release {after}, the newest is {number}")
            if run_id in gone or any(r.run_id == run_id for r in releases):
                raise ValueError(f"run {run_id} has been released or expired")
            return [*releases, Release(run_id, number + 1, now, note, dict(tables or {}))], gone

        self._commit(added)

    def expire(self, keep: int, unfinished_before: datetime | None = None) -> list[str]:
        """Removes the files of all releases but the newest ``keep``, and of runs that were blocked or
        lost: not released, nothing written since ``unfinished_before``. Returns the runs removed.

        What goes is first struck off the log; a run that is being released meanwhile is either kept or
        fails its release. Readers of a release that goes lose its files.
        """
        if keep < 1:
            raise ValueError("the newest release stays")
        found = self._unfinished(unfinished_before) if unfinished_before else []
        going: list[str] = []

        def struck(releases: list[Release], gone: list[str]) -> tuple[list[Release], list[str]]:
            kept = releases[-keep:]
            stays = {r.run_id for r in releases}
            going[:] = [r.run_id for r in releases[:-keep]] + [run for run in found if run not in stays]
            return kept, [*gone, *(run for run in going if run not in gone)]

        self._commit(struck)
        for run in going:
            fs, folder = self._folder(self.run_path(run))
            fs.delete(folder, True)
        return going

    def _folder(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _unfinished(self, before: datetime) -> list[str]:
        """Runs in the runs' folder that have no file written at ``before`` or later."""
        fs, folder = self._folder(self.run_path(""))
        if not fs.exists(folder):
            return []
        limit = before.timestamp() * 1000

        def newest(path) -> int:
            files, last = fs.listFiles(path, True), 0
            while files.hasNext():
                last = max(last, files.next().getModificationTime())
            return last

        runs = [f for f in fs.listStatus(folder) if f.isDirectory()]
        return [r.getPath().getName() for r in runs if max(newest(r.getPath()), r.getModificationTime()) < limit]

    def releases(self) -> list[Release]:
        """All releases that are kept, oldest first."""
        return self._state()[1]

    def newest(self) -> Release | None:
        releases = self.releases()
        return releases[-1] if releases else None

    def is_released(self, run_id: str) -> bool:
        return any(r.run_id == run_id for r in self.releases())

    def latest(self) -> str | None:
        """Run id of the newest release."""
        newest = self.newest()
        return newest and newest.run_id

    def note(self, run_id: str) -> str | None:
        """The note a run was released with."""
        return next((r.note for r in self.releases() if r.run_id == run_id), None)

    def name_tables(self, prefix: str) -> None:
        """Lets the names in the catalogue stand for the newest release, whichever run that is by now."""
        newest = self.newest()
        if newest is None:
            return
        layers = Layers(self.spark, self.run_path(newest.run_id), prefix)
        for table, buckets in newest.tables.items():
            layer, _, name = table.partition("/")
            if layer in (RAW, STAGING, MARTS):
                layers.register(layer, name, buckets)

    def read_kpi(self, name: str) -> DataFrame:
        """A KPI table of the newest released run."""
        return self.read(KPI, name)

    def read(self, layer: str, name: str) -> DataFrame:
        """A table of the newest released run, from any of its layers."""
        run_id = self.latest()
        if run_id is None:
            raise LookupError("nothing has been published yet")
        return self.spark.read.parquet(f"{self.run_path(run_id)}/{layer}/{name}")
