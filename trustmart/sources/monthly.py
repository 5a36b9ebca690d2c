"""Order facts in a folder for each purchase month."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MONTH = "purchase_month"


def month_of(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM")


class MonthlyFacts:
    """Facts under one root, a folder for each month of ``ts``; rows without ``ts`` have one, too.

    A date slicer reads the months it asks for only. When orders have changed, the months that they
    are or were in are written anew, in place of these months' folders; other files are left alone.
    A month without rows any more loses its folder. Rows of a month are dealt to as many tasks as
    their size asks for, so a month that holds most of the orders is no single task.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, ts: str = "order_purchase_ts"):
        self.spark, self.root, self.ts = spark, root.rstrip("/"), ts
        self.schema = StructType([f for f in schema if f.name != MONTH] + [StructField(MONTH, StringType())])

    def _path(self, *parts: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _all(self) -> DataFrame:
        fs, root = self._path()
        if not fs.exists(root):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.root)

    def read(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """Facts of the months from that of ``first`` to that of ``last``; of all months, and those
        without one, if neither is given."""
        rows = self._all()
        if first is not None:
            rows = rows.filter(F.col(MONTH) >= f"{first:%Y-%m}")
        if last is not None:
            rows = rows.filter(F.col(MONTH) <= f"{last:%Y-%m}")
        return rows.drop(MONTH)

    def _write(self, facts: DataFrame) -> None:
        dated = facts.withColumn(MONTH, month_of(self.ts)).select(*self.schema.names)
        (
            dated.hint("rebalance", MONTH)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH)
            .parquet(self.root)
        )

    def _within(self, month: Column, months: Iterable[str | None]) -> Column:
        months = list(months)
        named = month.isin(*[m for m in months if m is not None])
        return F.coalesce(named, F.lit(False)) | (month.isNull() if None in months else F.lit(False))

    def replace(self, facts: DataFrame, months: Iterable[str | None]) -> None:
        """Writes ``months`` ('yyyy-MM', None for rows without one) anew from ``facts``, which holds
        all rows of these months, at least."""
        months = set(months)
        if not months:
            return
        self._write(facts.filter(self._within(month_of(self.ts), months)))
        # Writing leaves folders alone for which there are no rows. One name a month reaches the driver.
        found = facts.select(month_of(self.ts).alias("m")).distinct().collect()
        for month in months - {r["m"] for r in found}:
            fs, folder = self._path(f"{MONTH}={month or '__HIVE_DEFAULT_PARTITION__'}")
            fs.delete(folder, True)

    def create(self, facts: DataFrame) -> None:
        """Writes all months of ``facts``, and none else."""
        known = self._all().select(MONTH).distinct().collect()
        found = facts.select(month_of(self.ts).alias(MONTH)).distinct().collect()
        self.replace(facts, {r[MONTH] for r in [*known, *found]})

    def refresh(self, facts: DataFrame, changed: DataFrame, key: str = "order_id") -> set[str | None]:
        """Writes the months anew that the keys in ``changed`` are in by ``facts`` or were in before;
        returns them. ``facts`` are the complete new facts; of them, the months concerned are read."""
        keys = changed.select(key).distinct()
        now = facts.join(keys, key, "left_semi").select(month_of(self.ts).alias("m"))
        before = self._all().join(keys, key, "left_semi").select(F.col(MONTH).alias("m"))
        # One name a month reaches the driver.
        months = {r["m"] for r in now.union(before).distinct().collect()}
        self.replace(facts, months)
        return months
