"""Keyed de-duplication with a deterministic winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def desc_last(col: str) -> Column:
    return F.col(col).desc_nulls_last()


def asc_last(col: str) -> Column:
    """Ascending with NULLs at the end; Spark's own default puts them first."""
    return F.col(col).asc_nulls_last()


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order_by``.

    The rank filter lets Spark push a group limit below the shuffle: each map task keeps at most
    one row per key, so a key with any number of copies never piles up in one reducer. Columns
    that nobody reads later are pruned down to the scan.
    """
    rank = "__rank"
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)
