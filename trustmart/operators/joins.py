"""Joins of a large table to a table that is unique on the join key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mirrored(col: str) -> Column:
    return F.reverse(F.col(col).cast("string"))


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, how: str = "left") -> DataFrame:
    """Joins ``df`` on ``key`` to ``table``, which is unique on ``table_key``; drops ``table_key``.

    ``key`` may be as skewed as it likes. Spark splits a hot partition at run time only where both
    inputs of the join come straight from a shuffle for it; a table that was just de-duplicated or
    aggregated on the key keeps that partitioning and gets none. Joining on the mirrored key
    gives each side its own shuffle, so a hot key is spread over many tasks. Small tables are broadcast
    by their measured size as usual.
    """
    joined = df.join(table, _mirrored(key) == _mirrored(table_key), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(table_key)


def with_orders(df: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows of ``df``, summed to a few per order, with the columns of their order.

    ``orders`` is unique on ``__order``, which is dropped. On the plain key a table that is
    partitioned by order already stays where it is.
    """
    return df.join(orders, F.col("order_id") == F.col("__order"), "inner").drop("__order")
