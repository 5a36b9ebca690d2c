"""Small helpers to state fixtures and read results."""

from __future__ import annotations


def frame(spark, schema: str, *rows):
    return spark.createDataFrame(list(rows), schema)


def by(df, key: str) -> dict:
    return {row[key]: row for row in df.collect()}


def bag(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)
