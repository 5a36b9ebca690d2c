"""Cleansing expressions shared by every staging table.

All of them are built-in Column expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money is exact: up to 18 digits fits in a long, and sums do not depend on how rows are split
# over tasks. Published figures are cast to double at the edge (see ``as_reported``).
MONEY = T.DecimalType(16, 4)
COORDINATE = T.DecimalType(24, 14)

# Fixed value: the only accepted timestamp text, "YYYY-MM-DD HH:MM:SS" (parts may lack padding).
TIMESTAMP_SHAPE = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s\d{1,2}:\d{1,2}:\d{1,2}\s*$"


def _column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text(col: str | Column) -> Column:
    return _column(col).cast("string")


def parse_ts(col: str | Column) -> Column:
    """Timestamp without zone, NULL for anything that is not a full, valid date and time.

    The value is cast straight to ``timestamp_ntz``, so the session time zone (and its daylight
    saving gaps) never shifts it. The shape test rejects what a plain cast would let through:
    date-only text, fractions, zone suffixes. It costs less than printing the value to compare texts.
    """
    raw = text(col)
    return F.when(raw.rlike(TIMESTAMP_SHAPE), raw.try_cast("timestamp_ntz"))


def norm_lower(col: str | Column) -> Column:
    return F.lower(F.trim(text(col)))


def norm_upper(col: str | Column) -> Column:
    return F.upper(F.trim(text(col)))


def zip5(col: str | Column) -> Column:
    """Zip prefix of exactly five characters: zero-padded on the left, cut on the right."""
    return F.lpad(text(col), 5, "0")


def blank_to_null(col: str | Column) -> Column:
    return F.nullif(F.trim(text(col)), F.lit(""))


def typed(col: str | Column, data_type: str | T.DataType) -> Column:
    """Strict cast: malformed input fails the job (ANSI mode, the Spark 4 default)."""
    return _column(col).cast(data_type)


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Whole calendar days from ``start`` to ``end``; the time of day is ignored."""
    return F.datediff(_column(end).cast("date"), _column(start).cast("date")).cast("bigint")


def month_diff(start: str | Column, end: str | Column) -> Column:
    """Number of month boundaries between two dates."""
    def months(c: Column) -> Column:
        return F.year(c) * 12 + F.month(c)

    return (months(_column(end)) - months(_column(start))).cast("bigint")


def period_start(col: str | Column, unit: str) -> Column:
    """First day of the month, ISO week, quarter or year that holds ``col``."""
    return F.trunc(_column(col).cast("date"), unit)
