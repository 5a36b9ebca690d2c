from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.rows import bag, frame
from trustmart.functions.clean import (
    blank_to_null,
    day_diff,
    month_diff,
    norm_lower,
    norm_upper,
    parse_ts,
    period_start,
    typed,
    zip5,
)


def one(spark, schema, value, expression):
    return frame(spark, schema, (value,)).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2017-01-02 03:04:05", datetime(2017, 1, 2, 3, 4, 5)),
        ("2017-1-2 3:4:5", datetime(2017, 1, 2, 3, 4, 5)),
        (" 2017-01-02 03:04:05 ", datetime(2017, 1, 2, 3, 4, 5)),
        ("2017-13-01 00:00:00", None),
        ("2017-02-30 00:00:00", None),
        ("2017-01-02 24:00:00", None),
        ("2017-01-02", None),
        ("2017-01-02T03:04:05", None),
        ("2017-01-02 03:04:05.123", None),
        ("2017-01-02 03:04:05Z", None),
        ("2017-01-02 03:04", None),
        ("12017-1-2 03:04:05", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_ts(spark, raw, expected):
    assert one(spark, "v string", raw, parse_ts("v")) == expected


def test_parse_ts_ignores_daylight_saving_of_the_session(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # 00:30 did not exist there on that day.
        value = one(spark, "v string", "2017-10-15 00:30:00", parse_ts("v").cast("string"))
        month = one(spark, "v string", "2017-10-15 00:30:00", period_start(parse_ts("v"), "month"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert value == "2017-10-15 00:30:00"
    assert str(month) == "2017-10-01"


@pytest.mark.parametrize(
    ("raw", "expected"), [("7", "00007"), ("01234", "01234"), ("123456", "12345"), (None, None)]
)
def test_zip5(spark, raw, expected):
    assert one(spark, "v string", raw, zip5("v")) == expected


def test_blank_to_null(spark):
    values = frame(spark, "v string", ("   ",), ("",), (" a ",), ("\t",), (None,))
    assert [r[0] for r in values.select(blank_to_null("v")).collect()] == [
        None,
        None,
        "a",
        "\t",
        None,
    ]


def test_normalisation(spark):
    assert one(spark, "v string", "  CanCeled ", norm_lower("v")) == "canceled"
    assert one(spark, "v string", " sp ", norm_upper("v")) == "SP"


def test_typed_fails_on_bad_input(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame(spark, "v string", ("abc",)).select(typed("v", "decimal(16,4)")).collect()


def test_day_diff_ignores_the_time_of_day(spark):
    df = frame(
        spark, "a timestamp_ntz, b timestamp_ntz", (datetime(2020, 1, 1, 23), datetime(2020, 1, 2, 1))
    )
    assert bag(df.select(day_diff("a", "b"))) == [(1,)]


def test_month_diff_counts_boundaries(spark):
    days = spark.sql(
        "SELECT * FROM VALUES (date'2020-01-31', date'2020-03-01'),"
        " (date'2019-11-01', date'2020-01-01') AS t(a, b)"
    )
    assert bag(days.select(month_diff("a", "b"))) == [(2,), (2,)]


def test_week_starts_on_monday(spark):
    start = period_start(F.lit("2017-01-01"), "week")
    assert str(spark.range(1).select(start.alias("w")).first()["w"]) == "2016-12-26"
