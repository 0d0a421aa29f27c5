"""Rounding, means and time differences, against values written out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartledger.functions import (
    days_between,
    exact_mean,
    mean_days,
    month_start,
    parse_timestamp,
    r2,
    whole_days,
)


def one(spark, sql, column):
    return spark.sql(f"SELECT {sql}").select(column).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [("2.345", 2.35), ("2.3449", 2.34), ("1.005", 1.01), ("-2.345", -2.35), ("NULL", None)],
)
def test_r2_rounds_half_up(spark, value, expected):
    assert one(spark, f"CAST({value} AS DECIMAL(18,6)) AS x", r2("x")) == expected


def test_r2_of_a_double(spark):
    assert one(spark, "1.005D AS x", r2("x")) == 1.01


def test_exact_mean_of_nothing_is_null(spark):
    df = spark.sql("SELECT CAST(NULL AS DECIMAL(18,2)) AS x")
    assert df.agg(exact_mean(F.sum("x"), F.count("x"))).first()[0] is None


@pytest.mark.parametrize(
    "later, earlier, whole, fraction",
    [
        ("2024-01-02 01:00:00", "2024-01-01 23:00:00", 0, 2 / 24),
        ("2024-01-01 23:00:00", "2024-01-02 00:00:00", -1, -1 / 24),
        ("2024-01-03 00:00:00", "2024-01-01 00:00:00", 2, 2.0),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_days_are_floored(spark, later, earlier, whole, fraction, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(f"SELECT timestamp_ntz'{later}' AS a, timestamp_ntz'{earlier}' AS b")
        row = df.select(whole_days("a", "b"), days_between("a", "b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row[0] == whole
    assert row[1] == pytest.approx(fraction)


def test_a_day_across_a_clock_change_has_24_hours(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "SELECT timestamp_ntz'2024-03-11 00:00:00' AS a, timestamp_ntz'2024-03-10 00:00:00' AS b"
        )
        assert df.select(days_between("a", "b")).first()[0] == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_month_start_and_month_step(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-12-31 23:59:59' AS t").select(
        month_start("t").alias("m")
    )
    assert df.schema["m"].dataType.simpleString() == "timestamp_ntz"
    step = df.select("m", F.col("m") + F.make_ym_interval(F.lit(0), F.lit(2))).first()
    assert tuple(step) == (dt.datetime(2024, 12, 1), dt.datetime(2025, 2, 1))


def test_days_do_not_depend_on_the_session_zone(spark):
    """Midnight of 2017-10-15 did not exist in this zone."""
    rows = spark.createDataFrame(
        [("2017-10-15 00:30:00", "2017-10-16 00:45:00")], "a string, b string"
    ).select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = rows.select(whole_days("b", "a"), days_between("b", "a"), parse_timestamp(F.lit("15/10/2017 00:30"))).first()
        mean = rows.agg(mean_days("b", "a")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == 1
    assert got[1] == mean == pytest.approx(87300 / 86400)
    assert got[2] == dt.datetime(2017, 10, 15, 0, 30)


@pytest.mark.parametrize(
    "text, value",
    [
        ("2023-01-05", dt.datetime(2023, 1, 5)),
        ("2023-01-05T10:00:01.5", dt.datetime(2023, 1, 5, 10, 0, 1, 500000)),
        ("2023/01/06", dt.datetime(2023, 1, 6)),
        ("05/01/2023 10:00", dt.datetime(2023, 5, 1, 10)),
        ("25/01/2023", dt.datetime(2023, 1, 25)),
        ("20230105", dt.datetime(2023, 1, 5)),
        ("Jan 5, 2023", dt.datetime(2023, 1, 5)),
        ("5 January 2023 9:05", dt.datetime(2023, 1, 5, 9, 5)),
        ("2023-13-45", None),
        ("99/99/2020", None),
        ("Foo 5, 2023", None),
        ("", None),
        (None, None),
    ],
)
def test_forms_of_dates(spark, text, value):
    row = spark.createDataFrame([(text,)], "t string").select(parse_timestamp(F.col("t"))).first()
    assert row[0] == value
