import datetime as dt

import pytest
from conftest import bag
from pyspark.sql import functions as F

from cartledger.operators import cleaning


def test_names_are_lowered_trimmed_and_joined(spark):
    df = spark.range(1).select(F.lit(1).alias(" Order  ID "), F.lit(2).alias("STATUS"))
    assert cleaning.clean_names(df).columns == ["order__id", "status"]


def test_colliding_names_are_refused(spark):
    df = spark.range(1).select(F.lit(1).alias("A b"), F.lit(2).alias("a_b"))
    with pytest.raises(ValueError, match="a_b"):
        cleaning.clean_names(df)


def test_bad_dates_become_null_and_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("2023-01-02",), ("2023-01-02 03:04:05",), ("bad",), (None,)], "d string")
    got = [r.d for r in cleaning.parse_dates(df, ["d", "other"]).collect()]
    assert got == [dt.datetime(2023, 1, 2), dt.datetime(2023, 1, 2, 3, 4, 5), None, None]


GAPPY = [
    (1, 10.0, "b", 5),
    (2, None, "a", None),
    (3, 30.0, None, 7),
    (4, float("nan"), "b", 5),
    (5, 20.0, "a", 7),
]
GAPPY_SCHEMA = "k int, x double, s string, n bigint"


def test_drop_nulls(spark):
    df = spark.createDataFrame(GAPPY, GAPPY_SCHEMA)
    assert [r.k for r in cleaning.drop_nulls(df).collect()] == [1, 5]
    assert [r.k for r in cleaning.drop_nulls(df, ["s"]).collect()] == [1, 2, 4, 5]


def test_fill_zero_leaves_text_unless_asked(spark):
    df = spark.createDataFrame(GAPPY, GAPPY_SCHEMA)
    assert [tuple(r)[1:] for r in cleaning.fill_zero(df).collect()] == [
        (10.0, "b", 5), (0.0, "a", 0), (30.0, None, 7), (0.0, "b", 5), (20.0, "a", 7),
    ]
    assert cleaning.fill_zero(df, ["s"], include_text=True).collect()[2].s == "0"


def test_fill_mean_skips_whole_numbers_and_text(spark):
    df = spark.createDataFrame([*GAPPY, (None, None, None, None)], GAPPY_SCHEMA)
    last = cleaning.fill_mean(df).collect()[-1]
    assert tuple(last) == (None, 20.0, None, None)
    assert cleaning.fill_mean(df, ["n"]).collect()[-1].n == 6.0
    assert cleaning.fill_mean(df, ["k"]).collect()[-1].k == 3.0


def test_fill_mode_breaks_ties_by_the_smallest_value(spark):
    df = spark.createDataFrame(GAPPY, GAPPY_SCHEMA)
    filled = cleaning.fill_mode(df, ["s", "n", "x"]).collect()
    assert [r.s for r in filled] == ["b", "a", "a", "b", "a"]
    assert [r.n for r in filled] == [5, 5, 7, 5, 7]
    assert [r.x for r in filled] == [10.0, 10.0, 30.0, 10.0, 20.0]


def test_fill_mode_of_an_empty_column_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, s string")
    assert [r.s for r in cleaning.fill_mode(df, ["s"]).collect()] == [None, None]


def test_fill_mode_of_many_columns(spark):
    columns = [f"c{i:02}" for i in range(40)]
    rows = [[i] * 40 for i in (1, 2, 2)] + [[None] * 40]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in columns))
    assert set(cleaning.fill_mode(df).collect()[-1]) == {2}


def test_strategies_by_name(spark):
    df = spark.createDataFrame(GAPPY, GAPPY_SCHEMA)
    assert cleaning.handle_missing(df).count() == 2
    assert cleaning.handle_missing(df, "fill_zero", ["n"]).collect()[1].n == 0
    assert cleaning.handle_missing(df, "fill_mean", ["n"]).collect()[1].n == 6.0
    assert cleaning.handle_missing(df, "fill_mode", ["n"]).collect()[1].n == 5
    with pytest.raises(ValueError):
        cleaning.handle_missing(df, "interpolate")


def test_whole_row_copies_go(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None)], "k int, s string")
    once = cleaning.drop_duplicate_rows(df)
    assert bag(once) == [(1, None), (1, "a")]
    assert bag(cleaning.drop_duplicate_rows(once)) == bag(once)


def test_keyed_copies_keep_the_first_and_null_keys_are_equal(spark):
    rows = [(1, "b", 2), (1, "a", 3), (None, "z", 1), (None, "y", 0), (2, "c", 9)]
    df = spark.createDataFrame(rows, "k int, s string, at int")
    least = cleaning.drop_duplicate_keys(df, ["k"])
    assert bag(least) == [(None, "y", 0), (1, "a", 3), (2, "c", 9)]
    earliest = cleaning.drop_duplicate_keys(df, ["k"], ["at"])
    assert bag(earliest) == [(None, "y", 0), (1, "b", 2), (2, "c", 9)]
    assert bag(cleaning.drop_duplicate_keys(least, ["k"])) == bag(least)


def test_keyed_copies_of_key_only_table(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert bag(cleaning.drop_duplicate_keys(df, ["k"])) == [(1,), (2,)]


def test_whole_numbers_keep_their_value_unless_named(spark):
    df = spark.createDataFrame([(9007199254740993, 1.0), (None, None)], "n long, x double")
    assert bag(cleaning.fill_mean(df), "n", "x") == [(None, 1.0), (9007199254740993, 1.0)]
    assert cleaning.fill_mean(df, ["n"]).schema["n"].dataType.simpleString() == "double"


def test_a_column_named_like_the_helper_stays(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 7, "a")], "k int, _copy int, x string")
    assert bag(cleaning.drop_duplicate_keys(df, ["k"])) == [(1, 5, "b")]


DATES = {
    "01/05/2023 10:00 PM": dt.datetime(2023, 1, 5, 22),
    "12/31/2023 12:30:05 a.m.": dt.datetime(2023, 12, 31, 0, 30, 5),
    "05-Jan-2023": dt.datetime(2023, 1, 5),
    "1/5/23": dt.datetime(2023, 1, 5),
    "1/5/69": dt.datetime(1969, 1, 5),
    "20230105103000": dt.datetime(2023, 1, 5, 10, 30),
    "20230105T1030": dt.datetime(2023, 1, 5, 10, 30),
    "Thu, 05 Jan 2023 10:00:00": dt.datetime(2023, 1, 5, 10),
    "Thursday, January 5, 2023": dt.datetime(2023, 1, 5),
    "5 Sept 2023": dt.datetime(2023, 9, 5),
    "2023-01-05T10:00:00+02:00": dt.datetime(2023, 1, 5, 8),
    "2023-01-05 23:00-0130": dt.datetime(2023, 1, 6, 0, 30),
    "2023-01-05T10:00:00.25Z": dt.datetime(2023, 1, 5, 10, 0, 0, 250000),
    "2023-01": dt.datetime(2023, 1, 1),
    "Marble 5, 2023": None,
    "5 Junk 2023": None,
    "13/13/2023": None,
    "01/05/2023 13:00 PM": None,
    "2023-02-30": None,
    "20231301": None,
    "": None,
}


def test_forms_of_dates(spark):
    df = spark.createDataFrame([(t,) for t in DATES], "d string")
    assert dict(zip(DATES, [r.d for r in cleaning.parse_dates(df, ["d"]).collect()])) == DATES


def test_offsets_may_be_rejected(spark):
    df = spark.createDataFrame([("2023-01-05T10:00:00+02:00",), ("2023-01-05T10:00:00",)], "d string")
    got = [r.d for r in cleaning.parse_dates_by_column(df, ["d"], offsets="reject").collect()]
    assert got == [None, dt.datetime(2023, 1, 5, 10)]
    assert cleaning.date_formats(df, ["d"], offsets="reject").first().misfits == 1


def test_the_column_decides_what_comes_first(spark):
    rows = [("05/01/2023", "05/01/2023", None, "x"), ("30/01/2023", "01/30/2023", None, "y"), ("06/01/2023", "2023-01-06", None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    got = cleaning.parse_dates_by_column(df, ["a", "b", "c", "d", "none"]).collect()
    assert [r.a for r in got] == [dt.datetime(2023, 1, n) for n in (5, 30, 6)]
    assert [r.b for r in got] == [dt.datetime(2023, 5, 1), dt.datetime(2023, 1, 30), None]
    assert {r.c for r in got} == {r.d for r in got} == {None}
    assert bag(cleaning.date_formats(df, ["a", "b", "c", "d"])) == [
        ("a", "day_first", 3, 3, 0), ("b", "month_first", 3, 2, 1), ("c", None, 0, 0, 0), ("d", None, 2, 0, 2),
    ]
    assert cleaning.date_formats(df.limit(0), ["a"]).first().form is None
