"""Derivations, joins, totals and marts on small written-out tables."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import bag
from pyspark.sql import functions as F

from cartledger.operators import aggregates, derive, joins
from cartledger.plans import marts
from cartledger.sources.readers import FILE_POSITION


def test_order_columns_skip_what_is_absent(spark):
    df = spark.createDataFrame(
        [
            ("1", "2023-01-01", "2023-01-05"),
            ("2", "2023-01-02", "2023-01-06"),
            ("3", "2023-01-03", None),
        ],
        "order_id string, order_purchase_timestamp string, order_delivered_customer_date string",
    )
    out = derive.order_columns(df).orderBy("order_id")
    assert "delivery_delay_days" not in out.columns
    rows = out.collect()
    assert [r.delivery_time_days for r in rows] == [4, 4, None]
    assert [r.purchase_year for r in rows] == [2023] * 3
    assert [r.purchase_month for r in rows] == [1] * 3
    assert [r.purchase_day_of_week for r in rows] == [6, 0, 1]


def test_delay_is_negative_when_early(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2))],
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    )
    assert derive.delay_days(df).first().delivery_delay_days == -1


ITEMS = "order_id string, order_item_id int, price decimal(18,2), freight_value decimal(18,2)"


@pytest.fixture
def items(spark):
    rows = [
        ("a", 1, Decimal("10.10"), Decimal("1.00")),
        ("a", 2, Decimal("20.20"), None),
        ("b", None, None, None),
        (None, 1, Decimal("5.00"), Decimal("5.00")),
    ]
    return spark.createDataFrame(rows, ITEMS)


def test_totals_of_an_all_null_group_are_zero(items):
    got = bag(aggregates.items_per_order(items))
    assert got == [
        ("a", 2, Decimal("30.30"), Decimal("1.00")),
        ("b", 0, Decimal("0.00"), Decimal("0.00")),
    ]


def test_summary_has_one_row_per_order_and_nulls_for_none(spark, items):
    orders = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "order_id string, n int")
    payments = spark.createDataFrame(
        [("a", Decimal("1.00")), ("a", Decimal("2.50")), ("z", Decimal("9.00"))],
        "order_id string, payment_value decimal(18,2)",
    )
    got = bag(marts.sales_summary(orders, items, payments))
    assert got == [
        ("a", 1, 2, Decimal("30.30"), Decimal("1.00"), Decimal("3.50")),
        ("b", 2, 0, Decimal("0.00"), Decimal("0.00"), None),
        ("c", 3, None, None, None, None),
    ]


def test_null_order_ids_match_only_on_request(spark, items):
    orders = spark.createDataFrame([("a", 1), (None, 2)], "order_id string, n int")
    plain = joins.orders_with_items(orders, items)
    assert plain.columns == ["order_id", "n", "order_item_id", "price", "freight_value"]
    assert sorted(r.order_item_id for r in plain.collect()) == [1, 2]
    loose = joins.orders_with_items(orders, items, match_null_ids=True)
    assert bag(loose, "order_id", "n", "order_item_id") == [(None, 2, 1), ("a", 1, 1), ("a", 1, 2)]


def test_untranslated_and_null_categories_stay(spark):
    products = spark.createDataFrame(
        [(1, "x"), (2, "y"), (3, None)], "product_id int, product_category_name string"
    )
    names = spark.createDataFrame(
        [("x", "ex")], "product_category_name string, product_category_name_english string"
    )
    got = bag(
        joins.translate_categories(products, names), "product_id", "product_category_name_english"
    )
    assert got == [(1, "ex"), (2, None), (3, None)]


def test_category_totals_keep_the_null_category(spark):
    rows = [("x", "a", Decimal("2.00"), None), (None, "b", Decimal("5.00"), Decimal("1.00")),
            ("x", "c", None, None), ("y", "d", None, None)]
    df = spark.createDataFrame(
        rows,
        "product_category_name string, order_id string, price decimal(18,2), "
        "freight_value decimal(18,2)",
    )
    got = [tuple(r) for r in aggregates.sales_by_category(df).collect()]
    assert got == [
        (None, 1, Decimal("5.00"), 5.0, Decimal("1.00")),
        ("x", 2, Decimal("2.00"), 2.0, None),
        ("y", 1, None, None, None),
    ]


def test_marts_keep_the_first_row_of_the_file(spark):
    file, block, row = FILE_POSITION
    rows = [("s1", "late", "f", 0, 5), ("s1", "early", "f", 0, 1), ("s1", "other", "g", 0, 0)]
    df = spark.createDataFrame(
        rows, f"Seller_ID string, seller_city string, {file} string, {block} bigint, {row} bigint"
    )
    assert bag(marts.sellers(df)) == [("s1", "early")]
    assert marts.sellers(df.drop(*FILE_POSITION)).first().seller_city == "early"


def test_totals_add_short_and_long_amounts_exactly(spark):
    longest = "9999999999999999.99"
    rows = [
        ("a", 1, longest, "999999.99"), ("a", 2, longest, "-1000000.00"), ("a", 3, "-0.01", None), ("b", 1, None, None),
    ]
    df = spark.createDataFrame(rows, "order_id string, order_item_id int, price string, freight_value string")
    items = df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("price", "freight_value")})
    got = aggregates.items_per_order(items).orderBy("order_id")
    assert dict(got.dtypes)["total_price"] == "decimal(28,2)"
    assert [tuple(map(str, r)) for r in got.collect()] == [
        ("a", "3", "19999999999999999.97", "-0.01"), ("b", "1", "0.00", "0.00"),
    ]
    # Short amounts are added as whole numbers.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UnscaledValue") == 2
