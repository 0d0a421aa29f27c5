"""Shapes of the physical plans that matter at scale."""

import re

import pytest

from cartledger.checks.registry import queries
from cartledger.plans import star_mapping as star
from cartledger.plans.reports import REPORTS


@pytest.fixture(scope="module")
def plan(spark, sf_dir):
    """Plans made without broadcasts, as between two large tables."""

    def explain(name):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            df = queries()[name](spark, sf_dir)
            return df._jdf.queryExecution().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    return explain


@pytest.mark.parametrize("name", [*REPORTS, "jn_orders_items", "mart_sales_summary"])
def test_no_python_workers_and_no_cross_joins(plan, name):
    text = plan(name)
    for node in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text.split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", ["q01_category_sales", "q02_top_sellers", "q09_top_customers"])
def test_top_rows_are_taken_without_a_full_sort(plan, name):
    assert "TakeOrderedAndProject" in plan(name)


@pytest.mark.parametrize("name", ["cln_dedup_key", "q05_top_products", "mart_orders"])
def test_ranks_are_cut_before_the_shuffle(plan, name):
    physical = plan(name).split("== Physical Plan ==")[1]
    partial = physical.index(", Partial")
    assert "WindowGroupLimit" in physical
    assert "Exchange hashpartitioning" in physical[:partial]


def test_unused_totals_are_not_computed(plan):
    """Revenue per state needs payments only, so the items are never read."""
    physical = plan("q04_customers_by_state").split("== Physical Plan ==")[1]
    assert physical.count("l_discount") and not physical.count("l_tax")


def test_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    for name in ("orders", "reviews"):
        getattr(star, name)(spark, sf_dir).write.parquet(str(tmp_path / name))
    tables = {n: spark.read.parquet(str(tmp_path / n)) for n in ("orders", "reviews")}
    text = REPORTS["q03_delivery_times"](tables)._jdf.queryExecution().toString()
    assert "EqualTo(order_status,delivered)" in text
    scan = text[text.index("ReadSchema"):]
    assert "customer_id" not in scan


def test_sales_mart_shuffles_each_input_once(plan):
    """Once for the copies in orders and items and once per total; the joins add none."""
    physical = plan("mart_sales_summary").split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning(order_id") == 4


def test_items_are_shuffled_once_for_the_distinct_products(plan):
    """By order for the semi join; afterwards only the ids of products move."""
    physical = plan("q12_dashboard").split("== Physical Plan ==")[1]
    assert "Exchange hashpartitioning(order_id" in physical
    assert "hashpartitioning(order_id#" not in "".join(
        line for line in physical.splitlines() if "product_id" in line and "hashpartitioning" in line
    )


@pytest.mark.parametrize("name", ["q01_category_sales", "q05_top_products"])
def test_products_do_not_meet_by_category(plan, name):
    physical = plan(name).split("== Physical Plan ==")[1]
    assert not re.search(r"hashpartitioning\(product_category_name#\d+, \d+\)", physical)
