"""Per-order and per-category totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartledger.functions import exact_mean, money

def _total(column: str) -> Column:
    """Sum that is 0, not null, for a group whose values are all null.

    Amounts of up to eight digits, which most are, are summed apart from longer ones: Spark adds
    those as whole numbers, and others as decimals of any length, which takes several times as long.
    """
    amount = money(column)
    short = amount.try_cast("decimal(8,2)")
    sums = [F.coalesce(F.sum(part), F.lit(0)) for part in (short, F.when(short.isNull(), amount))]
    return (sums[0] + sums[1]).cast("decimal(28,2)")


def items_per_order(items: DataFrame) -> DataFrame:
    """Item count, price and freight per order; rows without an order are left out."""
    return (
        items.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count("order_item_id").alias("total_items"),
            _total("price").alias("total_price"),
            _total("freight_value").alias("total_freight"),
        )
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return (
        payments.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(_total("payment_value").alias("total_payment"))
    )


def sales_by_category(sales: DataFrame) -> DataFrame:
    """Order rows, revenue, mean price and freight per category, null included."""
    return (
        sales.groupBy("product_category_name")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum(money("price")).alias("total_revenue"),
            exact_mean(F.sum(money("price")), F.count("price")).alias("avg_price"),
            F.sum(money("freight_value")).alias("total_freight"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_first("product_category_name"))
    )
