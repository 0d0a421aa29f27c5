"""The joins of the order model. All keep every matching row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartledger.operators.skew import (
    DEFAULT_POLICY,
    SkewPolicy,
    free_name,
    lookup_join,
    split_hot_join,
)


def orders_with_items(
    orders: DataFrame,
    items: DataFrame,
    match_null_ids: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """Orders joined to their items; ``orders`` has one row per ``order_id``.

    Hot orders are counted in ``keys_of``, a stored table with the order ids of ``items``,
    where ``items`` itself is costly to compute.

    ``match_null_ids`` pairs a null order id with a null order id, as pandas does.
    The null orders join as one more hot key, since ``orders`` holds at most one.
    """
    columns = [*orders.columns, *[c for c in items.columns if c != "order_id"]]
    matched = split_hot_join(items, orders, "order_id", "inner", policy, keys_of).select(*columns)
    if not match_null_ids:
        return matched
    null = free_name(orders, "_null", items)
    null_order = orders.filter(F.col("order_id").isNull()).withColumn(null, F.lit(True))
    null_items = (
        items.filter(F.col("order_id").isNull()).drop("order_id").withColumn(null, F.lit(True))
    )
    # One row at most after de-duplication by order_id; measured before broadcasting.
    paired = lookup_join(null_items, null_order, null, "inner", policy)
    return matched.unionByName(paired.select(*columns))


def orders_items_products(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Orders with their items, and the product of each item where it is known."""
    sold = orders_with_items(orders, items, policy=policy)
    # An item stays one row in the first join, so its products are as hot there as here.
    return lookup_join(sold, products, "product_id", "left", policy, keys_of=items)


def translate_categories(
    products: DataFrame, translation: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Add the English category name; a category without one gets null."""
    return lookup_join(products, translation, "product_category_name", "left", policy)
