"""Cleaned tables and the one-row-per-order sales mart."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame

from cartledger.operators.aggregates import items_per_order, payments_per_order
from cartledger.operators.cleaning import (
    clean_names,
    drop_duplicate_keys,
    drop_duplicate_rows,
    parse_dates,
)
from cartledger.operators.copies import drop_duplicate_keys_two_pass, drop_duplicate_rows_two_pass
from cartledger.operators.derive import order_columns
from cartledger.operators.joins import translate_categories
from cartledger.sources.readers import FILE_POSITION, REJECTED

REVIEW_DATES = ("review_creation_date", "review_answer_timestamp")


def _first_per_key(raw: DataFrame, keys: Sequence[str], stored: bool = False) -> DataFrame:
    """One row per key: the first in the files where ``raw`` has its file position,
    else the least in column order. A stored table is read twice, so only copies are exchanged."""
    df = clean_names(raw).drop(REJECTED)
    position = [c for c in FILE_POSITION if c in df.columns]
    drop = drop_duplicate_keys_two_pass if stored else drop_duplicate_keys
    return drop(df, keys, position or None).drop(*position)


def _all_rows(raw: DataFrame) -> DataFrame:
    return clean_names(raw).drop(*FILE_POSITION, REJECTED)


def orders(raw: DataFrame, stored: bool = False) -> DataFrame:
    return _first_per_key(raw, ["order_id"], stored).transform(order_columns)


def customers(raw: DataFrame, stored: bool = False) -> DataFrame:
    return _first_per_key(raw, ["customer_id"], stored)


def products(raw: DataFrame, translation: DataFrame | None = None, stored: bool = False) -> DataFrame:
    unique = _first_per_key(raw, ["product_id"], stored)
    if translation is None:
        return unique
    return translate_categories(unique, _all_rows(translation))


def order_items(raw: DataFrame, stored: bool = False) -> DataFrame:
    return _all_rows(raw).transform(drop_duplicate_rows_two_pass if stored else drop_duplicate_rows)


def payments(raw: DataFrame, stored: bool = False) -> DataFrame:
    return _all_rows(raw)


def reviews(raw: DataFrame, stored: bool = False) -> DataFrame:
    """One review may speak for several orders, so the key is the pair."""
    return parse_dates(_first_per_key(raw, ["review_id", "order_id"], stored), REVIEW_DATES)


def sellers(raw: DataFrame, stored: bool = False) -> DataFrame:
    return _first_per_key(raw, ["seller_id"], stored)


def sales_summary(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with its item and payment totals; null where it has none.

    Both sides are reduced to one row per order before they are joined, so nothing
    fans out and an order with very many items costs one row per task.
    """
    return (
        orders.join(items_per_order(items), "order_id", "left")
        .join(payments_per_order(payments), "order_id", "left")
    )


def builders(
    raw: Mapping[str, DataFrame], stored: Collection[str] = ()
) -> dict[str, Callable[[], DataFrame]]:
    """How to clean every table whose input is in ``raw``; nothing runs before it is called.

    Of tables named in ``stored``, which are cheap to read twice, copies are counted first, by a job,
    and only rows that have some are exchanged.
    """
    steps = {
        "orders": orders,
        "customers": customers,
        "products": partial(products, translation=raw.get("category_translation")),
        "order_items": order_items,
        "payments": payments,
        "reviews": reviews,
        "sellers": sellers,
    }
    return {name: partial(step, raw[name], stored=name in stored) for name, step in steps.items() if name in raw}


def build_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every cleaned table whose input is in ``raw``."""
    return {name: build() for name, build in builders(raw).items()}
