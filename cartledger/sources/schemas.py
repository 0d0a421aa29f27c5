"""Typed schemas and file names of the nine source tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    StringType,
    StructType,
    TimestampNTZType,
)


@dataclass(frozen=True)
class TableSource:
    """File stem and column types of a table; a column not listed is read as text.

    ``multi_line`` allows line breaks inside quoted text. Such a file cannot be
    split between tasks, so it is set only for the table that has free text.
    """

    stem: str
    schema: StructType
    multi_line: bool = False


_TEXT, _WHOLE, _AMOUNT, _TIME = StringType(), IntegerType(), DecimalType(18, 2), TimestampNTZType()


def _source(stem: str, multi_line: bool = False, **columns) -> TableSource:
    schema = StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return TableSource(stem, schema, multi_line)


# Table names, file stems, columns and types of the order model.
TABLES = {
    "customers": _source(
        "customers_dataset",
        customer_id=_TEXT,
        customer_city=_TEXT,
        customer_state=_TEXT,
    ),
    "orders": _source(
        "orders_dataset",
        order_id=_TEXT,
        customer_id=_TEXT,
        order_status=_TEXT,
        order_purchase_timestamp=_TIME,
        order_approved_at=_TIME,
        order_delivered_carrier_date=_TIME,
        order_delivered_customer_date=_TIME,
        order_estimated_delivery_date=_TIME,
    ),
    "order_items": _source(
        "order_items_dataset",
        order_id=_TEXT,
        order_item_id=_WHOLE,
        product_id=_TEXT,
        seller_id=_TEXT,
        price=_AMOUNT,
        freight_value=_AMOUNT,
    ),
    "products": _source(
        "products_dataset",
        product_id=_TEXT,
        product_category_name=_TEXT,
    ),
    "sellers": _source(
        "sellers_dataset",
        seller_id=_TEXT,
        seller_city=_TEXT,
        seller_state=_TEXT,
    ),
    "payments": _source(
        "order_payments_dataset",
        order_id=_TEXT,
        payment_sequential=_WHOLE,
        payment_type=_TEXT,
        payment_installments=_WHOLE,
        payment_value=_AMOUNT,
    ),
    "reviews": _source(
        "order_reviews_dataset",
        multi_line=True,
        review_id=_TEXT,
        order_id=_TEXT,
        review_score=_WHOLE,
        review_comment_message=_TEXT,
        review_creation_date=_TIME,
        review_answer_timestamp=_TIME,
    ),
    "geolocation": _source("geolocation_dataset"),
    "category_translation": _source(
        "product_category_name_translation",
        product_category_name=_TEXT,
        product_category_name_english=_TEXT,
    ),
}
