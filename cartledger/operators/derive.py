"""Delivery and calendar columns of an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartledger.functions import whole_days
from cartledger.operators.cleaning import parse_dates

# The date columns of an order.
PURCHASED = "order_purchase_timestamp"
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"
ORDER_DATES = (
    PURCHASED,
    "order_approved_at",
    "order_delivered_carrier_date",
    DELIVERED,
    ESTIMATED,
)


def delivery_days(df: DataFrame) -> DataFrame:
    """Whole days from purchase to delivery."""
    if {DELIVERED, PURCHASED} <= set(df.columns):
        return df.withColumn("delivery_time_days", whole_days(DELIVERED, PURCHASED))
    return df


def delay_days(df: DataFrame) -> DataFrame:
    """Whole days from the estimate to delivery; negative when early."""
    if {DELIVERED, ESTIMATED} <= set(df.columns):
        return df.withColumn("delivery_delay_days", whole_days(DELIVERED, ESTIMATED))
    return df


def calendar_parts(df: DataFrame) -> DataFrame:
    """Year, month and weekday of the purchase, Monday being 0."""
    if PURCHASED not in df.columns:
        return df
    return df.withColumns(
        {
            "purchase_year": F.year(PURCHASED),
            "purchase_month": F.month(PURCHASED),
            "purchase_day_of_week": F.weekday(PURCHASED),
        }
    )


def order_columns(df: DataFrame) -> DataFrame:
    """All order derivations; each is skipped when its input columns are absent."""
    return (
        parse_dates(df, ORDER_DATES)
        .transform(delivery_days)
        .transform(delay_days)
        .transform(calendar_parts)
    )
