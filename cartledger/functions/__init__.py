from cartledger.functions.dates import parse_timestamp
from cartledger.functions.exact import (
    days_between,
    exact_mean,
    mean_days,
    micros_between,
    money,
    month_start,
    r2,
    whole_days,
)

__all__ = [
    "days_between",
    "exact_mean",
    "mean_days",
    "micros_between",
    "money",
    "month_start",
    "parse_timestamp",
    "r2",
    "whole_days",
]
