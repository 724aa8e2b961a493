"""Ratios, target transforms and standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_price(price: Column) -> Column:
    return F.log1p(F.greatest(price, F.lit(0.0)))


def price_ratio(price: Column, median: Column) -> Column:
    """Price over the median, the median taken as 1 when missing or below 1."""
    return price / F.greatest(median, F.lit(1.0))


def demand_trend(recent: Column, previous: Column) -> Column:
    return (recent + 1) / (previous + 1)


def month_index(same_month: Column, total: Column) -> Column:
    return same_month / F.greatest(total / 12, F.lit(1.0))


def similarity_weight(similarity: Column, temperature: float) -> Column:
    return F.exp(similarity * F.lit(float(temperature)))


def to_log_target(y: Column) -> Column:
    return F.log1p(F.greatest(y, F.lit(0.0)))


def from_log_target(p: Column) -> Column:
    return F.greatest(F.expm1(p), F.lit(0.0))


def standardise(x: Column, mean: Column, std: Column) -> Column:
    """Missing values take the mean, so they end at zero."""
    return (F.coalesce(x.cast("double"), mean) - mean) / std
