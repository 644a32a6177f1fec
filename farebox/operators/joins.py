"""Relationships between the hourly view and the coarser views.

Only already aggregated rows take part: at most 168 a month on the left. The right sides are
broadcast by adaptive execution once their real size is known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _related(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Left join on equal names; other columns of the right side get a prefix."""
    renamed = right.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        *[F.col(c).alias(f"{prefix}_{c}") for c in right.columns if c not in keys],
    )
    condition = [left[k] == renamed[f"_{k}"] for k in keys]
    return left.join(renamed, condition, "left").drop(*[f"_{k}" for k in keys])


def hourly_with_month(hourly: DataFrame, monthly: DataFrame) -> DataFrame:
    return _related(hourly, monthly, ["month"], "month")


def hourly_with_weekday(hourly: DataFrame, weekday: DataFrame) -> DataFrame:
    return _related(hourly, weekday, ["pickup_weekday"], "weekday")


def hourly_with_month_by_count(hourly: DataFrame, monthly: DataFrame) -> DataFrame:
    """The dashboard's stored keys: equal trip count and equal month."""
    return _related(hourly, monthly, ["trip_count", "month"], "month")


def hourly_with_weekday_by_count(hourly: DataFrame, weekday: DataFrame) -> DataFrame:
    """The dashboard's stored key: equal trip count."""
    return _related(hourly, weekday, ["trip_count"], "weekday")
