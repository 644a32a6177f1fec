"""The five aggregate views over the trip table.

Each takes trips or a stored summary and, where ``ordered``, sorts like the view it stands for. NULL order is spelled out: NULLs come first when descending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalar import as_timestamp
from ..schema import MONTH_COLUMN, TRIP_TABLE
from .summary import (
    DISTANCE_KEY, SUMMARY_KEYS, merge_sets, revenue_per_hour, revenue_per_mile, rounded_mean, summarise,
    total_revenue, trip_summary,
)


def _month():
    return as_timestamp(F.col(MONTH_COLUMN)).alias("month")


def hourly_stats(source: DataFrame, ordered: bool = True) -> DataFrame:
    view = summarise(source, SUMMARY_KEYS).select(
        _month(), "pickup_hour", "pickup_weekday", "trip_count",
        rounded_mean("fare", 2).alias("avg_fare"),
        rounded_mean("duration", 1).alias("avg_duration_min"),
        rounded_mean("tip_rate", 4).alias("avg_tip_rate"),
        total_revenue().alias("total_revenue"),
    )
    keys = ("month", "pickup_hour", "pickup_weekday")
    return view.orderBy(*[F.asc_nulls_last(k) for k in keys]) if ordered else view


def weekday_stats(source: DataFrame, ordered: bool = True) -> DataFrame:
    view = summarise(source, ["pickup_weekday"]).select(
        "pickup_weekday", "trip_count",
        rounded_mean("fare", 2).alias("avg_fare"),
        rounded_mean("tip_rate", 4).alias("avg_tip_rate"),
    )
    return view.orderBy(F.desc_nulls_first("trip_count")) if ordered else view


def monthly_trend(source: DataFrame, ordered: bool = True) -> DataFrame:
    view = summarise(source, [MONTH_COLUMN]).select(
        _month(), "trip_count",
        rounded_mean("fare", 2).alias("avg_fare"),
        total_revenue().alias("total_revenue"),
    )
    return view.orderBy(F.asc_nulls_last("month")) if ordered else view


def driver_revenue(source: DataFrame, ordered: bool = True) -> DataFrame:
    view = summarise(source, ["pickup_hour", "pickup_weekday"]).select(
        "pickup_hour", "pickup_weekday", "trip_count",
        rounded_mean("total", 2).alias("avg_revenue"),
        rounded_mean("tip", 2).alias("avg_tip"),
        rounded_mean("tip_rate", 4).alias("avg_tip_rate"),
        rounded_mean("duration", 1).alias("avg_duration_min"),
        rounded_mean("distance", 2).alias("avg_distance"),
        revenue_per_hour().alias("revenue_per_hour"),
        revenue_per_mile().alias("revenue_per_mile"),
    )
    return view.orderBy(F.desc_nulls_first("revenue_per_hour")) if ordered else view


def distance_revenue(source: DataFrame, ordered: bool = True) -> DataFrame:
    """Groups by the distance rounded to a tenth and shows the rounded average of the group."""
    view = summarise(source, [DISTANCE_KEY]).select(
        rounded_mean("distance", 1).alias("avg_distance"), "trip_count",
        rounded_mean("total", 2).alias("avg_revenue"),
        rounded_mean("tip_rate", 4).alias("avg_tip_rate"),
        rounded_mean("duration", 1).alias("avg_duration_min"),
        revenue_per_hour().alias("revenue_per_hour"),
    )
    return view.orderBy(F.asc_nulls_last("avg_distance")) if ordered else view


#: Keys each view groups by, of one grain of the summary.
VIEW_KEYS = {
    "v_hourly_stats": SUMMARY_KEYS,
    "v_weekday_stats": ("pickup_weekday",),
    "v_monthly_trend": (MONTH_COLUMN,),
    "v_driver_revenue": ("pickup_hour", "pickup_weekday"),
    "v_distance_revenue": (DISTANCE_KEY,),
}


def all_views(trips: DataFrame) -> DataFrame:
    """The rows of all five views, named by ``view``, from one scan of the trips.

    The summary's few rows are grouped in five ways at once; columns a view has not got are NULL.
    """
    rows = merge_sets(trip_summary(trips), VIEW_KEYS)
    columns = {
        "month": _month(), "pickup_hour": F.col("pickup_hour"), "pickup_weekday": F.col("pickup_weekday"),
        "trip_count": F.col("trip_count"), "avg_fare": rounded_mean("fare", 2),
        "avg_duration_min": rounded_mean("duration", 1), "avg_tip_rate": rounded_mean("tip_rate", 4),
        "total_revenue": total_revenue(), "avg_revenue": rounded_mean("total", 2),
        "avg_tip": rounded_mean("tip", 2),
        "avg_distance": F.when(F.col("view") == "v_distance_revenue", rounded_mean("distance", 1)).otherwise(
            rounded_mean("distance", 2)),
        "revenue_per_hour": revenue_per_hour(), "revenue_per_mile": revenue_per_mile(),
    }
    return rows.select("view", *[
        F.when(F.col("view").isin([v for v, shown in VIEW_COLUMNS.items() if name in shown]), column).alias(name)
        for name, column in columns.items()])


VIEWS = {
    "v_hourly_stats": hourly_stats,
    "v_weekday_stats": weekday_stats,
    "v_monthly_trend": monthly_trend,
    "v_driver_revenue": driver_revenue,
    "v_distance_revenue": distance_revenue,
}


#: What each view shows.
VIEW_COLUMNS = {
    "v_hourly_stats": ("month", "pickup_hour", "pickup_weekday", "trip_count", "avg_fare", "avg_duration_min",
                       "avg_tip_rate", "total_revenue"),
    "v_weekday_stats": ("pickup_weekday", "trip_count", "avg_fare", "avg_tip_rate"),
    "v_monthly_trend": ("month", "trip_count", "avg_fare", "total_revenue"),
    "v_driver_revenue": ("pickup_hour", "pickup_weekday", "trip_count", "avg_revenue", "avg_tip", "avg_tip_rate",
                         "avg_duration_min", "avg_distance", "revenue_per_hour", "revenue_per_mile"),
    "v_distance_revenue": ("avg_distance", "trip_count", "avg_revenue", "avg_tip_rate", "avg_duration_min",
                           "revenue_per_hour"),
}


def register_views(spark: SparkSession, trips: DataFrame, summary: DataFrame | None = None) -> None:
    """Make the trips and the five views visible to SQL.

    With a stored ``summary`` the views read that instead of the trips.
    """
    trips.createOrReplaceTempView(TRIP_TABLE)
    for name, view in VIEWS.items():
        view(trips if summary is None else summary).createOrReplaceTempView(name)
