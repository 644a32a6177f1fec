"""Dashboard figures. Every function takes trips or a stored summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalar import as_timestamp, ratio, round_half_up
from .summary import mean, rounded_mean, summarise
from .views import driver_revenue, hourly_stats, monthly_trend, weekday_stats

HOURS = range(24)


def hourly_detail(source: DataFrame) -> DataFrame:
    """Hour and volume of each row of the hourly view, not aggregated further."""
    return hourly_stats(source, ordered=False).select("pickup_hour", "trip_count")


def hour_month_fare(source: DataFrame) -> DataFrame:
    """Sum of the weekdays' average fares per hour and month, as the dashboard adds them up."""
    return (
        hourly_stats(source, ordered=False)
        .groupBy("pickup_hour", "month")
        .agg(round_half_up(F.sum("avg_fare"), 2).alias("sum_avg_fare"))
    )


def weekday_trips(source: DataFrame) -> DataFrame:
    return (
        weekday_stats(source, ordered=False)
        .groupBy("pickup_weekday")
        .agg(F.sum("trip_count").alias("trip_count"))
    )


def month_of_year_revenue(source: DataFrame) -> DataFrame:
    """Revenue per calendar month, years added together."""
    return (
        monthly_trend(source, ordered=False)
        .groupBy(F.month("month").alias("month_of_year"))
        .agg(F.sum("total_revenue").alias("total_revenue"))
    )


def golden_hour_heatmap(source: DataFrame) -> DataFrame:
    """Average revenue by weekday and hour, one column per hour (listed, so no extra job)."""
    cells = summarise(source, ["pickup_hour", "pickup_weekday"]).select(
        "pickup_weekday", "pickup_hour", rounded_mean("total", 2).alias("avg_revenue")
    )
    wide = cells.groupBy("pickup_weekday").pivot("pickup_hour", list(HOURS)).agg(F.max("avg_revenue"))
    return wide.select("pickup_weekday", *[F.col(str(h)).alias(f"hour_{h:02d}") for h in HOURS])


def hour_tip_volume(source: DataFrame) -> DataFrame:
    """Volume and average tip rate by hour, averaged over trips."""
    return summarise(source, ["pickup_hour"]).select(
        "pickup_hour", "trip_count", rounded_mean("tip_rate", 4).alias("avg_tip_rate")
    )


def weekday_revenue(source: DataFrame) -> DataFrame:
    return summarise(source, ["pickup_weekday"]).select(
        "pickup_weekday", "trip_count",
        rounded_mean("total", 2).alias("avg_revenue"),
        rounded_mean("tip_rate", 4).alias("avg_tip_rate"),
    )


def weekpart_revenue(source: DataFrame) -> DataFrame:
    """Monday to Thursday, Friday and weekend, each also relative to the weekend."""
    weekday = F.col("pickup_weekday")
    part = (
        F.when(weekday.isin("Saturday", "Sunday"), "weekend")
        .when(weekday == "Friday", "friday")
        .otherwise("mon_thu")
    )
    parts = summarise(
        summarise(source, ["pickup_weekday"]).withColumn("weekpart", part), ["weekpart"]
    )
    # Three rows by construction.
    weekend = F.max(F.when(F.col("weekpart") == "weekend", mean("total"))).over(Window.partitionBy())
    return parts.select(
        "weekpart", "trip_count",
        rounded_mean("total", 2).alias("avg_revenue"),
        rounded_mean("tip_rate", 4).alias("avg_tip_rate"),
        round_half_up((ratio(mean("total"), weekend) - 1) * 100, 2).alias("vs_weekend_pct"),
    )


def weekday_tip_corr(source: DataFrame) -> DataFrame:
    """Correlation of average revenue and average tip rate across the weekdays."""
    return weekday_revenue(source).agg(
        F.round(F.corr("avg_revenue", "avg_tip_rate"), 6).alias("revenue_tip_corr")
    )


def revenue_mom(source: DataFrame) -> DataFrame:
    """Change of monthly revenue against the calendar month before, in percent.

    A month without trips between the first and the last one is a row without revenue, and neither it
    nor the month after it has a change. The window has no partition key; it sees one row per month.
    """
    order = Window.orderBy("month")
    rows = monthly_trend(source, ordered=False).select(
        F.col("month").cast("date").alias("month"), "total_revenue",
        F.lag("month").over(order).cast("date").alias("before"), F.lag("total_revenue").over(order).alias("previous"),
        F.lead("month").over(order).cast("date").alias("after"))
    adjacent = F.col("before") == F.add_months("month", -1)
    change = F.when(adjacent, round_half_up((ratio(F.col("total_revenue"), F.col("previous")) - 1) * 100, 2))
    # Each month brings the empty ones that follow it.
    last = F.coalesce(F.add_months("after", -1), F.col("month"))
    dense = rows.select(
        "month", "total_revenue", change.alias("change_pct"),
        F.explode(F.sequence("month", last, F.expr("INTERVAL 1 MONTH"))).alias("shown"))
    own = F.col("shown") == F.col("month")
    return dense.select(
        as_timestamp(F.col("shown")).alias("month"), F.when(own, F.col("total_revenue")).alias("total_revenue"),
        F.when(own, F.col("change_pct")).alias("change_pct"))


def best_hour_per_weekday(source: DataFrame) -> DataFrame:
    best = Window.partitionBy("pickup_weekday").orderBy(
        F.desc_nulls_last("revenue_per_hour"), "pickup_hour"
    )
    return (
        driver_revenue(source, ordered=False)
        .withColumn("rank", F.row_number().over(best))
        .where("rank = 1")
        .select("pickup_weekday", "pickup_hour", "revenue_per_hour", "trip_count")
    )


def top_revenue_slots(source: DataFrame, k: int = 10) -> DataFrame:
    """The k best hour and weekday slots by revenue per hour; ties go to the earlier slot."""
    return (
        driver_revenue(source, ordered=False)
        .orderBy(F.desc_nulls_last("revenue_per_hour"), "pickup_hour", "pickup_weekday")
        .limit(k)
        .select("pickup_hour", "pickup_weekday", "trip_count", "avg_revenue", "revenue_per_hour")
    )
