"""One query per operator over the test tables, keyed by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import scalar
from ..functions.months import month_span, months_of_year
from ..operators import clean as C, dashboards as D, joins as J, months as M, quality as Q, views as V
from ..operators.summary import SUMMARY_KEYS, summarise
from .. import schema as S
from ..schema import MONTH_COLUMN, RAW_COLUMNS
from ..session import shared_dir
from ..sources import arrow_sink, raw as R
from ..sources.files import Files
from ..sources.footers import FooterChecks
from . import inputs

Query = Callable[[SparkSession, str], DataFrame]

# Arguments of the operators that take a month.
ONE_MONTH = date(1998, 3, 1)
FIRST_QUARTER = months_of_year(1997, "1-3")
DELETED = month_span("1997-01", "1997-06")
LATE = datetime(1998, 6, 1)


def _raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(inputs.trips(spark, folder))


def _clean(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(C.clean(inputs.trips(spark, folder)))


def _derived(name: str, column: Callable[[], object]) -> Query:
    """A derived column next to the columns it is computed from."""
    return _raw(lambda trips: trips.select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount", "tip_amount",
        column().alias(name),
    ))


def _joined(join, right) -> Query:
    """Join the hourly view to a coarser one, both rolled up from the same summary."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        summary = summarise(C.clean(inputs.trips(spark, folder)), SUMMARY_KEYS)
        return join(V.hourly_stats(summary, ordered=False), right(summary, ordered=False))

    return query


def _scan_multi_month(spark: SparkSession, folder: str) -> DataFrame:
    return reduce(DataFrame.unionByName, map(R.normalise, inputs.drifted_months(spark, folder)))


def _arrow_partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every partition exported as CSV through Arrow, and the rows of the committed parts."""
    target = f"{shared_dir(spark)}/arrow-csv-{uuid.uuid4().hex}"
    parts = arrow_sink.export_partitions(C.clean(inputs.trips(spark, folder)), target)
    Files(spark).delete(target)
    return arrow_sink.total_rows(spark.createDataFrame([(p.name, p.rows) for p in parts], "name string, rows long"))


def _footer_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Prices out of range, NULL prices and late shipments, from footers as far as they tell."""
    checks = FooterChecks(spark, f"{folder}/lineitem.parquet")
    counts = (
        checks.rows("l_extendedprice"), checks.outside("l_extendedprice", 0, 100 * S.MAX_FARE),
        checks.nulls("l_extendedprice"), checks.since("l_shipdate", LATE))
    return spark.createDataFrame([counts], "all_rows long, bad_prices long, null_prices long, late_rows long")


def _schema_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Raw months as files of both schema families, read together, and their rows per month."""
    raw = f"{shared_dir(spark)}/raw-months-{uuid.uuid4().hex}"
    for trips in inputs.drifted_months(spark, folder):
        month = F.concat(F.date_format("tpep_pickup_datetime", "yyyy-MM"), F.lit(".parquet"))
        trips.withColumn("m", month).write.mode("append").partitionBy("m").parquet(raw)
    read = R.read_months(spark, R.find_months(spark, raw))
    return read.trips.groupBy(
        scalar.as_timestamp(scalar.month_start(F.col("tpep_pickup_datetime"))).alias("month")).agg(
        F.count(F.lit(1)).alias("trip_count"), F.sum(F.col("vendor_id").cast("long")).alias("vendors"),
        F.count("passenger_count").alias("passenger_counts"))


def _replace_month(trips: DataFrame) -> DataFrame:
    """March 1998 is loaded again with corrected vendors."""
    again = M.in_month_set(trips, [ONE_MONTH]).withColumn("vendor_id", F.col("vendor_id") + 10)
    return M.replace_months(trips, again, [ONE_MONTH])


def _violation_counts(trips: DataFrame) -> DataFrame:
    """Broken rules per month; trips of odd months count as picked up in a foreign one."""
    month = scalar.month_start(F.col("tpep_pickup_datetime"))
    marked = trips.withColumns({"own_month": F.month(month) % 2 == 0, MONTH_COLUMN: month})
    counts = C.violation_counts(C.judge(marked), MONTH_COLUMN)
    return counts.withColumn("month", scalar.as_timestamp(F.col(MONTH_COLUMN))).drop(MONTH_COLUMN)


def _coverage(operator) -> Query:
    """Loaded months against all months up to the end of the last year."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        loaded = M.loaded_months(inputs.trips(spark, folder))
        month = F.col(MONTH_COLUMN)
        requested = M.requested_months(loaded.agg(
            F.min(month).alias("first"),
            F.make_date(F.year(F.max(month)), F.lit(12), F.lit(31)).alias("last"),
        ))
        return operator(requested, loaded)

    return query


def _target_month(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.table(spark, folder, "orders")
    return orders.select(
        "o_orderkey", "o_orderdate",
        scalar.as_timestamp(M.target_month(F.col("o_orderdate"))).alias("target_month"),
    )


def _health_report(spark: SparkSession, folder: str) -> DataFrame:
    return Q.health_report(inputs.loaded_trips(spark, folder), inputs.ledger(spark, folder))


def queries() -> dict[str, Query]:
    return {
        # Scans, sources, sinks
        "scan_pruned": _raw(lambda t: t.select(
            F.col("vendor_id").alias("vendorid"), *RAW_COLUMNS[1:])),
        "scan_multi_month": _scan_multi_month,
        "raw_row_count": _raw(R.row_count),
        "arrow_partition_counts": _arrow_partition_counts,
        "schema_gate": _schema_gate,
        "delete_month_range": _clean(lambda t: M.delete_month_range(t, DELETED)),
        "replace_month": _clean(_replace_month),
        "month_coverage": _coverage(M.month_coverage),
        "missing_months": _coverage(M.missing_months),
        "target_month": _target_month,
        # Projections
        "trip_duration": _derived("trip_duration_min", C.minutes),
        "pickup_hour": _derived(
            "pickup_hour", lambda: scalar.hour_of_day(F.col("tpep_pickup_datetime"))),
        "pickup_weekday": _derived(
            "pickup_weekday", lambda: scalar.weekday_name(F.col("tpep_pickup_datetime"))),
        "tip_rate": _derived(
            "tip_rate", lambda: scalar.tip_rate(F.col("tip_amount"), F.col("fare_amount"))),
        # Filters
        "filter_month_set": _raw(lambda t: M.in_month_set(t, FIRST_QUARTER)),
        "filter_amounts": _raw(lambda t: t.where(C.valid_amounts())),
        "filter_passengers": _raw(lambda t: t.where(C.valid_passengers())),
        "filter_duration": _raw(lambda t: t.where(C.valid_duration())),
        "clean_trips": _clean(lambda t: t),
        "cleaning_report": _raw(C.cleaning_report),
        "quarantine": _raw(lambda t: C.judge(t).where("broken <> 0")),
        "violation_counts": _raw(_violation_counts),
        # Views
        "hourly_stats": _clean(V.hourly_stats),
        "weekday_stats": _clean(V.weekday_stats),
        "monthly_trend": _clean(V.monthly_trend),
        "driver_revenue": _clean(V.driver_revenue),
        "distance_revenue": _clean(V.distance_revenue),
        # The hour is NULL in some views; a double keeps that in any data frame library.
        "all_views": _clean(lambda t: V.all_views(t).withColumn("pickup_hour", F.col("pickup_hour").cast("double"))),
        # Checks
        "month_row_count": _clean(lambda t: M.month_row_count(t, ONE_MONTH)),
        "quality_gate": _clean(lambda t: Q.quality_gate(t, ONE_MONTH)),
        "footer_checks": _footer_checks,
        "quality_gate_raw": _raw(lambda t: Q.quality_gate(t, ONE_MONTH)),
        "health_freshness": lambda spark, folder: Q.freshness(
            inputs.table(spark, folder, "events"), "ts"),
        "health_null_rate": _raw(Q.null_rate),
        "health_avg_fare": _raw(Q.average_fare),
        "health_last_run": lambda spark, folder: Q.last_run(inputs.ledger(spark, folder)),
        "health_report": _health_report,
        "health_summary": lambda spark, folder: Q.health_summary(_health_report(spark, folder)),
        "run_ledger_summary": lambda spark, folder: Q.run_ledger_summary(
            inputs.ledger(spark, folder)),
        # Joins
        "hourly_month_join": _joined(J.hourly_with_month, V.monthly_trend),
        "hourly_weekday_join": _joined(J.hourly_with_weekday, V.weekday_stats),
        "hourly_month_literal_join": _joined(J.hourly_with_month_by_count, V.monthly_trend),
        "hourly_weekday_literal_join": _joined(J.hourly_with_weekday_by_count, V.weekday_stats),
        # Dashboards, windows, top-k
        "hourly_detail": _clean(D.hourly_detail),
        "hour_month_fare": _clean(D.hour_month_fare),
        "weekday_trips": _clean(D.weekday_trips),
        "month_of_year_revenue": _clean(D.month_of_year_revenue),
        "golden_hour_heatmap": _clean(D.golden_hour_heatmap),
        "hour_tip_volume": _clean(D.hour_tip_volume),
        "weekday_revenue": _clean(D.weekday_revenue),
        "weekpart_revenue": _clean(D.weekpart_revenue),
        "weekday_tip_corr": _clean(D.weekday_tip_corr),
        "revenue_mom": _clean(D.revenue_mom),
        "revenue_mom_gaps": _clean(lambda t: D.revenue_mom(M.delete_month_range(t, DELETED))),
        "best_hour_per_weekday": _clean(D.best_hour_per_weekday),
        "top_revenue_slots": _clean(D.top_revenue_slots),
    }
