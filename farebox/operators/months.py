"""Month coverage, month replacement and target months as DataFrame operations."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import as_timestamp, month_start
from ..schema import MONTH_COLUMN, PUBLICATION_LAG_MONTHS
from ..sources.raw import in_months


def requested_months(bounds: DataFrame) -> DataFrame:
    """One row per month between the dates ``first`` and ``last`` of a one-row frame."""
    return bounds.select(
        F.explode(F.sequence(
            F.trunc("first", "month"), F.trunc("last", "month"), F.expr("INTERVAL 1 MONTH")
        )).alias(MONTH_COLUMN)
    )


def loaded_months(trips: DataFrame) -> DataFrame:
    """Months that have trips. On the stored table this reads partition values only."""
    if MONTH_COLUMN in trips.columns:
        return trips.select(MONTH_COLUMN).distinct()
    return trips.select(month_start(F.col("tpep_pickup_datetime")).alias(MONTH_COLUMN)).distinct()


def month_coverage(requested: DataFrame, loaded: DataFrame) -> DataFrame:
    """Each requested month and whether it is loaded."""
    found = loaded.select(F.col(MONTH_COLUMN).alias("_found"))
    return requested.join(found, F.col(MONTH_COLUMN) == F.col("_found"), "left").select(
        as_timestamp(F.col(MONTH_COLUMN)).alias("month"), F.col("_found").isNotNull().alias("loaded")
    )


def missing_months(requested: DataFrame, loaded: DataFrame) -> DataFrame:
    return requested.join(loaded, MONTH_COLUMN, "left_anti").select(
        as_timestamp(F.col(MONTH_COLUMN)).alias("month")
    )


def in_month_set(trips: DataFrame, months: Iterable[date]) -> DataFrame:
    """Trips picked up in any of the months.

    The stored table keeps whole months in partitions: there the partition value decides, other
    partitions are not opened and the pickup time is not read.
    """
    return trips.where(_in_months(trips, months))


def _in_months(trips: DataFrame, months: Iterable[date]) -> Column:
    if MONTH_COLUMN in trips.columns:
        return F.col(MONTH_COLUMN).isin(list(months))
    return in_months(F.col("tpep_pickup_datetime"), months)


def delete_month_range(trips: DataFrame, months: Iterable[date]) -> DataFrame:
    """Trips outside the months. A NULL pickup lies in no month and stays."""
    return trips.where(~F.coalesce(_in_months(trips, months), F.lit(False)))


def replace_months(trips: DataFrame, incoming: DataFrame, months: Iterable[date]) -> DataFrame:
    """Trips with the given months taken from ``incoming`` instead."""
    months = list(months)
    return delete_month_range(trips, months).unionByName(in_month_set(incoming, months))


def month_row_count(trips: DataFrame, month: date) -> DataFrame:
    return in_month_set(trips, [month]).agg(F.count(F.lit(1)).alias("month_rows"))


def target_month(run: Column, lag: int = PUBLICATION_LAG_MONTHS) -> Column:
    """First day of the month ``lag`` months before the run."""
    return F.trunc(F.add_months(run.cast("date"), -lag), "month")
