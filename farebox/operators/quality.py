"""Quality gate, health checks and ledger reports.

A check here is one row: ``check_name``, ``value``, ``passed``. Filters are written so that Parquet
statistics can answer them: on a cleaned table the search for bad fares, NULL fares or fresh rows
skips nearly every row group instead of scanning the column.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions.scalar import elapsed_hours, ratio, round_half_up, timestamp_literal
from .months import month_row_count
from .summary import is_summary, mean, summarise


def bad_fares(trips: DataFrame) -> DataFrame:
    fare = F.col("fare_amount")
    return trips.where((fare <= 0) | (fare > S.MAX_FARE)).agg(F.count(F.lit(1)).alias("bad_fares"))


def quality_gate(trips: DataFrame, month: date) -> DataFrame:
    """Fails when the month is empty, or when any fare of the whole table is out of range.

    Two small scans instead of one full one: on the stored table the month count needs only the
    footers of that month, and the fare search is answered from statistics where fares are clean.
    """
    counts = bad_fares(trips).select(
        month_row_count(trips, month).scalar().alias("month_rows"), "bad_fares"
    )
    passed = (F.col("month_rows") > 0) & (F.col("bad_fares") == 0)
    return counts.withColumn("passed", passed)


def require_quality(trips: DataFrame, month: date) -> int:
    """Run the gate, raise if it fails, return the month's rows."""
    result = quality_gate(trips, month).first()
    return pass_quality(month, result.month_rows, result.bad_fares)


def pass_quality(month: date, rows: int, bad: int) -> int:
    """The gate's verdict on its two counts: the month's rows, or an error."""
    if rows == 0:
        raise ValueError(f"{month:%Y-%m} has no rows")
    if bad > 0:
        raise ValueError(f"{bad} fares out of range")
    return rows


def _at(moment: datetime | None, frame: DataFrame, column: str) -> Column:
    """A moment as a literal, or the latest one in the frame as a scalar subquery."""
    if moment is not None:
        return timestamp_literal(moment)
    return frame.agg(F.max(column)).scalar()


def _check(name: str, value: Column, passed: Column) -> list[Column]:
    return [
        F.lit(name).alias("check_name"), value.cast("double").alias("value"), passed.alias("passed")
    ]


def freshness(
    frame: DataFrame, column: str = "loaded_at", as_of: datetime | None = None,
    hours: int = S.FRESH_HOURS,
) -> DataFrame:
    """Passes when any row is no older than ``hours`` before ``as_of``."""
    since = _at(as_of, frame, column) - F.make_dt_interval(hours=F.lit(hours))
    recent = frame.where(F.col(column) >= since).agg(F.count(F.lit(1)).alias("n"))
    return recent.select(*_check("fresh_rows", F.col("n"), F.col("n") > 0))


def null_rate(trips: DataFrame, column: str = "fare_amount") -> DataFrame:
    """Percentage of NULLs; an empty table counts as 0 and passes."""
    nulls = trips.where(F.col(column).isNull()).agg(F.count(F.lit(1))).scalar()
    rows = trips.agg(F.count(F.lit(1)).alias("rows"))
    percent = F.coalesce(round_half_up(ratio(nulls * 100.0, F.col("rows")), 2), F.lit(0.0))
    return rows.select(percent.alias("p")).select(
        *_check("null_fare_percent", F.col("p"), F.col("p") < S.MAX_NULL_PERCENT)
    )


def counted_checks(counts: DataFrame) -> DataFrame:
    """Freshness and NULL rate from one row of counts: ``fresh``, ``nulls`` and ``rows``."""
    percent = F.coalesce(round_half_up(ratio(F.col("nulls") * 100.0, F.col("rows")), 2), F.lit(0.0))
    checks = F.array(*[F.struct(*_check(*c)) for c in (
        ("fresh_rows", F.col("fresh"), F.col("fresh") > 0),
        ("null_fare_percent", F.col("percent"), F.col("percent") < S.MAX_NULL_PERCENT))])
    return counts.withColumn("percent", percent).select(F.inline(checks))


def average_fare(source: DataFrame) -> DataFrame:
    """Rounded average fare, of trips or a stored summary; an empty table counts as 0 and fails."""
    mean_fare = mean("fare") if is_summary(source) else F.avg("fare_amount")
    rows = summarise(source, []) if is_summary(source) else source
    shown = F.coalesce(round_half_up(mean_fare, 2), F.lit(0.0)).alias("f")
    fare = rows.select(shown) if is_summary(source) else rows.agg(shown)
    return fare.select(
        *_check("average_fare", F.col("f"), F.col("f").between(S.MIN_AVG_FARE, S.MAX_AVG_FARE))
    )


def last_run(ledger: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The latest run of the ledger and its age; only its status decides. No run, no result."""
    runs = ledger.where(~F.col("status").eqNullSafe(S.DELETED))
    latest = runs.orderBy(F.desc_nulls_last("created_at"), F.desc("id")).limit(1)
    moment = _at(as_of, ledger, "created_at")
    return latest.select(
        "id", "status", "created_at",
        elapsed_hours(moment, F.col("created_at")).alias("hours_ago"),
        (F.col("status") == "success").alias("passed"),
    )


def last_run_check(ledger: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The last run as a check row; a ledger without runs fails."""
    run = last_run(ledger, as_of).agg(
        F.max("hours_ago").alias("hours"),
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("ok"),
    )
    return run.select(*_check("last_run", F.col("hours"), F.col("ok")))


def health_report(
    trips: DataFrame, ledger: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """All four checks, one row each; the trips are read once, for the three checks on them.

    Without a moment to measure from, the latest load time is looked up first.
    """
    since = _at(as_of, trips, "loaded_at") - F.make_dt_interval(hours=F.lit(S.FRESH_HOURS))
    one = trips.agg(
        F.count_if(F.col("loaded_at") >= since).alias("fresh"),
        F.count(F.lit(1)).alias("rows"), F.count("fare_amount").alias("fares"),
        F.coalesce(round_half_up(F.avg("fare_amount"), 2), F.lit(0.0)).alias("fare"))
    nulls = (F.col("rows") - F.col("fares")) * 100.0
    one = one.withColumn(
        "percent", F.coalesce(round_half_up(ratio(nulls, F.col("rows")), 2), F.lit(0.0)))
    checks = F.array(*[F.struct(*_check(*c)) for c in (
        ("fresh_rows", F.col("fresh"), F.col("fresh") > 0),
        ("null_fare_percent", F.col("percent"), F.col("percent") < S.MAX_NULL_PERCENT),
        ("average_fare", F.col("fare"), F.col("fare").between(S.MIN_AVG_FARE, S.MAX_AVG_FARE)),
    )])
    return one.select(F.inline(checks)).unionByName(last_run_check(ledger, as_of))


def health_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.bool_and("passed").alias("all_passed"), F.count_if(~F.col("passed")).alias("failed_checks")
    )


def run_ledger_summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"),
        F.sum("duration_sec").alias("duration_sec"),
        round_half_up(F.avg("duration_sec"), 2).alias("avg_duration_sec"),
        F.max("created_at").alias("last_run"),
    )
