"""Loading jobs: whole months from raw files into the trip table, rerunnable at will."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.months import month_span, months_of_year, target_month
from ..functions.scalar import utc_now
from ..operators.clean import clean, judge
from ..operators.quality import average_fare, counted_checks, last_run_check, pass_quality
from ..operators.summary import GRAIN, TIME, trip_summary
from ..schema import DELETED, FRESH_HOURS, MAX_FARE, MONTH_COLUMN, PUBLICATION_LAG_MONTHS
from ..sources.footers import FooterChecks
from ..sources.ledger import RunLedger
from ..sources.raw import Rejected, find_months, read_months
from ..sources.tables import Layout, TripTable, replace_partitions


@dataclass(frozen=True)
class Store:
    """Where the trip table, the run ledger and, if kept, the stored summary and rejected rows live.

    The quarantine is on the table's file system, as its months are published by the same renames.
    """

    table: str
    ledger: str
    summary: str | None = None
    quarantine: str | None = None


@dataclass
class LoadResult:
    """What a load did.

    ``raw`` counts the rows of the files, ``quarantined`` those kept apart, ``nulled`` values lost to a cast.
    """

    rows: dict[date, int] = field(default_factory=dict)
    missing: list[date] = field(default_factory=list)
    rejected: list[Rejected] = field(default_factory=list)
    raw: dict[date, int] = field(default_factory=dict)
    nulled: dict[str, int] = field(default_factory=dict)
    quarantined: dict[date, int] = field(default_factory=dict)
    summary_error: str | None = None
    seconds: float = 0.0

    @property
    def total(self) -> int:
        return sum(self.rows.values())

    @property
    def dropped(self) -> dict[date, int]:
        """Rows per month that the rules turned away."""
        return {month: self.raw[month] - n for month, n in self.rows.items()}

    def outcomes(self) -> dict[date, tuple[str, int | None, str | None]]:
        """Status, rows and reason of every requested month."""
        found: dict[date, tuple[str, int | None, str | None]] = {
            m: ("missing", None, "no file") for m in self.missing}
        for entry in self.rejected:
            found.setdefault(entry.file.month, ("rejected", None, f"{entry.file.path} {entry.reason}"))
        for month, rows in self.rows.items():
            found[month] = ("success", rows, None) if rows else ("empty", 0, "no valid row")
        return found


def load_months(
    spark: SparkSession, raw_dir: str, store: Store, months: Iterable[date], layout: Layout = Layout()
) -> LoadResult:
    """Clean the months and put them in place of what the table holds for them.

    Months without a file, with a part that lacks a column or cannot be read, or without a valid row
    keep their old rows. New rows are staged, counted and checked before any month is replaced, so a
    failed load leaves the table as it was; one that ends while months are being replaced is finished by
    the next. The ledger gets a row for every month, with what came of it. The stored summary is brought up to date afterwards; if that fails,
    the load stands, the ledger says so, and readers take those months from the trips.
    """
    months = sorted(set(months))
    table, ledger = TripTable(spark, store.table), RunLedger(spark, store.ledger)
    started = time.monotonic()
    try:
        result = _load(spark, raw_dir, store, table, months, layout)
    except Exception as error:
        ledger.record({m: ("failed", None, str(error)) for m in months})
        raise
    result.seconds = round(time.monotonic() - started, 1)
    ledger.record(result.outcomes(), result.seconds)
    loaded = [m for m, n in result.rows.items() if n]
    if store.summary and loaded:
        try:
            refresh_summary(table, store.summary, loaded)
        except Exception as error:
            result.summary_error = str(error)
            ledger.record({m: ("summary_failed", None, str(error)) for m in loaded})
    return result


def _load(
    spark: SparkSession, raw_dir: str, store: Store, table: TripTable, months: Sequence[date], layout: Layout
) -> LoadResult:
    files = find_months(spark, raw_dir, months)
    found = {f.month for f in files}
    result = LoadResult(missing=[m for m in months if m not in found])
    if not files:
        return result
    raw = read_months(spark, files, watch=True)
    result.rejected, result.raw = raw.rejected, raw.raw_rows
    accepted = sorted({f.month for f in raw.accepted})
    if not accepted:
        return result

    trips = judge(raw.marked) if store.quarantine else clean(raw.trips)
    staged = table.stage_months(trips, utc_now(), quarantine=store.quarantine, **asdict(layout))
    result.nulled = raw.misfit_counts()
    staged.audit(raw.raw_rows)
    staged.publish(accepted)
    result.rows = dict.fromkeys(accepted, 0) | staged.rows
    if store.quarantine:
        result.quarantined = dict.fromkeys(accepted, 0) | staged.rejected
    return result


def refresh_summary(table: TripTable, path: str, months: Iterable[date]) -> None:
    """Bring the stored summary of these months up to date; other months are not read."""
    summary = trip_summary(table.read(months)).hint("rebalance", MONTH_COLUMN)
    replace_partitions(summary, path, MONTH_COLUMN)


def read_summary(table: TripTable, path: str) -> DataFrame:
    """The stored summary; months whose number of trips it has not got are taken from the trips.

    Both sides of that comparison are one short row a month, the table's from file footers.
    """
    try:
        stored = table.spark.read.parquet(path).withColumn(MONTH_COLUMN, F.col(MONTH_COLUMN).cast("date"))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return trip_summary(table.read())
    if GRAIN not in stored.columns:  # kept by an earlier version
        return trip_summary(table.read())
    kept = stored.where(F.col(GRAIN) == TIME).groupBy(MONTH_COLUMN).agg(F.sum("trip_count").alias("kept"))
    both = kept.join(table.month_counts(), MONTH_COLUMN, "full").where(
        ~F.col("kept").eqNullSafe(F.col("trip_count")))
    stale = [row[MONTH_COLUMN] for row in both.select(MONTH_COLUMN).collect()]
    if not stale:
        return stored
    current = stored.where(~F.col(MONTH_COLUMN).isin(stale))
    return current.unionByName(trip_summary(table.read(stale)))


def monthly_load(
    spark: SparkSession, raw_dir: str, store: Store, year: int, months: int | str,
    layout: Layout = Layout(),
) -> LoadResult:
    return load_months(spark, raw_dir, store, months_of_year(year, months), layout)


def backfill(
    spark: SparkSession, raw_dir: str, store: Store, first: str, last: str | None = None,
    layout: Layout = Layout(),
) -> LoadResult:
    """All months from ``first`` to ``last`` (this month unless given) that have a file."""
    span = month_span(first, last or f"{date.today():%Y-%m}")
    return load_months(spark, raw_dir, store, span, layout)


def delete_months(spark: SparkSession, store: Store, months: Iterable[date]) -> list[date]:
    """Remove months from the table and record it; a stored summary no longer counts for them."""
    table, months = TripTable(spark, store.table), list(months)
    held = {row[MONTH_COLUMN]: row.trip_count for row in table.month_counts(months).collect()}
    deleted = table.delete_months(months)
    RunLedger(spark, store.ledger).record({m: (DELETED, held.get(m), None) for m in deleted})
    return deleted


def scheduled_load(
    spark: SparkSession, raw_dir: str, store: Store, run: date | None = None,
    lag: int = PUBLICATION_LAG_MONTHS, layout: Layout = Layout(),
) -> LoadResult:
    """Load the month due at ``run`` and hold it to the quality gate; skip it if not there yet.

    Rows of an earlier load do not stand in for the due one: a rejected or empty file is an error.
    """
    month = target_month(run or date.today(), lag)
    result = load_months(spark, raw_dir, store, [month], layout)
    status, _, reason = result.outcomes()[month]
    if status == "missing":
        return result
    if status == "empty":
        raise ValueError(f"{month:%Y-%m} has no rows: its file holds no valid one")
    if status != "success":
        raise ValueError(f"{month:%Y-%m} was {status}: {reason}")
    require_table_quality(spark, store, month)
    return result


def require_table_quality(spark: SparkSession, store: Store, month: date) -> int:
    """The quality gate on the stored table; footers answer it where all fares are in range."""
    table = TripTable(spark, store.table)
    rows = table.month_counts([month]).first()
    bad = FooterChecks(spark, store.table).outside("fare_amount", 0, MAX_FARE)
    return pass_quality(month, rows.trip_count if rows else 0, bad)


def table_health(spark: SparkSession, store: Store, as_of: datetime) -> DataFrame:
    """The four health checks on the stored table.

    Freshness and NULL rate come from footers; the average fare from the stored summary, if one is kept,
    and from the trips otherwise.
    """
    table, checks = TripTable(spark, store.table), FooterChecks(spark, store.table)
    counts = (
        checks.since("loaded_at", as_of - timedelta(hours=FRESH_HOURS)), checks.nulls("fare_amount"),
        checks.rows("fare_amount"))
    fares = read_summary(table, store.summary) if store.summary else table.read()
    return (
        counted_checks(spark.createDataFrame([counts], "fresh long, nulls long, rows long"))
        .unionByName(average_fare(fares))
        .unionByName(last_run_check(RunLedger(spark, store.ledger).read(), as_of)))
