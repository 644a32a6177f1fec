"""The stored trip table: Parquet, partitioned by pickup month."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.scalar import interleave, month_start, timestamp_literal, utc_now
from ..schema import MONTH_COLUMN, TABLE_COLUMNS, TABLE_SCHEMA
from .publish import Move, Publication, recover

# Columns of the table that are never NULL.
REQUIRED = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
QUARANTINE_SCHEMA = T.StructType([*TABLE_SCHEMA.fields, T.StructField("broken", T.IntegerType())])


def replace_partitions(frame: DataFrame, path: str, partition: str, **options) -> None:
    """Overwrite the partitions present in ``frame`` and leave all others alone.

    Spark writes to a staging folder and moves whole partitions when the job commits, so a failed
    or retried task never shows: until the commit readers see the old rows.
    """
    (frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(partition)
        .parquet(path))


@dataclass(frozen=True)
class Layout:
    """How a load writes its files; see ``TripTable.stage_months``."""

    layout: str = "as_read"
    max_records_per_file: int = 0
    sort_by_time: bool = False


LAYOUTS = ("as_read", "rebalance", "clustered")


class MissingTable(RuntimeError):
    """The table was never created."""


class TripTable:
    """Cleaned trips at ``path``. The table has no key; a month is the unit of replacement."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def exists(self) -> bool:
        try:
            self.read()
        except MissingTable:
            return False
        return True

    def create(self) -> "TripTable":
        """Create the empty table; an existing one is left as it is."""
        empty = self.spark.createDataFrame([], TABLE_SCHEMA)
        empty.write.mode("ignore").partitionBy(MONTH_COLUMN).parquet(self.path)
        return self

    def read(self, months: Iterable[date] | None = None) -> DataFrame:
        """All trips, or those of some months, whose partitions alone are then read."""
        try:
            trips = self.spark.read.schema(TABLE_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise MissingTable(f"no trip table at {self.path}; create it first") from error
        if months is not None:
            trips = trips.where(F.col(MONTH_COLUMN).isin(list(months)))
        return trips

    def replace_months(self, trips: DataFrame, loaded_at: datetime | None = None, **layout) -> int:
        """Replace every month present in ``trips`` and return the rows written.

        Readers see the old rows until the new ones are written, counted and checked.
        """
        staged = self.stage_months(trips, loaded_at, **layout)
        staged.audit()
        staged.publish()
        return staged.written

    def stage_months(
        self,
        trips: DataFrame,
        loaded_at: datetime | None = None,
        layout: str = "as_read",
        max_records_per_file: int = 0,
        sort_by_time: bool = False,
        quarantine: str | None = None,
    ) -> "StagedMonths":
        """Write trips beside the table, where no reader sees them.

        ``layout="as_read"`` writes from the tasks that read: month files already hold one month
        each, so no row is shuffled. ``layout="rebalance"`` is for input where tasks mix many
        months; adaptive execution cuts a month that is too large into several even files, so a
        month holding most of the rows does not end in one task. ``layout="clustered"`` sorts the
        rows of a month along a curve through its days and hours, so that files and row groups are
        narrow in both, and a filter on either skips most of them.

        With a ``quarantine`` folder, ``trips`` are judged ones (``broken``, ``pickup_month``): the same
        job writes the clean rows for the table and the others, with the rules they break, for it.
        """
        if not self.exists():
            raise MissingTable(f"no trip table at {self.path}; create it first")
        if layout not in LAYOUTS:
            raise ValueError(f"unknown layout: {layout}")
        recover(self.spark, self.path)
        loaded_at = loaded_at or utc_now()
        month = F.col(MONTH_COLUMN) if quarantine else month_start(F.col("tpep_pickup_datetime"))
        columns = [*TABLE_COLUMNS, timestamp_literal(loaded_at).alias("loaded_at"), month.alias(MONTH_COLUMN)]
        keys = [MONTH_COLUMN]
        if quarantine:
            clean = F.col("broken") == 0
            columns += [
                F.nullif("broken", F.lit(0)).alias("broken"),
                F.when(clean, F.lit(KEPT)).otherwise(REJECTED).alias(SIDE)]
            keys = [SIDE, MONTH_COLUMN]
        frame = trips.select(*columns)
        if layout == "rebalance":
            frame = frame.hint("rebalance", *keys)
        elif layout == "clustered":
            # Pieces of the curve are dealt out and balanced like months. No range is sampled for that, as
            # rows that are read twice would be counted twice.
            place = interleave(F.dayofmonth("tpep_pickup_datetime"), F.col("pickup_hour"), 5)
            frame = frame.withColumn("_place", place).withColumn("_piece", F.shiftright("_place", 5))
            frame = frame.hint("rebalance", *keys, "_piece").sortWithinPartitions(
                *keys, "_place", "tpep_pickup_datetime").drop("_place", "_piece")
        if sort_by_time and layout != "clustered":
            frame = frame.sortWithinPartitions(*keys, "tpep_pickup_datetime")
        # Counted in the writing stage itself, where each task's result is taken once.
        counted = Observation()
        seen = frame.observe(counted, F.count(F.lit(1)).alias("rows"))
        load = Publication(self.spark, self.path)
        writer = seen.write.partitionBy(*keys)
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        try:
            writer.parquet(load.new)
        except BaseException:
            load.abandon()
            raise
        return StagedMonths(self, load, counted.get["rows"], quarantine)

    def delete_months(self, months: Iterable[date]) -> list[date]:
        """Remove whole months and return those that were there.

        A month is a folder of its own, so nothing is rewritten; readers that already listed the
        table may still ask for the files.
        """
        recover(self.spark, self.path)
        held = sorted(
            row[MONTH_COLUMN] for row in self.read(months).select(MONTH_COLUMN).distinct().collect())
        if held:
            Publication(self.spark, self.path).publish([Move(_partition(self.path, m)) for m in held])
            self.spark.catalog.refreshByPath(self.path)
        return held

    def month_counts(self, months: Iterable[date] | None = None) -> DataFrame:
        """Rows per month from the partition value and the file footers."""
        return self.read(months).groupBy(MONTH_COLUMN).agg(F.count(F.lit(1)).alias("trip_count"))


# Sides of a staged load that also quarantines.
SIDE, KEPT, REJECTED = "side", "kept", "rejected"


def _partition(root: str, month: date) -> str:
    return f"{root}/{MONTH_COLUMN}={month:%Y-%m-%d}"


class AuditError(RuntimeError):
    """Staged rows are not what the load says they are."""


@dataclass
class StagedMonths:
    """Months written beside the table: check them, then publish or abandon them."""

    table: TripTable
    load: Publication
    written: int
    quarantine: str | None = None
    rows: dict[date, int] = field(default_factory=dict)
    rejected: dict[date, int] = field(default_factory=dict)

    def _side(self, side: str) -> str:
        return f"{self.load.new}/{SIDE}={side}" if self.quarantine else self.load.new

    def _read(self, side: str) -> DataFrame | None:
        path = self._side(side)
        if not self.load.files.exists(path):
            return None
        return self.table.spark.read.schema(TABLE_SCHEMA).parquet(path)

    def audit(self, expected: Mapping[date, int] | None = None) -> None:
        """Count the staged rows and look for NULLs; what does not fit is abandoned and raised.

        ``expected`` are the rows of each month's files, which clean and quarantined ones must add up to.
        Counts come from footers, and the search for NULLs skips row groups that have none.
        """
        try:
            for side, counts in ((KEPT, self.rows), (REJECTED, self.rejected)):
                frame = self._read(side) if side == KEPT or self.quarantine else None
                if frame is not None:
                    by_month = frame.groupBy(MONTH_COLUMN).agg(F.count(F.lit(1)).alias("n"))
                    counts.update((row[MONTH_COLUMN], row.n) for row in by_month.collect())
            self._check(expected)
        except BaseException:
            self.load.abandon()
            raise

    def _check(self, expected: Mapping[date, int] | None) -> None:
        kept = self._read(KEPT)
        if kept is not None:
            missing = [F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED]
            some = kept.where(" or ".join(f"{c} is null" for c in REQUIRED)).agg(*missing).first()
            for name, n in some.asDict().items():
                if n:
                    raise AuditError(f"{name} must not be NULL: {n} rows")
        staged = sum(self.rows.values()) + sum(self.rejected.values())
        if staged != self.written:
            raise AuditError(f"{self.written} rows were written, {staged} are there")
        for month, n in (expected or {}).items():
            found = self.rows.get(month, 0) + self.rejected.get(month, 0)
            if self.quarantine and found != n:
                raise AuditError(f"{month:%Y-%m}: the files have {n} rows, {found} were written")

    def publish(self, months: Iterable[date] = ()) -> None:
        """Put the staged months in place of the old ones.

        A month without a clean row keeps what the table has of it. The quarantine gets the rejected
        rows of every month in ``months`` or staged, and loses older ones.
        """
        moves = [Move(_partition(self.table.path, m), _partition(self._side(KEPT), m)) for m in sorted(self.rows)]
        if self.quarantine:
            moves += [
                Move(_partition(self.quarantine, m),
                     _partition(self._side(REJECTED), m) if m in self.rejected else None)
                for m in sorted({*months, *self.rows, *self.rejected})]
        if not moves:
            self.load.abandon()
            return
        self.load.publish(moves)
        for root in filter(None, (self.table.path, self.quarantine)):
            self.table.spark.catalog.refreshByPath(root)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected trips of the last load of each month; ``pickup_month`` is the month of their file."""
    try:
        return spark.read.schema(QUARANTINE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], QUARANTINE_SCHEMA)


def export_csv(trips: DataFrame, path: str, max_records_per_file: int = 200_000) -> None:
    """Headed CSV for bulk loaders, written in parallel, at most so many rows a file."""
    (trips.select(*TABLE_COLUMNS).write.mode("errorifexists")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("maxRecordsPerFile", max_records_per_file)
        .csv(path))
