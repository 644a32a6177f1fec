"""Checks answered from Parquet footers; only files whose statistics leave a doubt are read.

A footer tells for each row group its rows and, for a column, its least and greatest value and how many
are NULL. One job reads the footers of a table where its files are, and returns one row per file. What
the statistics decide costs no data page; files with a group they do not decide, or without
statistics, are scanned, where the scan again skips the groups that cannot matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalar import timestamp_literal
from .raw import footer_tasks, listing, open_parquet

_FOOTERS = "path string, rows long, nulls long, low double, high double, known boolean"


_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _number(value) -> float:
    """A statistic as a double; times as microseconds, exact until the year 2255."""
    if isinstance(value, datetime):
        aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        return float((aware - _EPOCH) // timedelta(microseconds=1))
    return float(value)


def _statistics(path: str, column: str) -> tuple:
    with open_parquet(path) as file:
        meta = file.metadata
        names = [meta.schema.column(k).path for k in range(meta.num_columns)]
        at = names.index(column)
        nulls, lows, highs, known = 0, [], [], True
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            stats = group.column(at).statistics
            if stats is None or not stats.has_null_count:
                known = False
                continue
            nulls += stats.null_count
            if stats.has_min_max:
                lows.append(_number(stats.min))
                highs.append(_number(stats.max))
            elif stats.null_count < group.num_rows:
                known = False
        return meta.num_rows, nulls, min(lows, default=None), max(highs, default=None), known


def column_footers(spark: SparkSession, root: str, column: str) -> DataFrame:
    """One row per file: ``rows``, ``nulls``, ``low`` and ``high`` of a column, and whether all are known."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_statistics(uri, column) for uri in batch.column("uri").to_pylist()]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), *columns], ["path", "rows", "nulls", "low", "high", "known"])

    files = listing(spark, root)
    return files.repartition(footer_tasks(files), "uri").mapInArrow(read, _FOOTERS)


@dataclass
class FooterChecks:
    """Counts over a Parquet table, exact, with the files that had to be read in ``scanned``.

    Statistics of floating point columns say nothing about NaN; the stored table has none.
    """

    spark: SparkSession
    root: str
    scanned: list[str] = field(default_factory=list)
    _read: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def _footers(self, column: str) -> DataFrame:
        """The footers of a column, read once however many checks ask; a row a file."""
        if column not in self._read:
            self._read[column] = column_footers(self.spark, self.root, column).persist()
        return self._read[column]

    def _count(self, footers: DataFrame, sure: Column, doubtful: Column, condition: Column) -> int:
        """Rows that are ``sure`` by file, plus those matching ``condition`` in doubtful files."""
        rows = footers.agg(
            F.coalesce(F.sum(F.when(F.col("known"), sure)), F.lit(0)).alias("sure"),
            F.collect_list(F.when(~F.col("known") | doubtful, F.col("path"))).alias("paths")).first()
        self.scanned += rows.paths
        if not rows.paths:
            return int(rows.sure)
        trips = self.spark.read.option("recursiveFileLookup", True).parquet(*rows.paths)
        return int(rows.sure) + trips.where(condition).count()

    def rows(self, column: str) -> int:
        return int(self._footers(column).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])

    def outside(self, column: str, above: float, upto: float) -> int:
        """Values that are not NULL and not in (above, upto]."""
        low, high = F.col("low"), F.col("high")
        footers = self._footers(column)
        clean = low.isNull() | ((low > above) & (high <= upto))
        all_out = (high <= above) | (low > upto)
        return self._count(
            footers, F.when(all_out, F.col("rows") - F.col("nulls")).otherwise(0), ~clean & ~all_out,
            (F.col(column) <= above) | (F.col(column) > upto))

    def nulls(self, column: str) -> int:
        footers = self._footers(column)
        return self._count(footers, F.col("nulls"), F.lit(False), F.col(column).isNull())

    def since(self, column: str, moment: datetime) -> int:
        """Rows of a naive timestamp column at ``moment`` or later."""
        at = F.lit(_number(moment))
        footers = self._footers(column)
        late, mixed = F.col("low") >= at, (F.col("low") < at) & (F.col("high") >= at)
        return self._count(
            footers, F.when(late, F.col("rows") - F.col("nulls")).otherwise(0), mixed,
            F.col(column) >= timestamp_literal(moment))
