"""The run ledger: one appended row per requested month and load, whatever came of it.

A load adds one small file. When there are many, they are merged into one: the merged file appears by a
rename, then the others go. In between, or if that is interrupted, rows are there twice under the same id,
and readers count an id once. Files that have grown large are left as they are.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..functions.scalar import utc_now
from ..schema import LEDGER_SCHEMA
from .files import Files

# Small files that may pile up before they are merged, and what counts as small.
COMPACT_FILES, SMALL_BYTES = 64, 32 << 20


class RunLedger:
    def __init__(self, spark: SparkSession, path: str, compact_files: int = COMPACT_FILES):
        self.spark = spark
        self.path = path
        self.compact_files = compact_files

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path).dropDuplicates(["id"])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def record(
        self, outcomes: dict[date, tuple[str, int | None, str | None]], duration_sec: float | None = None,
        at: datetime | None = None,
    ) -> None:
        """One row per month: its status, rows and reason.

        The time of a load of several months is divided among those it loaded, so sums over the
        ledger are times that passed.
        """
        loaded = sum(status == "success" for status, _, _ in outcomes.values())
        share = duration_sec / loaded if duration_sec is not None and loaded else None
        self._append([
            (m, rows, status, reason, share if status == "success" else None)
            for m, (status, rows, reason) in sorted(outcomes.items())], at)

    def _append(self, entries: list[tuple], at: datetime | None) -> None:
        if not entries:
            return
        at = at or utc_now()
        rows = [
            (str(uuid.uuid4()), month.year, month.month, loaded, status, error, seconds, at)
            for month, loaded, status, error, seconds in entries
        ]
        self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        self.compact()

    def _small(self, files: Files) -> list[str]:
        names = [f"{self.path}/{n}" for n in files.names(self.path) if n.endswith(".parquet")]
        return [n for n in names if files.bytes(n) < SMALL_BYTES] if len(names) > self.compact_files else []

    def compact(self) -> int:
        """Merge small files if there are too many of them, and return how many were."""
        files = Files(self.spark)
        small = self._small(files)
        if len(small) <= self.compact_files:
            return 0
        merging = f"{self.path}/_merging-{uuid.uuid4().hex}"
        rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(*small).dropDuplicates(["id"])
        rows.coalesce(1).write.parquet(merging)
        for name in files.names(merging):
            if name.endswith(".parquet"):
                files.move(f"{merging}/{name}", f"{self.path}/merged-{name}")
        for name in small:
            files.delete(name)
        files.delete(merging)
        self.spark.catalog.refreshByPath(self.path)
        return len(small)
