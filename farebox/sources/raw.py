"""Raw month files: discovery, schema gate, and one scan per distinct schema.

A month is a Parquet file, or a directory of part files, whose name ends in ``YYYY-MM.parquet``.
Column names differ in case and types differ between years. Spark cannot read a bigint column and
a double column in one scan, so months are grouped by the types of the needed columns. The plan
grows with the number of distinct schemas, not with the number of months.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.months import month_bounds
from ..functions.scalar import month_start
from ..schema import MONTH_COLUMN, RAW_COLUMNS, TRIP_SCHEMA

#: Finds the month in a path; the part before it is the month's own file or directory.
MONTH_IN_PATH = r"^(.*?(\d{4}-(?:0[1-9]|1[0-2]))\.parquet)(?:/|$)"

# Footers that a task reads, and tasks at most.
_FOOTERS_PER_TASK, _FOOTER_TASKS = 16, 2_000


@dataclass(frozen=True, order=True)
class MonthFile:
    """A file or directory of one month; ``uri`` is how row metadata spell its path."""

    month: date
    path: str
    uri: str


@dataclass(frozen=True)
class Rejected:
    """A part file that keeps its month from being loaded."""

    file: MonthFile
    missing: tuple[str, ...]
    error: str | None = None

    @property
    def reason(self) -> str:
        return f"cannot be read: {self.error}" if self.error else f"lacks {', '.join(self.missing)}"


@dataclass
class RawMonths:
    """Normalised trips of the accepted months, and what the schema gate turned away.

    ``trips`` are those picked up in the month of their file. ``marked`` are all rows of the files, with
    ``own_month`` for that test and ``pickup_month`` for the file's month.
    """

    trips: DataFrame
    marked: DataFrame
    accepted: list[MonthFile]
    rejected: list[Rejected]
    raw_rows: dict[date, int] = field(default_factory=dict)
    watched: list[Observation] = field(default_factory=list)

    def misfit_counts(self) -> dict[str, int]:
        """Values per column that did not fit its type and became NULL, in files that were watched.

        They are counted by the job that read the rows, so this waits for it.
        """
        counts: dict[str, int] = {}
        for seen in self.watched:
            for name, n in seen.get.items():
                counts[name] = counts.get(name, 0) + n
        return {name: n for name, n in counts.items() if n}

    def gate_report(self) -> DataFrame:
        rows = [(f.month, f.path, True, None) for f in self.accepted]
        rows += [
            (r.file.month, r.file.path, False, ", ".join(r.missing) or r.error) for r in self.rejected]
        return self.trips.sparkSession.createDataFrame(
            rows, "month date, path string, accepted boolean, missing_columns string"
        )


def path_month(path: Column) -> Column:
    """Month named in a file path, as a date."""
    return F.to_date(F.concat(F.regexp_extract(path, MONTH_IN_PATH, 2), F.lit("-01")))


def listing(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Parquet files under ``root``.

    The binary-file source lists on any file system Spark can read, and reads no file content as
    long as none is asked for. A filter on ``uri`` is answered from the listing, before tasks are
    made.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", F.col("_metadata.file_path").alias("uri"))
    )


def listed_months(
    spark: SparkSession, root: str, months: Iterable[date] | None = None
) -> DataFrame:
    """``(month, path, uri)``, one row per month found under ``root``, all or the wanted ones."""
    files = listing(spark, root)
    if months is not None:
        names = "|".join(sorted(f"{m:%Y-%m}" for m in set(months))) or "(?!)"
        files = files.where(F.col("uri").rlike(rf"(?:{names})\.parquet(?:/|$)"))
    return (
        files
        .where(F.col("uri").rlike(MONTH_IN_PATH))
        .select(path_month(F.col("path")).alias("month"),
                *[F.regexp_extract(c, MONTH_IN_PATH, 1).alias(c) for c in ("path", "uri")])
        .distinct()
    )


def find_months(
    spark: SparkSession, root: str, months: Iterable[date] | None = None
) -> list[MonthFile]:
    """Month files under ``root``, all or only the wanted ones, in month order."""
    months = None if months is None else list(months)
    found = listed_months(spark, root, months)
    if months is not None:
        found = found.where(F.col("month").isin(months))
    return sorted(MonthFile(*row) for row in found.collect())


def normalise(raw: DataFrame, *extra: Column) -> DataFrame:
    """The eight needed columns under their lower-case names and fixed types, plus ``extra``.

    A value that does not fit its type becomes NULL, so one bad cell cannot stop a load; ``misfits``
    counts them. Times with a zone are taken in UTC, whatever the session's zone is.
    """
    types = {f.name.lower(): f.dataType for f in raw.schema}
    columns = []
    for source, target in zip(RAW_COLUMNS, TRIP_SCHEMA):
        column = F.col(source)
        # A column that already has its type stays bare: its filters then reach the scan.
        if types[source] == T.TimestampType():
            column = _in_utc(column)
        elif types[source] != target.dataType:
            column = column.try_cast(target.dataType)
        columns.append(column.alias(target.name))
    return raw.select(*columns, *extra)


def _in_utc(column: Column) -> Column:
    seconds = F.unix_micros(column).cast("decimal(20,0)") / 1_000_000
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def misfits(raw: DataFrame) -> list[Column]:
    """Counts of the values that do not fit their type, of the columns where that may be."""
    types = {f.name.lower(): f.dataType for f in raw.schema}
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    numbers = (*whole, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    counts = []
    for source, target in zip(RAW_COLUMNS, TRIP_SCHEMA):
        kind = types[source]
        safe = kind in (target.dataType, T.TimestampType()) or (
            isinstance(kind, numbers if target.dataType == T.DoubleType() else whole))
        if not safe:
            column = F.col(source)
            lost = column.isNotNull() & column.try_cast(target.dataType).isNull()
            counts.append(F.count_if(lost).alias(target.name))
    return counts


def missing_columns(schema: T.StructType) -> tuple[str, ...]:
    present = {name.lower() for name in schema.names}
    return tuple(c for c in RAW_COLUMNS if c not in present)


def footer_tasks(files: DataFrame) -> int:
    """Tasks to read the footers of a listing; the driver has the listing, so no job is run."""
    return max(1, min(_FOOTER_TASKS, -(-len(files.inputFiles()) // _FOOTERS_PER_TASK)))


@contextmanager
def open_parquet(path: str):
    """A file by the path its rows' metadata spell; used on executors."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    # Row metadata spell local paths with one slash and escape what a URI must escape.
    scheme, _, rest = path.partition(":/")
    local = scheme == "file"
    system, name = (fs.LocalFileSystem(), unquote("/" + rest.lstrip("/"))) if local else fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as source:
        yield pq.ParquetFile(source)


def _footer(path: str) -> dict:
    """Rows, missing columns and types of a part file, or why it cannot be read."""
    from pyspark.sql.pandas.types import from_arrow_type

    try:
        with open_parquet(path) as file:
            types = {}
            for name, kind in zip(file.schema_arrow.names, file.schema_arrow.types):
                if name.lower() in RAW_COLUMNS:
                    types[name.lower()] = from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()
            for k in range(len(file.schema)):
                column = file.schema.column(k)
                if column.physical_type == "INT96" and column.path.lower() in types:
                    types[column.path.lower()] = "timestamp"
            missing = [c for c in RAW_COLUMNS if c not in types]
            ddl = None if missing else ", ".join(f"{c} {types[c]}" for c in RAW_COLUMNS)
            return {"rows": file.metadata.num_rows, "missing": missing, "ddl": ddl, "error": None}
    except Exception as error:  # a broken file is reported with its month, it does not stop the others
        return {"rows": None, "missing": [], "ddl": None, "error": str(error)[:300]}


def _footers(spark: SparkSession, root_files: Sequence[MonthFile]) -> list:
    """One row per month, place and schema, with its rows and parts.

    All footers are read in one job, by the tasks that have the paths; a row names its parts, which
    become the roots of the scan where the parts of a month differ.
    """
    def read(batches):
        for batch in batches:
            out = [_footer(uri) for uri in batch.column("uri").to_pylist()]
            columns = [batch.column(k) for k in range(3)] + [
                pa.array([o["rows"] for o in out], pa.int64()),
                pa.array([o["missing"] for o in out], pa.list_(pa.string())),
                pa.array([o["ddl"] for o in out], pa.string()),
                pa.array([o["error"] for o in out], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "uri", "root", "rows", "missing", "ddl", "error"])

    files = listing(spark, sorted({f.path for f in root_files}))
    parts = files.select("path", "uri", F.regexp_extract("uri", MONTH_IN_PATH, 1).alias("root"))
    read_parts = parts.repartition(footer_tasks(files), "uri").mapInArrow(
        read, "path string, uri string, root string, rows long, missing array<string>, ddl string, error string")
    return read_parts.groupBy("root", "ddl", "missing", "error").agg(
        F.sum("rows").alias("rows"), F.sort_array(F.collect_list("path")).alias("parts")).collect()


def in_own_month(pickup: Column, uri: Column, files: Sequence[MonthFile]) -> Column:
    """Whether a row was picked up in the month its file is named after.

    ``files`` gives each month one ``uri``. The month of the row picks the path it must have come
    from: an array access and a comparison of bytes. Cutting the month out of the path for every
    row costs several times as much.
    """
    number = {f.month.year * 12 + f.month.month: f.uri for f in files}
    first = min(number)
    uris = F.array(*[F.lit(number.get(n)) for n in range(first, max(number) + 1)])
    return uri.startswith(F.get(uris, F.year(pickup) * 12 + F.month(pickup) - first))


def in_months(pickup: Column, months: Iterable[date]) -> Column:
    """Half-open ranges on the timestamp itself, which Parquet statistics can answer."""
    ranges = [
        (pickup >= F.lit(low).cast("timestamp_ntz")) & (pickup < F.lit(high).cast("timestamp_ntz"))
        for low, high in month_bounds(months)
    ]
    return reduce(lambda a, b: a | b, ranges, F.lit(False)) if ranges else F.lit(False)


def read_months(spark: SparkSession, files: Sequence[MonthFile], watch: bool = False) -> RawMonths:
    """Scan month files that may differ in schema; foreign-month rows are dropped.

    A month is taken whole or not at all: if one of its parts lacks a column or cannot be read, all
    its parts are turned away, and the report names that part. With ``watch`` the one job that reads
    the rows also counts the values lost to casts; no filter is then pushed into scans that may lose
    any, as all their rows are needed.
    """
    month_of = {f.uri: f for f in files}
    footers = [row for row in _footers(spark, files) if row.root in month_of] if files else []
    rejected = sorted(
        (Rejected(MonthFile(month_of[row.root].month, part, row.root), tuple(row.missing), row.error)
         for row in footers if row.ddl is None for part in row.parts), key=lambda r: r.file)
    turned_away = {r.file.month for r in rejected}
    accepted = [f for f in files if f.month not in turned_away]

    schemas: dict[str, int] = {}
    for row in footers:
        schemas[row.root] = schemas.get(row.root, 0) + 1
    # One scan per schema; another one where a month is found in a second place.
    groups: dict[tuple[str, int], tuple[list[str], list[MonthFile]]] = {}
    places: dict[tuple[str, date], list[str]] = {}
    raw_rows: dict[date, int] = {}
    for row in sorted(footers, key=lambda r: (r.root, r.ddl or "")):
        file = month_of[row.root]
        if file.month in turned_away:
            continue
        raw_rows[file.month] = raw_rows.get(file.month, 0) + row.rows
        known = places.setdefault((row.ddl, file.month), [])
        known.append(row.root)
        paths, members = groups.setdefault((row.ddl, len(known) - 1), ([], []))
        paths.extend(row.parts if schemas[row.root] > 1 else [file.path])
        members.append(file)

    pickup = F.col("tpep_pickup_datetime")
    branches, marked, watched = [], [], []
    for (ddl, _), (paths, members) in groups.items():
        scan = spark.read.schema(ddl).option("recursiveFileLookup", True).parquet(*paths)
        rows = scan.select("*", F.col("_metadata.file_path").alias("uri"))
        lossy = misfits(scan) if watch else []
        if lossy:
            watched.append(Observation())
            rows = rows.observe(watched[-1], *lossy)
        trips = normalise(rows, F.col("uri"))
        in_file = in_months(pickup, [m.month for m in members])
        own = in_own_month(pickup, F.col("uri"), members)
        branches.append(trips.where(in_file).where(own).drop("uri"))
        # The path is taken apart for rows of other months only.
        file_month = F.when(in_file & own, month_start(pickup)).otherwise(path_month(F.col("uri")))
        marked.append(trips.select(
            *TRIP_SCHEMA.names, F.coalesce(in_file & own, F.lit(False)).alias("own_month"),
            file_month.alias(MONTH_COLUMN)))
    if not branches:
        branches.append(spark.createDataFrame([], TRIP_SCHEMA))
        marked.append(branches[0].select(
            "*", F.lit(True).alias("own_month"), F.lit(None).cast("date").alias(MONTH_COLUMN)))
    return RawMonths(
        reduce(DataFrame.unionByName, branches), reduce(DataFrame.unionByName, marked), accepted, rejected,
        raw_rows, watched)


def row_count(trips: DataFrame) -> DataFrame:
    """Rows of the input; no column is read, Parquet footers answer it."""
    return trips.agg(F.count(F.lit(1)).alias("raw_rows"))
