"""Load month files as they appear, and again when they are replaced."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import Store, load_months
from ..sources.files import Files
from ..sources.raw import MONTH_IN_PATH, path_month
from ..sources.tables import Layout

_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


_SEEN = ("path", "modificationTime", "length")


def new_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """A stream of month files by path; their content is not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(raw_dir)
        .select(*_SEEN)
    )


def present_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """The month files there are now, as the stream describes them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(raw_dir)
    return files.select(*_SEEN).where(F.col("path").rlike(MONTH_IN_PATH))


class TakenFiles:
    """Time and size of every file as it was when its month was loaded.

    Each update is a table of its own; a small file that is put in place in one step names the current
    one, so an interrupted update changes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files = spark, folder, Files(spark)
        self._current = f"{folder}/current.json"

    def _name(self) -> str | None:
        return self.files.read_json(self._current) if self.files.exists(self._current) else None

    def read(self) -> DataFrame | None:
        """``None`` before the first update."""
        name = self._name()
        return self.spark.read.parquet(f"{self.folder}/{name}") if name else None

    def add(self, seen: DataFrame) -> None:
        before, known, name = self._name(), self.read(), f"taken-{uuid.uuid4().hex}"
        seen = seen.select(*_SEEN).dropDuplicates(["path"])
        if known is not None:
            seen = seen.unionByName(known.join(seen.select("path"), "path", "left_anti"))
        seen.coalesce(1).write.parquet(f"{self.folder}/{name}")
        self.files.write_json(self._current, name)
        if before:
            self.files.delete(f"{self.folder}/{before}")

    def replaced(self, present: DataFrame) -> DataFrame:
        """Files that were taken in another state than the one they are in."""
        known = self.read()
        if known is None:
            return present.limit(0)
        old = known.select("path", F.col("modificationTime").alias("_time"), F.col("length").alias("_length"))
        return present.join(old, "path").where(
            (F.col("modificationTime") != F.col("_time")) | (F.col("length") != F.col("_length"))).select(*_SEEN)


def pick_up_months(
    spark: SparkSession, raw_dir: str, store: Store, checkpoint: str | None = None,
    layout: Layout = Layout(),
) -> StreamingQuery:
    """Load every month with files that are new or were replaced, then stop.

    The stream only says which months have news. Such a month is then loaded from all its files,
    so a month whose parts arrive in several batches is still replaced as a whole, and a batch
    that runs twice changes nothing. The stream knows a file by its path; one that was overwritten in
    place is told by its time and size, which are kept beside the stream's state, and its month is
    loaded before the stream starts. All state is beside the trip table, for each raw folder, so it
    belongs to the store: another store on the same folder loads everything. With state of a time when
    sizes were not kept, files count as taken the way they are now.
    """
    folder = hashlib.sha256(raw_dir.rstrip("/").encode()).hexdigest()[:16]
    checkpoint = (checkpoint or f"{store.table.rstrip('/')}-pickup/{folder}").rstrip("/")
    taken = TakenFiles(spark, f"{checkpoint}-taken")
    started_before = bool(Files(spark).names(f"{checkpoint}/commits"))

    def load(files: DataFrame) -> None:
        """Load the months of files; kept are the times from before, so what changes meanwhile is seen next time."""
        # One short row a file, fixed before the load: the folder may change while it runs.
        seen = files.collect()
        if seen:
            files = spark.createDataFrame(seen, files.schema)
            months = files.select(path_month(F.col("path")).alias("month")).distinct().collect()
            load_months(spark, raw_dir, store, [row.month for row in months], layout)
            taken.add(files)

    if started_before:
        if taken.read() is None:
            taken.add(present_files(spark, raw_dir))
        load(taken.replaced(present_files(spark, raw_dir)))

    def take(batch: DataFrame, _: int) -> None:
        load(batch.where(F.col("path").rlike(MONTH_IN_PATH)))

    return (
        new_files(spark, raw_dir).writeStream
        .foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
