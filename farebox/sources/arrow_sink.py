"""Hand each partition to a writer as Arrow batches, and count what it took."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import csv, fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .files import Files

#: Takes the batches of one partition and returns how many rows it wrote.
BatchWriter = Callable[[Iterator[pa.RecordBatch]], int]


def count_rows(batches: Iterator[pa.RecordBatch]) -> int:
    return sum(batch.num_rows for batch in batches)


def _write_csv(batches: Iterator[pa.RecordBatch], folder: str, name: str) -> int:
    system, base = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
    system.create_dir(base)
    rows, writer = 0, None
    with system.open_output_stream(f"{base}/{name}") as sink:
        for batch in batches:
            writer = writer or csv.CSVWriter(sink, batch.schema)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer:
            writer.close()
    return rows


def csv_writer(folder: str) -> BatchWriter:
    """Writes each partition to one headed CSV file in a folder that all executors reach.

    The file is named after the partition and appears under that name only when it is complete, so
    a task that runs again puts the same file in its place. The folder as a whole is not committed;
    ``export_partitions`` does that.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> int:
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}.csv"
        rows = _write_csv(batches, folder, f"{name}.{context.taskAttemptId()}")
        system, base = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
        system.move(f"{base}/{name}.{context.taskAttemptId()}", f"{base}/{name}")
        return rows

    return write


MANIFEST = "_MANIFEST.json"


@dataclass(frozen=True)
class Part:
    """A file of a committed export and its rows."""

    name: str
    rows: int


def export_partitions(frame: DataFrame, folder: str) -> list[Part]:
    """Replace a folder's export by one headed CSV file for each partition that has rows.

    Tasks write into a folder of this attempt under names of their own, and report them. A partition
    may be written more than once, when a task is lost or runs twice; the result of the job names one
    file for each. Those are moved into the folder, then the manifest that lists them is put in place of
    the old one, in one step, and then the old export's files go. Readers that go by the manifest see one
    export or the other; a failed one leaves nothing.
    """
    files, attempt = Files(frame.sparkSession), uuid.uuid4().hex
    unfinished = f"{folder}/_attempt-{attempt}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{attempt}.csv"
        own = f"{name}.{context.taskAttemptId()}"
        rows = _write_csv(batches, unfinished, own)
        yield pa.RecordBatch.from_pydict({
            "name": pa.array([name]), "own": pa.array([own]), "rows": pa.array([rows], pa.int64())})

    try:
        # One short row a partition.
        written = frame.mapInArrow(write, "name string, own string, rows long").collect()
        parts = []
        for row in sorted(written):
            if row.rows:
                files.move(f"{unfinished}/{row.own}", f"{folder}/{row.name}")
                parts.append(Part(row.name, row.rows))
    except BaseException:
        for name in files.names(folder):
            if name.endswith(f"-{attempt}.csv"):
                files.delete(f"{folder}/{name}")
        files.delete(unfinished)
        raise
    files.make(folder)
    files.write_json(f"{folder}/{MANIFEST}", [[p.name, p.rows] for p in parts])
    current = {MANIFEST, *(p.name for p in parts)}
    for name in files.names(folder):
        if name not in current:
            files.delete(f"{folder}/{name}")
    return parts


def exported_parts(spark: SparkSession, folder: str) -> list[Part]:
    """The files of the folder's last committed export; none if there was none."""
    files = Files(spark)
    if not files.exists(f"{folder}/{MANIFEST}"):
        return []
    return [Part(*entry) for entry in files.read_json(f"{folder}/{MANIFEST}")]


def write_partitions(frame: DataFrame, writer: BatchWriter = count_rows) -> DataFrame:
    """One ``rows`` value per partition.

    Partitions stay as they are: spreading them over a fixed number of writers would shuffle
    every row. Spark may run a task again after a failure, so a writer with outside effects must
    be able to repeat its partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"rows": pa.array([writer(batches)], pa.int64())})

    return frame.mapInArrow(run, "rows long")


def total_rows(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
