"""Write, audit, publish: data is staged beside its table and moved in by renames.

A load writes under ``<root>/_loads/<id>/new``, which readers of the root do not see. Once its rows are
counted and checked there, a journal of all moves is written, and from then on the load will be
complete: if the process ends between two months, the next one carries out what the journal still
names. Before the journal exists nothing of the table is touched, and a failed load leaves only a
folder that is removed later. A root has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .files import Files

LOADS = "_loads"
# Staged data without a journal is removed when it is older; until then its load may be running.
ORPHAN_HOURS = 24


@dataclass(frozen=True)
class Move:
    """``staged`` takes the place of the folder ``target``; without one, the target is removed."""

    target: str
    staged: str | None = None


class Publication:
    """One load's folder under a table's root."""

    def __init__(self, spark: SparkSession, root: str, name: str | None = None):
        self.files = Files(spark)
        self.folder = f"{root}/{LOADS}/{name or uuid.uuid4().hex}"
        self.new = f"{self.folder}/new"
        self._journal = f"{self.folder}/journal.json"

    def publish(self, moves: Sequence[Move]) -> None:
        for move in moves:
            if not self.files.same_system(move.target, self.folder):
                self.abandon()
                raise ValueError(f"{move.target} is on another file system than {self.folder}")
        self.files.write_json(self._journal, [[m.target, m.staged] for m in moves])
        self.finish()

    def journaled(self) -> bool:
        return self.files.exists(self._journal)

    def finish(self) -> list[str]:
        """Carry out the moves of the journal that are not done yet; any number of times."""
        done = []
        for number, (target, staged) in enumerate(self.files.read_json(self._journal)):
            saved = f"{self.folder}/old/{number}"
            if staged and not self.files.exists(staged):
                continue  # it went in before
            if self.files.exists(target) and not self.files.exists(saved):
                self.files.move(target, saved)
            if staged:
                self.files.move(staged, target)
            done.append(target)
        # Without its journal the folder is a leftover, whatever is still in it.
        self.files.delete(self._journal)
        self.files.delete(self.folder)
        return done

    def abandon(self) -> None:
        self.files.delete(self.folder)


def recover(spark: SparkSession, root: str) -> list[str]:
    """Finish the published loads that were interrupted, drop old leftovers; the folders moved."""
    files, moved = Files(spark), []
    for name in files.names(f"{root}/{LOADS}"):
        load = Publication(spark, root, name)
        if load.journaled():
            moved += load.finish()
        elif files.age_seconds(load.folder) > ORPHAN_HOURS * 3600:
            load.abandon()
    if moved:
        spark.catalog.refreshByPath(root)
    return moved
