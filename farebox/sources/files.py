"""Folders and small files on whatever file system the cluster uses."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Files:
    """Renames, listings and small texts through the file systems Spark itself reads and writes."""

    def __init__(self, spark: SparkSession):
        self._gateway = spark.sparkContext._gateway
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        system, where = self._at(path)
        return system.exists(where)

    def same_system(self, one: str, other: str) -> bool:
        return self._at(one)[0].getUri().equals(self._at(other)[0].getUri())

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        system, where = self._at(path)
        if not system.exists(where):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(where))

    def bytes(self, path: str) -> int:
        system, where = self._at(path)
        return system.getFileStatus(where).getLen()

    def age_seconds(self, path: str) -> float:
        system, where = self._at(path)
        now = self._jvm.java.lang.System.currentTimeMillis()
        return (now - system.getFileStatus(where).getModificationTime()) / 1000

    def make(self, path: str) -> None:
        system, where = self._at(path)
        system.mkdirs(where)

    def move(self, source: str, target: str) -> None:
        """Rename to a name that is free; the folder above it is made."""
        system, where = self._at(source)
        _, to = self._at(target)
        if system.exists(to):
            raise RuntimeError(f"{target} is in the way")
        system.mkdirs(to.getParent())
        if not system.rename(where, to):
            raise RuntimeError(f"could not move {source} to {target}")

    def put_in_place(self, source: str, target: str) -> None:
        """Rename over a file that may exist; readers see the old one or the new one."""
        _, where = self._at(source)
        _, to = self._at(target)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self._conf).rename(where, to, options)

    def delete(self, path: str) -> None:
        system, where = self._at(path)
        if system.exists(where) and not system.delete(where, True):
            raise RuntimeError(f"could not delete {path}")

    def write_json(self, path: str, value) -> None:
        """The file appears under its name when it is complete."""
        unfinished = f"{path}.tmp"
        system, where = self._at(unfinished)
        out = system.create(where, True)
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()
        self.put_in_place(unfinished, path)

    def read_json(self, path: str):
        system, where = self._at(path)
        source = system.open(where)
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()
