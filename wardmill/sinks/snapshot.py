"""Snapshots: many tables, or many parts of one, that change together or not at all.

Data is only ever added, each load in folders of its own. A snapshot is one small file that names the
folder of every part; it is complete once it has been renamed to its version. Readers take the
highest version, so during a load, and after one that failed, they see the state before it whole.
Two writers cannot both make a version: the second one's rename fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_snapshots"


class Conflict(RuntimeError):
    """Another writer has made the next version."""


@dataclass(frozen=True)
class Snapshot:
    """``parts`` maps names to folders below the root; ``progress`` has the last load of each source."""

    version: int = 0
    parts: Mapping[str, str] = field(default_factory=dict)
    progress: Mapping[str, int] = field(default_factory=dict)


class Store:
    """The snapshots below one folder of any file system Spark can write to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        path = self._path(self.root)
        self._fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/{MANIFESTS}/{version:012d}.json"

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        folder = self._path(f"{self.root}/{MANIFESTS}")
        if not self._fs.exists(folder):
            return []
        names = [str(f.getPath().getName()) for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version: int | None = None) -> Snapshot:
        """A version, or the latest; an empty one before the first."""
        if version is None:
            known = self.versions()
            if not known:
                return Snapshot()
            version = known[-1]
        stream = self._fs.open(self._path(self._manifest(version)))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return Snapshot(**json.loads(text))

    def new_folder(self, name: str) -> str:
        """A folder, relative to the root, that no other load writes to."""
        return f"{name}/load={uuid.uuid4().hex}"

    def commit(self, base: Snapshot, parts: Mapping[str, str], progress: Mapping[str, int] = {}) -> Snapshot:
        """The version after ``base``, with these parts in place of its own ones."""
        made = Snapshot(base.version + 1, {**base.parts, **parts}, {**base.progress, **progress})
        folder = self._path(f"{self.root}/{MANIFESTS}")
        self._fs.mkdirs(folder)
        draft = self._path(f"{self.root}/{MANIFESTS}/.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(made.__dict__, sort_keys=True).encode()))
        finally:
            out.close()
        final = self._path(self._manifest(made.version))
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise Conflict(f"version {made.version} of {self.root} is already there")
        return made

    def table(self, snapshot: Snapshot, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{snapshot.parts[name]}")

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """All tables of one snapshot."""
        snapshot = self.read(version)
        return {name: self.table(snapshot, name) for name in snapshot.parts}

    def expire(self, keep: int = 2) -> int:
        """Drop all but the last ``keep`` versions, and the data only they name; returns how many.

        Not to be called while a load is running: its folders are in no version yet.
        """
        known = self.versions()
        old, kept = known[:-keep], known[-keep:]
        named = {folder for v in kept for folder in self.read(v).parts.values()}
        gone = {folder for v in old for folder in self.read(v).parts.values()} - named
        for version in old:  # first the names, so that no reader is sent to what is being deleted
            self._fs.delete(self._path(self._manifest(version)), False)
        for folder in sorted(gone):
            self._fs.delete(self._path(f"{self.root}/{folder}"), True)
        return len(old)
