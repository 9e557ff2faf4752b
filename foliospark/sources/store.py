"""A store of versioned snapshots: immutable Parquet tables behind one atomically created version file.

A commit writes the changed tables to fresh folders and then creates `versions/<n>.json`, which names
the folder of every table. The file is created whole or not at all, so readers see all of a commit or
nothing of it, and of two writers that start from the same version only one succeeds.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from foliospark import schemas
from foliospark.sources.files import Folder


class ConcurrentCommit(RuntimeError):
    """Another writer has committed in the meantime."""


class Store:
    """Tables of one catalogue under a root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._versions = Folder(spark, f"{self.root}/versions")

    def version(self) -> int:
        """The latest version; 0 before the first commit."""
        names = self._versions.names()
        return int(names[-1].split(".")[0]) if names else 0

    def tables(self, version: int | None = None) -> dict[str, str]:
        v = self.version() if version is None else version
        return json.loads(self._versions.read(f"{v:012d}.json"))["tables"] if v else {}

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of a version; an empty one if it was never written."""
        path = self.tables(version).get(name)
        if path is None:
            return self.spark.createDataFrame([], schemas.schema(name))
        return schemas.check(self.spark.read.parquet(path), name)

    def commit(self, changed: dict[str, DataFrame], base: int | None = None, note: dict | None = None) -> int:
        """Write the changed tables and make them visible together; `base` is the version they were derived from."""
        base = self.version() if base is None else base
        tables = self.tables(base)
        for name, df in changed.items():
            path = f"{self.root}/data/{name}/{base + 1:012d}-{uuid.uuid4().hex[:8]}"
            schemas.check(df, name).write.option("compression", "zstd").parquet(path)
            tables[name] = path
        if self.version() != base or not self._versions.create(f"{base + 1:012d}.json", json.dumps({"tables": tables, "note": note or {}}, sort_keys=True)):
            raise ConcurrentCommit(f"version {base + 1} exists")
        return base + 1


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `new`, and rows of `old` whose key `new` does not have."""
    return old.join(new.select(*key).distinct(), key, "left_anti").select(*new.columns).unionByName(new)


def insert_ignore(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `old`, and rows of `new` whose key `old` does not have."""
    return old.unionByName(new.join(old.select(*key).distinct(), key, "left_anti").select(*old.columns))


def replace_groups(old: DataFrame, new: DataFrame, group: str, affected: DataFrame) -> DataFrame:
    """`old` without the groups in `affected`, and all of `new`."""
    return old.join(affected.select(group).distinct(), group, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def orphans(listing: DataFrame, references: DataFrame, path: str = "path") -> DataFrame:
    """Listed paths that nothing refers to."""
    return listing.join(references.select(path).distinct(), path, "left_anti")
