"""Files as sinks: written aside, verified, put in place once, and removed when nothing refers to them.

Tasks write where they run, so a root is a folder that all workers share (a mounted one). Every step can be
repeated: a file that is there with the right hash is left alone.
"""

from __future__ import annotations

import hashlib
import os
import stat
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions.identity import is_safe_relative_path

#: What a file that is being written ends in.
ASIDE = ".part"


def _hash(path: str) -> str | None:
    """The hash of a regular file, read in pieces; None if there is none."""
    try:
        with open(os.open(path, os.O_RDONLY | os.O_NOFOLLOW), "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()
    except OSError:
        return None


def put(root: str, path: str, data: bytes, digest: str, replace: bool) -> str:
    """present, written or conflict: install data at root/path. Without `replace`, a file of another content stays."""
    if not is_safe_relative_path(path):
        raise ValueError("unsafe path")
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError(f"{path}: the data do not have the hash given")
    target = os.path.join(root, path)
    if (have := _hash(target)) == digest:
        return "present"
    if have is not None and not replace:
        return "conflict"
    os.makedirs(os.path.dirname(target), exist_ok=True)
    aside = f"{target}.{uuid.uuid4().hex}{ASIDE}"
    try:
        with open(aside, "xb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        if _hash(aside) != digest:
            raise OSError(f"{path}: what was written is not what was given")
        if replace:
            os.replace(aside, target)
        else:
            try:
                os.link(aside, target)  # fails if another task was faster
            except FileExistsError:
                return "present" if _hash(target) == digest else "conflict"
        return "written"
    finally:
        if os.path.exists(aside):
            os.remove(aside)


def write_files(files: DataFrame, root: str, replace: bool = False) -> DataFrame:
    """(path, sha256, outcome) of files (path, sha256, data) installed below root; rows without data are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(p, h, put(root, p, bytes(d), h, replace)) for p, h, d in zip(pdf["path"], pdf["sha256"], pdf["data"])], columns=["path", "sha256", "outcome"])

    return files.filter("data is not null").select("path", "sha256", "data").mapInPandas(run, "path string, sha256 string, outcome string")


def tree(spark, root: str, prefix: str = "") -> DataFrame:
    """(path, sha256, kind) of everything below root/prefix: kind is file, temp (left behind while being written) or other (no regular file)."""
    below = os.path.join(root, prefix)
    folders = [prefix, *(os.path.join(prefix, e.name) for e in os.scandir(below) if e.is_dir(follow_symlinks=False))] if os.path.isdir(below) else []

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for folder in pdf["folder"]:
                rows, todo = [], [folder]
                while todo:
                    at = todo.pop()
                    for e in os.scandir(os.path.join(root, at)):
                        path = os.path.join(at, e.name)
                        if e.is_dir(follow_symlinks=False):
                            todo += [path] if folder != prefix else []
                        elif not stat.S_ISREG(e.stat(follow_symlinks=False).st_mode):
                            rows.append((path, None, "other"))
                        else:
                            rows.append((path, _hash(os.path.join(root, path)), "temp" if e.name.endswith(ASIDE) else "file"))
                yield pd.DataFrame(rows, columns=["path", "sha256", "kind"])

    frame = spark.createDataFrame([(f,) for f in folders], "folder string")
    return frame.repartition(max(1, len(folders)), "folder").mapInPandas(walk, "path string, sha256 string, kind string")


def remove_orphans(listing: DataFrame, references: DataFrame, root: str, path: str = "path") -> DataFrame:
    """(path, removed): listed files and leftovers that nothing refers to, deleted; anything that is no regular file stays."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                target = os.path.join(root, p)
                fits = is_safe_relative_path(p) and os.path.isfile(target) and not os.path.islink(target)
                if fits:
                    os.remove(target)
                rows.append((p, fits))
            yield pd.DataFrame(rows, columns=["path", "removed"])

    kept = references.select(F.col(path).alias("kept_path")).filter("kept_path is not null").distinct()
    stray = listing.filter("kind in ('file', 'temp')").join(kept, F.col("path") == F.col("kept_path"), "left_anti")
    return stray.select("path").mapInPandas(run, "path string, removed boolean")
