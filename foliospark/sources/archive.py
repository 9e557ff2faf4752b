"""Scanning an archive of pages and companion images.

`archive` is a Python data source: one partition per folder of the upper levels, each walked by a task. It
yields regular files only (no symbolic links), leaves out dot-directories and __MACOSX anywhere and
`backup` at the top, and gives sizes, nanosecond times and, on request, bytes with a status instead of
an exception where a file cannot be read safely.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from foliospark.sources.tables import spread

# Image extensions in order of preference, and directories that are not walked.
IMAGES = (".jpg", ".jpeg", ".png", ".webp")
SKIPPED, SKIPPED_AT_TOP = ("__MACOSX",), ("backup",)
#: Files that one task reads, about.
FILES_A_TASK = 500
#: Folders from which on a scan is not spread any further.
FOLDERS = 256


def _skip(name: str, top: bool) -> bool:
    return name.startswith(".") or name in SKIPPED or (top and name in SKIPPED_AT_TOP)


class _Part(InputPartition):
    def __init__(self, path: str, walk: bool) -> None:
        self.path, self.walk = path, walk


def read_safely(root: str, path: str) -> tuple[str, bytes | None]:
    """(ok, bytes), (missing, None) or (unsafe, None): a regular file below the root, reached through no link."""
    from foliospark.functions.identity import is_safe_relative_path

    if not is_safe_relative_path(path):
        return "unsafe", None
    handle = None
    try:
        folder = os.open(root, os.O_RDONLY | os.O_DIRECTORY)
        try:
            *parents, name = path.split("/")
            for p in parents:
                below = os.open(p, os.O_RDONLY | os.O_DIRECTORY | os.O_NOFOLLOW, dir_fd=folder)
                os.close(folder)
                folder = below
            handle = os.open(name, os.O_RDONLY | os.O_NOFOLLOW, dir_fd=folder)
        finally:
            os.close(folder)
        s = os.fstat(handle)
        if not stat.S_ISREG(s.st_mode) or s.st_nlink != 1:
            return "unsafe", None
        with os.fdopen(handle, "rb") as f:
            handle = None
            return "ok", f.read()
    except FileNotFoundError:
        return "missing", None
    except OSError:
        return "unsafe", None
    finally:
        if handle is not None:
            os.close(handle)


class _Reader(DataSourceReader):
    def __init__(self, root: str, content: bool, suffixes: tuple[str, ...]) -> None:
        self.root, self.content, self.suffixes = root, content, suffixes

    def partitions(self) -> list[InputPartition]:
        """Folders are opened level by level until there are enough for the tasks; those opened are listed by themselves, the others walked."""
        opened, open_ = [], [""]
        while open_ and len(open_) < FOLDERS:
            below = []
            for folder in open_:
                with os.scandir(os.path.join(self.root, folder)) as entries:
                    below += [f"{folder}/{e.name}" if folder else e.name for e in entries if not e.is_symlink() and e.is_dir(follow_symlinks=False) and not _skip(e.name, not folder)]
            opened, open_ = opened + open_, below
        return [*(_Part(n, False) for n in sorted(opened)), *(_Part(n, True) for n in sorted(open_))]

    def read(self, partition: _Part) -> Iterator[tuple]:
        todo = [partition.path]
        while todo:
            folder = todo.pop()
            with os.scandir(os.path.join(self.root, folder)) as entries:
                for e in entries:
                    path = f"{folder}/{e.name}" if folder else e.name
                    if e.is_symlink():
                        continue
                    if e.is_dir(follow_symlinks=False):
                        if partition.walk and not _skip(e.name, False):
                            todo.append(path)
                    elif e.is_file(follow_symlinks=False) and e.name.lower().endswith(self.suffixes):
                        s = e.stat(follow_symlinks=False)
                        status, data = read_safely(self.root, path) if self.content else (None, None)
                        yield path, s.st_size, s.st_mtime_ns, status, data


class ArchiveSource(DataSource):
    """spark.read.format("archive").option("content", ...).option("suffixes", ".html,...").load(root)"""

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return "path string, size long, mtime_ns long, status string, data binary"

    def reader(self, schema) -> DataSourceReader:
        suffixes = tuple(self.options.get("suffixes", ".html").split(","))
        return _Reader(self.options["path"], self.options.get("content", "false").lower() == "true", suffixes)


def listing(spark: SparkSession, root: str, content: bool = False, suffixes: tuple[str, ...] = (".html", *IMAGES)) -> DataFrame:
    """The archive's files; sorted by path where order matters, which is the order of a walk that sorts directories as "name/"."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archive").option("content", str(content)).option("suffixes", ",".join(suffixes)).load(root)


def read_files(paths: DataFrame, root: str, path: str = "path") -> DataFrame:
    """(path, status, data) of files below `root`, read by the tasks; a null path is left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(p, *read_safely(root, p)) for p in pdf["path"]], columns=["path", "status", "data"])

    given = paths.select(F.col(path).alias("path")).filter("path is not null").distinct()
    return spread(given, FILES_A_TASK).mapInPandas(run, "path string, status string, data binary")


def _stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def pair_images(files: DataFrame) -> DataFrame:
    """Each page of a listing (path, size, mtime_ns) with its companion image and warnings.

    The image stands in the page's directory and is named <stem>_main_image, letter case aside; of
    several, the extension's preference decides, then the name. An equi-join on directory and stem.
    """
    folder = F.regexp_replace("path", r"[^/]*$", "")
    name = F.element_at(F.split("path", "/"), -1)
    extension = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    rank = F.array_position(F.array(*map(F.lit, IMAGES)), extension)
    images = files.filter(rank > 0).select(folder.alias("i_folder"), F.lower(_stem(F.col("path"))).alias("i_stem"), rank.alias("i_rank"), F.lower(name).alias("i_low"), name.alias("i_name"), F.col("path").alias("header_image_path"), F.col("size").alias("header_image_size"), F.col("mtime_ns").alias("header_image_mtime_ns"))
    w = Window.partitionBy("i_folder", "i_stem")
    first = images.withColumn("i_n", F.count("*").over(w)).withColumn("i_k", F.row_number().over(w.orderBy("i_rank", "i_low", "i_name"))).filter("i_k = 1")
    pages = files.filter(F.lower("path").endswith(".html")).select(F.col("path").alias("source_html_path"), F.col("size").alias("html_size"), F.col("mtime_ns").alias("html_mtime_ns"), folder.alias("h_folder"), F.concat(F.lower(_stem(F.col("path"))), F.lit("_main_image")).alias("h_stem"))
    j = pages.join(first, (F.col("h_folder") == F.col("i_folder")) & (F.col("h_stem") == F.col("i_stem")), "left")
    warnings = F.when(F.col("i_n").isNull(), F.array(F.lit("missing_image"))).when(F.col("i_n") > 1, F.array(F.lit("multiple_images"))).otherwise(F.array().cast("array<string>"))
    return j.select("source_html_path", "html_size", "html_mtime_ns", "header_image_path", "header_image_size", "header_image_mtime_ns", warnings.alias("warnings"))


def limited(df: DataFrame, limit: int | None, path: str = "source_html_path") -> DataFrame:
    """The first `limit` rows by path (a limited run), or all rows by path."""
    if limit is not None and limit < 1:
        raise ValueError("the limit must be positive")
    return df.orderBy(path) if limit is None else df.orderBy(path).limit(limit)
