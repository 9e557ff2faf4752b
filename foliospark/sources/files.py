"""Small driver-side files in shared storage: write-ahead plans, commit markers, pointers."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder of small text files on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        """The files' names in order, without unfinished ones."""
        if not self._fs.exists(self._path):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path) if s.isFile()]
        return sorted(n for n in found if not n.startswith((".", "_")))

    def read(self, name: str) -> str:
        """A file's text."""
        stream = self._fs.open(self._jvm.org.apache.hadoop.fs.Path(self._path, name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Create a file whole or not at all; False if it exists already."""
        path = self._jvm.org.apache.hadoop.fs.Path
        target, part = path(self._path, name), path(self._path, f".{name}.part")
        if self._fs.exists(target):
            return False
        self._fs.mkdirs(self._path)
        out = self._fs.create(part, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return bool(self._fs.rename(part, target))
