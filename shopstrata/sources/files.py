"""Small files and folders on whatever storage Spark reads, by Hadoop's file systems."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Found:
    """An entry of a folder."""

    name: str
    path: str
    modified_ms: int


class Files:
    """The file system of ``root``. Only names and a few bytes pass through the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._path = lambda p: self._jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(self, folder: str) -> list[Found]:
        """What lies in ``folder``; nothing where there is no such folder."""
        if not self._fs.exists(self._path(folder)):
            return []
        return [
            Found(s.getPath().getName(), s.getPath().toString(), s.getModificationTime())
            for s in self._fs.listStatus(self._path(folder))
        ]

    def write(self, path: str, text: str) -> None:
        """A new small file, visible as a whole: written aside and renamed."""
        aside = self._path(f"{path}.part")
        out = self._fs.create(aside, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._fs.rename(aside, self._path(path))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def remove(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)
