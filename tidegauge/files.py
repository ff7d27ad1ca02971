"""Files by their metadata: listed by Spark, changed through Hadoop's file systems."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED = "path STRING, modified TIMESTAMP, length BIGINT"


class Store:
    """The file system that a path belongs to, and metadata operations on it."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def modified(self, path: str) -> int | None:
        """Milliseconds since 1970, or None where there is no such file."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() if self.exists(path) else None

    def set_modified(self, path: str, milliseconds: int) -> None:
        self._fs.setTimes(self._path(path), milliseconds, -1)

    def create_new(self, path: str) -> bool:
        """Make an empty file unless there is one: of several callers one succeeds."""
        place = self._path(path)
        try:
            return self._fs.createNewFile(place)
        except Py4JJavaError:
            if self._fs.exists(place):
                return False
            raise

    def delete(self, path: str, recursive: bool = False) -> bool:
        return self._fs.delete(self._path(path), recursive)

    def rename(self, path: str, target: str) -> None:
        """Move a file or folder to a name that is free; its parent is made if absent."""
        place = self._path(target)
        self._fs.mkdirs(place.getParent())
        if not self._fs.rename(self._path(path), place):
            raise OSError(f"{path} could not be renamed to {target}")

    def names(self, path: str) -> list[str]:
        """Names directly below a folder; none where it does not exist."""
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))] if self.exists(path) else []


def list_files(spark: SparkSession, source: str, glob: str = "*") -> DataFrame:
    """``path``, ``modified`` and ``length`` of the files at any depth below ``source``; no file is opened.

    The content of binary files is a column like others, and is not asked for. An absent place has no files.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    try:
        found = reader.load(source)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTED)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def milliseconds(at: datetime.datetime) -> int:
    """Milliseconds since 1970; a time without a zone is one of UTC."""
    aware = at if at.tzinfo else at.replace(tzinfo=datetime.UTC)
    return (aware - datetime.datetime(1970, 1, 1, tzinfo=datetime.UTC)) // datetime.timedelta(milliseconds=1)


def paths_of(files: DataFrame) -> Iterator[tuple[str, int]]:
    """Paths and modification times of listed files, a partition at a time."""
    for row in files.select("path", F.unix_millis("modified").alias("at")).toLocalIterator():
        yield row["path"], row["at"]
