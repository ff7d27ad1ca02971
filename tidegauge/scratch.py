"""Folders for data a job writes and reads again."""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import SparkSession

_made: dict[str, list[str]] = defaultdict(list)


def shared_base(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the one given to ``setCheckpointDir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet. `release` deletes it."""
    path = f"{shared_base(spark)}/tidegauge/{label}-{uuid.uuid4().hex}"
    _made[spark.sparkContext.applicationId].append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete what this application has put into its fresh folders; how many there were.

    Frames are evaluated late and may still read them: call this when results are stored elsewhere.
    """
    context = spark.sparkContext
    paths = _made.pop(context.applicationId, [])
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)
