"""A folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: By application: a folder of our own, where the session names none, and the paths given out.
_own: dict[str, str] = {}
_given: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where that is unset, a folder of our own if driver and executors are one
    machine, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        application = spark.sparkContext.applicationId
        found = _own[application] = _own.get(application) or "file://" + tempfile.mkdtemp(prefix="spark-")
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Remove what this application has written to the paths given out: results that are made of it must have been
    written by then."""
    for path in _given.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
