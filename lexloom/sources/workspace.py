"""A folder for small files of a run, where all executors see it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, or below a folder of our own where that is unset and the session is local.
    It goes when the driver's JVM ends."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        app = spark.sparkContext.applicationId
        if app not in _own:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            _own[app] = "file://" + tempfile.mkdtemp(prefix="lexloom-files-")
        at = _own[app]
    path = f"{at.rstrip('/')}/lexloom-{name}-{uuid.uuid4().hex}"
    on = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = on.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(on)
    fs.deleteOnExit(on)
    return path
