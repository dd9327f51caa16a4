"""Tables cut from their lineage, kept in the folder that the whole cluster shares."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a folder of our own only where it is unset (local tests)."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own[app] = "file://" + tempfile.mkdtemp(prefix="lexloom-")
    return _own[app]


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)


def keep(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: a lost executor costs no recomputation of what is
    upstream. The files go with discard(), or when the driver's JVM ends. `files` deals narrow rows out to so many files
    first; a file system may start a process for each file that it makes."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lexloom-{name}-{uuid.uuid4().hex}"
    # no file that only marks success: the table is read only after its job has ended well
    (df.repartition(files) if files else df).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    _delete_on_exit(spark, path)
    trim(spark)
    return resting(spark.read.schema(df.schema).parquet(path), path)


def resting(df: DataFrame, *on: DataFrame | str) -> DataFrame:
    """df, marked as read from kept tables (or their paths), which discard(df) then deletes."""
    df._kept = [path for x in on for path in ([x] if isinstance(x, str) else getattr(x, "_kept", []))]
    return df


def discard(*dfs: DataFrame) -> None:
    """Delete the kept tables that df rests on; for when all that is computed from them has been written."""
    for df in dfs:
        for path in getattr(df, "_kept", []):
            at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def unused(name: str, *dfs: DataFrame) -> str:
    """name, made longer until no column of dfs is called so."""
    taken = {c.lower() for df in dfs for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most so many rows in a batch between JVM and Python (a session setting; a smaller one stays): texts are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, rows)


def trim(spark: SparkSession) -> str | None:
    """Give native memory that the driver's JVM has freed back to the system, and what the JVM says about it: its C library
    keeps what compiled code, plans and buffers have left, in an arena for each of many threads. Takes milliseconds; None
    where a JVM or C library can't."""
    gateway = spark.sparkContext._gateway
    jvm, kind = gateway.jvm, gateway.jvm.java.lang.Class.forName
    try:
        kinds, given = gateway.new_array(jvm.java.lang.Class, 4), gateway.new_array(jvm.java.lang.Object, 4)
        for i, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = kind(name)
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # by the interface, as the class of the server isn't open to callers
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        return kind("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, given)
    except Py4JError:
        return None


def release(spark: SparkSession) -> None:
    """Give memory that is free in this process and in its JVM back to the system: a driver lives long."""
    trim(spark)
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # only some C libraries have it
        pass
