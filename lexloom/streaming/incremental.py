"""Incremental runs: what is new, what is done, and file streams into counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def run_key(*parts: Column) -> Column:
    """A fingerprint of all inputs of a run."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])), 256)


def missing(wanted: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Rows whose key isn't done yet; all of them with force."""
    return wanted if force else wanted.join(done.select(F.col(key).alias("__d")).distinct(), F.col(key) == F.col("__d"), "left_anti")


def refreshed(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """old with new values; a new value of 0 or none keeps the old one."""
    n = new.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    return old.join(n, F.col(key) == F.col("__k"), "left").withColumn(value, F.coalesce(F.nullif(F.col("__v"), F.lit(0)), F.col(value))).drop("__k", "__v")


def file_stream(spark: SparkSession, path: str, schema: str, each: Callable[[DataFrame, int], None], checkpoint: str, form: str = "json") -> None:
    """Each new file of a folder once, in micro-batches, until none is left; the checkpoint remembers which were seen."""
    stream = spark.readStream.schema(schema).format(form).load(path)
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by tumbling window and key. An addition: batch or stream, late rows within the watermark count."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")
