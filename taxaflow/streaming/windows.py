"""Structured Streaming over files of events: windows with watermarks, and resumption."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tumbling(stream: DataFrame, ts: str, keys: Sequence[str], value: str, length: str, late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """(start, keys, n, total) of event-time windows; rows later than the watermark are dropped by the engine."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    grouped = timed.withWatermark(ts, late).groupBy(window.alias("w"), *keys)
    return grouped.agg(F.count("*").alias("n"), F.round(F.sum(value), 6).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def distinct_events(stream: DataFrame, ts: str, keys: Sequence[str], late: str = "1 hour") -> DataFrame:
    """The first event of each key within the watermark."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path under spark.checkpoint.dir, the folder that driver and executors share; in tests it can be unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='taxaflow-')}"
    return f"{root}/streams/{label}-{uuid.uuid4().hex}"


def run_available(spark: SparkSession, stream: DataFrame, mode: str = "append", sink: Callable[[DataFrame, int], None] | None = None, checkpoint: str | None = None) -> DataFrame | None:
    """Process all that is there once. Without a sink, the result is written to files and read back.

    With a checkpoint of an earlier run, only what came since is processed.
    """
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint or shared_folder(spark, "checkpoint"))
    if sink:
        writer.foreachBatch(sink).start().awaitTermination()
        return None
    path = shared_folder(spark, "out")
    if mode == "complete":
        writer.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).start().awaitTermination()
    else:
        writer.format("parquet").option("path", path).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def tumbling_from_files(spark: SparkSession, path: str, ts: str, keys: Sequence[str], value: str, length: str) -> DataFrame:
    """Tumbling windows of all events in a parquet path, by the streaming engine."""
    schema = spark.read.parquet(path).schema
    parent, _, name = path.rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{parent}/{name}*")
    return run_available(spark, tumbling(stream, ts, keys, value, length), mode="complete")
