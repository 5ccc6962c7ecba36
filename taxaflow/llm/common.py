"""Shared plumbing: reading tables, tables kept in the cluster's shared folder, sizes."""

from __future__ import annotations

import ctypes
import math
import re
import tempfile
import uuid
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group of kept tables: what a writing task holds in memory.
ROW_GROUP = 16 << 20
#: ASCII white space of the corpus contracts, as a Java regular expression class.
SPACE = r"[\x20\x09-\x0D]"


def bounded(spark: SparkSession) -> SparkSession:
    """Rows go to Python in batches of 8 MB at most, which bounds a worker's memory for texts of any length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where all is one process, as in tests, it can be unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='taxaflow-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; the JVM removes it as it exits."""
    path = f"{shared_root(spark)}/taxaflow/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


@contextmanager
def _released_shuffles(spark: SparkSession):
    """Shuffle files of the writes inside go as soon as each write has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def evaluate(df: DataFrame) -> None:
    """Run df for the errors that it raises; its rows are not kept."""
    with _released_shuffles(df.sparkSession):
        df.write.format("noop").mode("overwrite").save()


def materialise(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage, survives lost executors.

    Row groups are measured from the first row on, so that rows of any length stay near ROW_GROUP bytes together.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    with _released_shuffles(spark):
        df.write.option("parquet.block.size", ROW_GROUP).option("parquet.page.size.row.check.min", 1).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove the files of a materialised frame that nothing reads any more."""
    spark = df.sparkSession
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(parent)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def named(column: str) -> F.Column:
    """A column of any name, with dots, blanks and quotes too."""
    return F.col("`" + column.replace("`", "``") + "`")


def unused_name(df: DataFrame, name: str) -> str:
    """name, with so many underscores that no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of df; for a scan, the bytes of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def release_memory() -> None:
    """Give memory that Arrow and the C library hold without need back to the machine; a worker's next task can be far off."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries do it by themselves
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def without(df: DataFrame, lost: DataFrame, key: str, most_broadcast: int = 8 << 20) -> DataFrame:
    """Rows of df whose key is not among lost's; rows with a null key stay.

    lost is written once. It goes to all tasks if its files have most_broadcast bytes at most, so that df is not
    moved; beyond, df is joined to it by a shuffle.
    """
    keys = materialise(lost.select(key).filter(F.col(key).isNotNull()).distinct(), "lost")
    return df.join(F.broadcast(keys) if input_bytes(keys) <= most_broadcast else keys, key, "left_anti")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, copies: str, total: int, most: int = 1000) -> DataFrame:
    """rows left-joined to groups by key; copies: how many of all total rows are in a group.

    Groups of one part in `most` of all rows or more, which are `most` at most, go to all tasks. So the shuffled join
    has small groups alone, and none makes a task hot.
    """
    hot = groups.filter(F.col(copies) * most >= total)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(groups.filter(F.col(copies) * most < total), key, "left"))


def bucket_count(df: DataFrame, per_bucket_mb: float = 12.0, least: int = 4) -> int:
    """Buckets of about per_bucket_mb of input, so that a bucket's share stays level as the input grows."""
    return max(least, min(1 << 20, math.ceil(input_bytes(df) / (per_bucket_mb * 1e6))))
