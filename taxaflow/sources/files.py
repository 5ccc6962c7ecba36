"""Readers of delimited, XML and archived tables, and the table store."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; types are inferred where no schema is given."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string, and only the empty string null."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "").option("inferSchema", False).csv(path)


def read_tsv_unquoted(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated text whose quotes are plain characters, every column a string."""
    return spark.read.option("header", True).option("sep", "\t").option("quote", "").option("nullValue", "").csv(path)


def read_csvs_with_stem(spark: SparkSession, glob: str, name: str = "split") -> DataFrame:
    """All CSV files of a glob, with each row's file name without its suffix."""
    rows = read_csv_strings(spark, glob)
    return rows.withColumn(name, F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", ""))


def read_xml_boxes(spark: SparkSession, path: str) -> DataFrame:
    """(name, x1, y1, x2, y2) of the box elements of image elements."""
    box = T.ArrayType(T.StructType([T.StructField(f"_{n}", T.DoubleType()) for n in ("xtl", "ytl", "xbr", "ybr")]))
    schema = T.StructType([T.StructField("_name", T.StringType()), T.StructField("box", box)])
    rows = spark.read.format("xml").option("rowTag", "image").schema(schema).load(path)
    one = rows.select(F.col("_name").alias("name"), F.explode("box").alias("b"))
    return one.select("name", *[F.col(f"b._{a}").alias(n) for a, n in (("xtl", "x1"), ("ytl", "y1"), ("xbr", "x2"), ("ybr", "y2"))])


def _member_rows(archive: str, file: str | io.BufferedIOBase, member: str, names: Sequence[str], size: int = 10_000) -> Iterator[list[list[str | None]]]:
    """Rows of a member of a zip file as lists of strings, `size` at a time, inflated as they are read."""
    with zipfile.ZipFile(file) as z:
        if member not in z.namelist():
            return
        with z.open(member) as raw:
            held = []
            for row in csv.DictReader(io.TextIOWrapper(raw, "utf-8", newline="")):
                held.append([archive, *(row.get(c) or None for c in names)])
                if len(held) == size:
                    yield held
                    held = []
            yield held


class ArchivePart(InputPartition):
    def __init__(self, archive: str):
        super().__init__(archive)
        self.archive = archive


class ZipMembers(DataSource):
    """A CSV member of zip files on a file system that all executors mount: a partition for each archive.

    Options: archives (their URIs, one a line), member and columns (by tabs). A file's directory is read by seeks and the
    member as a stream, so an archive of any size needs the memory of some thousand rows.
    """

    @classmethod
    def name(cls) -> str:
        return "zipmembers"

    def schema(self) -> T.StructType:
        return strings(["archive", *self.options["columns"].split("\t")])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ZipReader(self.options)


class _ZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.archives = [a for a in options["archives"].split("\n") if a]
        self.member, self.names = options["member"], options["columns"].split("\t")

    def partitions(self) -> list[InputPartition]:
        return [ArchivePart(a) for a in self.archives]

    def read(self, partition: ArchivePart) -> Iterator[tuple]:
        for some in _member_rows(partition.archive, re.sub("^file:(?://)?", "", partition.archive), self.member, self.names):
            yield from map(tuple, some)


def read_zip_member(spark: SparkSession, path: str, member: str, columns: Sequence[str]) -> DataFrame:
    """(archive, columns) of a CSV member of each zip file of a path, as strings; absent members and columns are empty.

    An archive is one task's: zip files do not split. Archives of a mounted file system are read by seeks, as streams
    (see ZipMembers); those of other stores, which Python cannot seek in, come whole as one value of two gigabytes at most.
    """
    names = list(columns)
    files = spark.read.format("binaryFile").load(path)
    archives = [r.path for r in files.select("path").collect()]  # names alone; no content is read for them
    if all(a.startswith("file:") for a in archives):
        spark.dataSource.register(ZipMembers)
        reader = spark.read.format("zipmembers").option("archives", "\n".join(archives)).option("member", member)
        return reader.option("columns", "\t".join(names)).load()

    def rows(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"], strict=True):
                for some in _member_rows(archive, io.BytesIO(content), member, names):
                    yield pd.DataFrame(some, columns=["archive", *names])

    return files.select("path", "content").mapInPandas(rows, strings(["archive", *names]))


def read_images(spark: SparkSession, path: str, decode: Callable[[bytes], tuple[int, int, bytes]] | None = None) -> DataFrame:
    """(path, height, width, pixels, status) of each image of a path; RGB bytes row by row.

    decode turns a file's content into its size and pixels. Portable pixmaps are read without one; where it
    fails, the status names the error.
    """
    read = decode or read_pixmap

    def rows(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for p, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    out.append((p, *read(content), "ok"))
                except Exception as error:  # noqa: BLE001  a file's failure is its result
                    out.append((p, None, None, None, f"error:{type(error).__name__}"))
            yield pd.DataFrame(out, columns=["path", "height", "width", "pixels", "status"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(rows, "path string, height int, width int, pixels binary, status string")


def read_pixmap(content: bytes) -> tuple[int, int, bytes]:
    """Height, width and RGB bytes of a binary portable pixmap or greymap of 8 bits."""
    kind, width, height, most = content.split(maxsplit=4)[:4]
    if kind not in (b"P5", b"P6") or int(most) != 255:
        raise ValueError("not a binary pixmap of 8 bits")
    n = int(width) * int(height) * (3 if kind == b"P6" else 1)
    pixels = content[-n:]
    return int(height), int(width), pixels if kind == b"P6" else np.repeat(np.frombuffer(pixels, np.uint8), 3).tobytes()


class TableStore:
    """Named Parquet tables in a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.select(*columns) if columns else df

    def read_optional(self, name: str, schema: T.StructType | None = None) -> DataFrame | None:
        """The table, or if it is absent an empty one of the schema, or None."""
        if _exists(self.spark, self.path(name)):
            return self.read(name)
        return self.spark.createDataFrame([], schema) if schema else None

    def write(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path(name))

    def read_shards(self, kind: str) -> DataFrame:
        """All appended shards of a kind, columns matched by name."""
        return self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/shards/{kind}")

    def append_shard(self, kind: str, df: DataFrame, by: str = "source") -> None:
        df.write.mode("append").partitionBy(by).parquet(f"{self.root}/shards/{kind}")

    def replace_pools(self, kind: str, df: DataFrame, by: str = "source") -> None:
        """Replace the partitions that df has rows of; others stay."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(f"{self.root}/shards/{kind}")

    def drop_from_shards(self, kind: str, ids: DataFrame, key: str, by: str = "source") -> None:
        """Rewrite the partitions that hold rows with these ids without them; a partition left empty goes.

        Partitions are known by their folders, so null and special values are as good as others. The new files replace a
        partition's old ones as the write is committed; a run that failed is just run again, as dropping twice is no more.
        """
        path = f"{self.root}/shards/{kind}"
        old = self.read_shards(kind).withColumn("_folder", F.regexp_replace("_metadata.file_path", "/[^/]*$", ""))
        gone = ids.select(key).distinct()
        hit = old.join(gone, key, "left_semi").select("_folder").distinct()
        left = old.join(F.broadcast(hit), "_folder", "left_semi").join(gone, key, "left_anti")  # a row for each partition
        emptied = [r[0] for r in hit.join(left.select("_folder").distinct(), "_folder", "left_anti").collect()]
        left.drop("_folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
        for folder in emptied:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(folder))
            place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        self.spark.catalog.refreshByPath(path)


def read_settings(text: str, environment: dict[str, str]) -> dict[str, str]:
    """KEY=VALUE lines, with "export " and quotes taken off; "..." is unset, and the environment wins."""
    found: dict[str, str] = {}
    for line in text.splitlines():
        name, sep, value = line.strip().removeprefix("export ").partition("=")
        value = value.strip().strip("\"'")
        if sep and not name.startswith("#") and value and value != "...":
            found[name.strip()] = value
    return found | {k: environment[k] for k in found if environment.get(k)}
