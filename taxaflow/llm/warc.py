"""Content-addressed web archive: payloads once by digest, exact record headers beside them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import materialise

#: A WARC record ends with this, and its header with the same.
BREAK = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column, digest: Column) -> Column:
    name = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("none")), digest))
    parts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null; line ends in a value are percent-encoded."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_archive(pages: DataFrame, path: str, least_bytes: int = 100, date: str = "2000-01-01T00:00:00Z") -> None:
    """Archive every row of pages (page_id, url, html) under path, in the tables payloads and headers.

    payloads has each distinct payload once, under its SHA-256; payloads under one digest are compared byte by
    byte, and two that differ raise an error. headers has the exact header of each record. Of records with equal
    payloads of at least least_bytes bytes, the one with the smallest page_id is the response (rows that repeat
    this id too) and the others are revisits; shorter ones are all responses. A null html is an empty payload, a
    null url has no target line. A row with a null page_id is a revisit, or a response where no row with that
    payload has an id. An empty table gives an empty archive.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    given = given.withColumn("digest", F.sha2("payload", 256))

    stored = given.groupBy("digest").agg(F.min("payload").alias("payload"), F.max("payload").alias("last"))
    same = F.when(F.col("payload") == F.col("last"), F.col("payload")).otherwise(F.raise_error(F.lit("payloads of one digest differ")))
    stored.select("digest", same.alias("payload")).write.parquet(f"{path}/payloads")

    rows = materialise(given.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes")), "records")
    firsts = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"))
    records = rows.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, _record_id(F.col("first"), F.col("digest")))),
        _field("X-Page-Id", F.col("page_id")),
        _field("X-Refers-To-Page-Id", F.when(revisit, F.col("first"))),
        _field("X-Payload-Length", F.col("bytes")),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))),
        F.lit("\r\n"),
    )
    records.select("digest", F.encode(header, "UTF-8").alias("header")).write.parquet(f"{path}/headers")


def _header_value(name: str) -> Column:
    return F.nullif(F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r\n]*)", 1), F.lit(""))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record, rebuilt by joining headers to payloads, as its header says it is.

    (page_id, record_type, refers_to, payload_digest, header, payload): payload is the full one, of revisits
    too. A payload whose length or SHA-256 is not what the header states raises an error.
    """
    headers = spark.read.schema("digest string, header binary").parquet(f"{path}/headers")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    found = headers.join(payloads, "digest", "left").withColumns(
        {"payload_digest": F.sha2("payload", 256), "stated": _header_value("WARC-Payload-Digest")}
    )
    good = (F.concat(F.lit("sha256:"), F.col("payload_digest")) == F.col("stated")) & (
        F.octet_length("payload") == _header_value("X-Payload-Length").cast("long")
    )
    checked = F.when(good, F.col("payload_digest")).otherwise(F.raise_error(F.lit("an archived payload is damaged")))
    return found.select(
        _header_value("X-Page-Id").cast("long").alias("page_id"),
        _header_value("WARC-Type").alias("record_type"),
        _header_value("X-Refers-To-Page-Id").cast("long").alias("refers_to"),
        checked.alias("payload_digest"),
        "header",
        "payload",
    )


def export_warc(spark: SparkSession, path: str, target: str) -> None:
    """Write the archive as uncompressed WARC files under target, in parts of the size of Spark's partitions."""
    block = F.when(F.col("record_type") == "response", F.decode("payload", "UTF-8")).otherwise(F.lit(""))
    records = read_archive(spark, path).select(F.concat(F.decode("header", "UTF-8"), block).alias("value"))
    records.write.option("lineSep", BREAK).text(target)


def _records_of(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Headers and blocks of the records of a WARC file, by their Content-Length."""
    at = 0
    while at < len(content):
        stop = content.index(b"\r\n\r\n", at) + 4
        header = content[at:stop]
        length = next(int(x[15:]) for x in header.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        yield header, content[stop : stop + length]
        at = stop + length + 4


def read_warc(spark: SparkSession, target: str) -> DataFrame:
    """(header, block) of every record of the WARC files under target. A file is read by one task, whole."""

    def parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                if rows := list(_records_of(content.as_py())):
                    yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*rows, strict=True)], names=["header", "block"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(target).select("content")
    return files.mapInArrow(parsed, "header binary, block binary")
