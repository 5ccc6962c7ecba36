"""Keep a catalogue of collections' web pages as plain text: each run takes the page files that came since the last.

    python -m jobs.collection_pages --pages PATH --out PATH --checkpoint PATH [--config FILE]

pages is a folder of Parquet files (page_id, url, html) that fetches add to, or a pattern that names files or folders.
The stream's checkpoint says which files are done; a file is taken once, and rows that were delivered before, in
whatever file, are not new.

out/catalogue, partitioned by batch and bucket: a row for each page and content that was seen, with its text, host, file
stem, words, and the first page that had the same text. out/hosts: counts of each host over the whole catalogue.

Reruns: a batch replaces its own partitions of the catalogue, and looks at earlier batches alone, so one that is run
again after a failure gives the same rows. hosts is made from the catalogue each time.

Settings: buckets (parts of a batch by content), files_per_batch (null: all files that are there are one batch).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import command_line, log, read_config
from taxaflow.functions import text
from taxaflow.operators import selection

PAGE = "page_id long, url string, html string"
ROW = "page_id long, url string, host string, stem string, text string, n_words int, digest string, duplicate_of long, previous_batch long"


def page_rows(pages: DataFrame) -> DataFrame:
    """Text and address of each page. A page without text has no digest; a null page_id is no page."""
    host = text.extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://([^/?#]+)")
    stem = text.or_null(text.without_size(text.stem(text.url_file(F.col("url")))))
    rows = pages.filter("page_id IS NOT NULL").select("page_id", "url", host.alias("host"), stem.alias("stem"), text.plain_text(F.col("html")).alias("text"))
    words = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", " ")))
    return rows.withColumns({"n_words": words, "digest": F.sha2("text", 256)})


def new_rows(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose page and content known lacks, once each, with duplicate_of and the last batch that had the page.

    A text's original is its first page: of an earlier batch before this one, then the smallest page_id.
    """
    fresh = selection.first_by(rows, ["page_id", "digest"], [F.col("url").asc_nulls_last()])
    seen = known.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"))
    fresh = fresh.join(seen, (F.col("page_id") == F.col("_page")) & F.col("digest").eqNullSafe(F.col("_digest")), "left_anti")
    originals = known.filter("digest IS NOT NULL AND duplicate_of IS NULL").groupBy("digest").agg(F.min(F.struct("batch", "page_id")).getField("page_id").alias("_original"))
    marked = selection.content_duplicates(fresh.join(originals, "digest", "left"), "page_id", "digest", known="_original")
    # the original page itself can come again with its first text beside another one: it is no copy of itself
    marked = marked.withColumn("duplicate_of", F.when(F.col("duplicate_of") != F.col("page_id"), F.col("duplicate_of"))).drop("_original")
    earlier = known.groupBy("page_id").agg(F.max("batch").alias("previous_batch"))
    return marked.join(earlier, "page_id", "left")


def host_counts(catalogue: DataFrame) -> DataFrame:
    return catalogue.groupBy("host").agg(
        F.count_distinct("page_id").alias("pages"), F.count("*").alias("contents"), F.count("duplicate_of").alias("duplicates"),
        F.sum("n_words").alias("words"), F.max("batch").alias("last_batch"),
    )


def run(spark: SparkSession, pages: str, out: str, checkpoint: str, config: str | None = None) -> DataFrame:
    """Take the files of pages that the checkpoint does not know, and return the whole catalogue."""
    settings = read_config(spark, config, "collection_pages.json")
    path = f"{out}/catalogue"
    layout = spark.createDataFrame([], f"{ROW}, batch long, bucket int").schema
    # a table of no rows makes the path readable before the first batch, and adds nothing to one that is there
    spark.createDataFrame([], layout).write.mode("append").partitionBy("batch", "bucket").parquet(path)

    def catalogue() -> DataFrame:
        return spark.read.schema(layout).parquet(path)

    def take(batch: DataFrame, number: int) -> None:
        known = catalogue().filter(F.col("batch") < number).select("page_id", "digest", "duplicate_of", "batch")
        bucket = F.coalesce(F.conv(F.left("digest", F.lit(7)), 16, 10).cast("long") % settings["buckets"], F.lit(0)).cast("int")
        given = page_rows(batch).persist()
        rows = new_rows(given, known).withColumns({"batch": F.lit(number).cast("long"), "bucket": bucket})
        dealt = rows.select(*layout.names).hint("rebalance", F.col("bucket"))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket").parquet(path)
        log.info("batch %d: read %d pages of %s, wrote %d new rows", number, given.count(), pages, catalogue().filter(F.col("batch") == number).count())
        given.unpersist()

    reader = spark.readStream.schema(PAGE)
    if settings["files_per_batch"]:
        reader = reader.option("maxFilesPerTrigger", settings["files_per_batch"])
    query = reader.parquet(pages).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    whole = catalogue()
    host_counts(whole).write.mode("overwrite").parquet(f"{out}/hosts")
    log.info("wrote %s: %d rows in %d batches; %s: %d hosts", path, whole.count(), whole.select("batch").distinct().count(), f"{out}/hosts", spark.read.parquet(f"{out}/hosts").count())
    return whole


def main(argv: Sequence[str] | None = None) -> None:
    command_line("collection pages", ("pages", "out", "checkpoint"), lambda spark, a: run(spark, a.pages, a.out, a.checkpoint, a.config), argv)


if __name__ == "__main__":
    main()
