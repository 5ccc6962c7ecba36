"""Contiguous shards of nearly equal bytes from global prefix sums; DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.llm.common import bucket_count, join_groups, materialise

#: A group of equal texts stays in one shard if it has at most one of so many parts of a shard's target.
TOGETHER = 64


def byte_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row of docs, in contiguous shards of nearly equal bytes.

    Rows stand in the order of their text's SHA-256 and id, which is as good as shuffled and keeps equal texts
    together. Range partitions sum their sizes, prefix sums of these totals place each partition, and a row's
    shard is where its prefix falls among equal targets. A small group of equal texts goes where its first row
    falls; a group over one TOGETHERth of a target is cut like other rows, whatever its size. The slot is the row's
    place in its shard, without gaps. A row's size is its text's UTF-8 bytes plus 1; a null text counts as an
    empty one, rows with a null id and repeated rows count like others, and an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    parts = bucket_count(docs, 64)
    ordered = given.repartitionByRange(parts, "digest", "id").withColumn("part", F.spark_partition_id())
    rows = materialise(ordered, "sized")

    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    within = Window.partitionBy("part").orderBy("digest", "id", "size")
    upto = within.rowsBetween(Window.unboundedPreceding, -1)
    # starts has a row for each of the parts, whose number bucket_count bounds
    placed = rows.withColumns(
        {"prefix": F.coalesce(F.sum("size").over(upto), F.lit(0)), "nth": F.row_number().over(within).cast("long") - 1}
    ).join(F.broadcast(starts), "part")
    placed = materialise(
        placed.select(
            "id", "size", "text_crc32", "digest", "total",
            (F.col("prefix") + F.col("bytes_before")).alias("prefix"), (F.col("nth") + F.col("rows_before")).alias("nth"),
        ),
        "prefixes",
    )

    groups = placed.groupBy("digest").agg(F.min("prefix").alias("first"), F.sum("size").alias("bytes"), F.count("*").alias("n"))
    groups = materialise(groups.filter("n > 1"), "groups")
    small = F.col("bytes") * (shards * TOGETHER) <= F.col("total")
    at = F.when(F.coalesce(small, F.lit(False)), F.col("first")).otherwise(F.col("prefix"))
    shard = F.least(F.lit(shards - 1), F.floor(at * shards / F.col("total")).cast("int"))
    cut = join_groups(placed, groups, "digest", "n", placed.count()).select("id", "size", "text_crc32", "nth", shard.alias("shard"))
    cut = materialise(cut, "cut")
    # at most one row for each shard
    firsts = cut.groupBy("shard").agg(F.min("nth").alias("start"))
    slot = F.col("nth") - F.col("start")
    return cut.join(F.broadcast(firsts), "shard").select("id", "size", "text_crc32", "shard", slot.alias("slot"))
