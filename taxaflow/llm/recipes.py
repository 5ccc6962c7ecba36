"""Exact deduplication by content-defined chunk recipes; DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import SPACE, evaluate, join_groups, materialise

#: A chunk has LEAST characters or more, and MOST at most.
LEAST, MOST = 64, 4096
#: Two halves of the characters; the seven before a space must fall into these for a chunk to end there, which one
#: space in 128 does. So ends follow from content alone, and texts that share a part share its chunks.
LOW, HIGH = "[a-mA-M0-4., ]", "[^a-mA-M0-4., ]"
END = f" (?<={LOW}{HIGH}{HIGH}{LOW}{HIGH}{LOW}{LOW} )"
CHUNK = rf"(?s).{{{LEAST - 1},{MOST - 1}}}?{END}|.{{1,{MOST}}}"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"{SPACE}+", " ")


def chunk_id(chunk: Column) -> Column:
    """Identifier of a chunk: SHA-256, verified by an independent 64-bit hash and the length in bytes.

    Chunks whose SHA-256 agree but whose other two do not get different identifiers.
    """
    return F.concat(
        F.unhex(F.sha2(chunk, 256)),
        F.unhex(F.lpad(F.hex(F.xxhash64(chunk)), 16, "0")),
        F.unhex(F.lpad(F.hex(F.octet_length(chunk).cast("long")), 8, "0")),
    )


def with_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, chunks): the normalised text and its content-defined chunks, which concatenate to it."""
    given = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    return given.withColumn("chunks", F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0)))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, chunks, recipe array<binary>, text_sha256) of every row; the empty text has the empty recipe."""
    return with_chunks(docs, id_col, text_col).select("id", "chunks", F.transform("chunks", chunk_id).alias("recipe"), F.sha2("text", 256).alias("text_sha256"))


def distinct_chunks(rows: DataFrame) -> DataFrame:
    """(chunk_id, chunk, uses) of the rows of recipes(): each distinct chunk once. Raises if one identifier has two contents."""
    each = rows.select(F.explode(F.arrays_zip("recipe", "chunks")).alias("c")).select(F.col("c.recipe").alias("chunk_id"), F.col("c.chunks").alias("chunk"))
    kept = each.groupBy("chunk_id").agg(F.min("chunk").alias("chunk"), F.max("chunk").alias("last"), F.count("*").alias("uses"))
    checked = F.when(F.col("chunk") == F.col("last"), F.col("chunk")).otherwise(F.raise_error(F.lit("chunk identifiers collide")))
    return kept.select("chunk_id", checked.alias("chunk"), "uses")


def chunk_store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(chunk_id, chunk, uses) of all texts: what recipes are made of, once."""
    return distinct_chunks(recipes(docs, id_col, text_col))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row of docs.

    Chunks are deduplicated first, into a table in which each identifier has one content, compared by its bytes. Then
    texts are equal if their recipes, the ordered lists of their chunks' identifiers, are: a long document moves as a
    few hundred bytes. The row with the smallest id of a group stays; of rows that repeat this id all do. Rows with a
    null id belong to their text's group and do not stay, unless no row of the group has an id: then keep_id is null
    and all stay. Null texts are empty ones. Other columns are not read; an empty table gives no rows.
    """
    cut = materialise(recipes(docs, id_col, text_col), "recipes", "zstd")
    evaluate(distinct_chunks(cut))  # raises before any comparison
    rows = cut.drop("chunks")
    groups = rows.groupBy("recipe").agg(F.min("id").alias("least"), F.count("*").alias("copies")).filter("copies > 1")
    found = join_groups(rows, materialise(groups, "groups"), "recipe", "copies", rows.count())
    keep = F.coalesce("least", "id")
    kept = F.coalesce(F.col("id") == keep, keep.isNull())
    return found.select("id", keep.alias("keep_id"), F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"), "text_sha256")
