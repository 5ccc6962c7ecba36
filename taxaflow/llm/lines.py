"""Dropping lines that many documents share; DataFrame expressions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import join_groups, materialise, named

#: ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased; other letters stay as they are."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def line_hash(key: Column) -> Column:
    """The first 16 bytes of the key's SHA-256."""
    return F.unhex(F.substring(F.sha2(key, 256), 1, 32))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, version): repeated ids with different texts differ in the version, so positions mean one text's lines."""
    given = docs.select(named(id_col).alias("id"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))
    return given.withColumn("version", F.xxhash64("text"))


def shared_lines(held: DataFrame, least_docs: int) -> DataFrame:
    """(hash, first, copies) of the hashes of held (id, hash) that at least least_docs documents hold.

    All rows of an id are one document, and so are all rows without one; first is the smallest id.
    """
    found = held.groupBy("hash").agg(F.count_distinct("id").alias("ids"), F.max(F.col("id").isNull().cast("int")).alias("others"), F.min("id").alias("first"), F.count("*").alias("copies"))
    return found.filter(F.col("ids") + F.col("others") >= least_docs).select("hash", "first", "copies")


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 10, least_docs: int = 2) -> DataFrame:
    """(id, text, n_lines, n_dropped) of every row of docs: text without the lines that other documents hold first.

    Lines are exploded, and their keys (see line_key) of at least least_chars code points hashed. Hashes that at least
    least_docs documents hold lose all their lines, except in the document with the smallest id. What moves is a hash, an
    id and a position for each line; then each text takes the positions that it loses, once, and the lines that stay are
    put together by position. Hashes of one line in a thousand or more go to all tasks, so that no task is hot.

    A null or empty text is one empty line, which is too short to be dropped while least_chars is 1 or more. A text all
    of whose lines go is empty. Rows that repeat an id are one document: a line held by it alone stays in all of them.
    Rows without an id are together one document, after all that have one. Texts of any length are read whole, in
    memory for one text. Other columns are not read, and columns of any name can be the two; an empty table gives no rows.
    """
    texts = _texts(docs, id_col, text_col)
    each = texts.select("id", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("key", line_key(F.col("line")))
    held = materialise(each.filter(F.char_length("key") >= least_chars).select("id", "version", "pos", line_hash(F.col("key")).alias("hash")), "lines")
    shared = materialise(shared_lines(held, least_docs), "shared-lines")
    hits = join_groups(held, shared, "hash", "copies", held.count()).filter(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))
    lost = materialise(hits.groupBy("id", "version").agg(F.collect_set("pos").alias("gone")), "lost-lines").withColumnsRenamed({"id": "of", "version": "of_version"})
    joined = texts.join(lost, F.col("id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version")), "left")
    cut = joined.select("id", "text", "gone", F.split("text", "\n").alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n"))
    return cut.select("id", text.alias("text"), F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
