"""Ordered selection: one row per key, duplicates, ordinals, runs, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order that the caller states; null keys are one key."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def latest(df: DataFrame, keys: Sequence[str], date: str, ties: Sequence[Column]) -> DataFrame:
    """The latest row of each key. A row without a date counts as the latest, as sorting nulls last and keeping the last does."""
    return first_by(df, keys, [F.col(date).desc_nulls_first(), *ties])


def latest_wide(df: DataFrame, keys: Sequence[str], date: str, tie: str) -> DataFrame:
    """As latest(), by max_by: partial aggregation before the shuffle, for keys that may be hot. Null keys are one key."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(F.col(date).isNull().alias("none"), F.col(date).alias("date"), F.col(tie).alias("tie"))
    found = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return found.select(*keys, "_row.*")


def priority_order(col: str, ranked: Sequence[str]) -> Column:
    """0 for the first named value, 1 for the next, and so on; others and null come last."""
    expr = F.lit(len(ranked))
    for i, value in reversed(list(enumerate(ranked))):
        expr = F.when(F.col(col) == value, i).otherwise(expr)
    return expr


def content_duplicates(df: DataFrame, key: str, digest: str, known: str | None = None) -> DataFrame:
    """duplicate_of: the smallest key among rows with the same digest, null for that row itself.

    An earlier mark in the column `known` stays, and marked rows are not candidates. Rows without a digest have
    no duplicates. The smallest key is aggregated before it is joined, so a hot digest is not one window.
    """
    free = df.filter(F.col(digest).isNotNull() & (F.col(known).isNull() if known else F.lit(True)))
    least = free.groupBy(digest).agg(F.min(key).alias("_least"))
    mark = F.when(F.col(key) != F.col("_least"), F.col("_least"))
    if known:
        mark = F.when(F.col(known).isNotNull(), F.col(known)).otherwise(mark)
    return df.join(least, digest, "left").withColumn("duplicate_of", mark).drop("_least")


def known_copies(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """is_copy: whether the row's key occurs in other. Null keys do not match."""
    there = other.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_there", F.lit(True))
    return df.join(there, key, "left").withColumn("is_copy", F.coalesce("_there", F.lit(False))).drop("_there")


def two_stage_distinct(df: DataFrame, first: Sequence[str], then: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row by one key, and of these the first by another."""
    return first_by(first_by(df, first, order), then, order)


def ordinal_ids(df: DataFrame, group: str, order: Sequence[Column], width: int = 3, name: str = "instance_id") -> DataFrame:
    """<group>#001, #002 ... within each group; longer numbers are not cut."""
    nth = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    text = F.col("_nth").cast("string")
    padded = F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))
    return df.withColumn("_nth", nth).withColumn(name, F.concat(F.col(group).cast("string"), F.lit("#"), padded)).drop("_nth")


def longest_run(df: DataFrame, group: str, order: Sequence[Column], flag: Column) -> DataFrame:
    """(group, longest_run): most rows in a row for which flag holds; null is false."""
    per = Window.partitionBy(group).orderBy(*order)
    marked = df.withColumns({"_ok": F.coalesce(flag, F.lit(False)), "_nth": F.row_number().over(per)})
    island = F.col("_nth") - F.sum(F.col("_ok").cast("int")).over(per)
    lengths = marked.withColumn("_island", island).groupBy(group, "_island").agg(F.count_if("_ok").alias("_n"))
    return lengths.groupBy(group).agg(F.max("_n").alias("longest_run"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in the order of the MD5 of their key and the seed: the same rows at every run and partitioning, and in any engine."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary")), key).limit(n)
