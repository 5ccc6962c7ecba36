"""Joins that link records: unique lookups, prioritised fallbacks, best candidates, resumption."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.operators.selection import first_by


def lookup(df: DataFrame, right: DataFrame, on: str, key: str, values: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Left lookup in a right side made unique by key, so that the row count stays. Null keys do not match."""
    unique = first_by(right.filter(F.col(key).isNotNull()), [key], order).select(F.col(key).alias("_key"), *values)
    return df.join(unique, F.col(on) == F.col("_key"), "left").drop("_key")


def fallback_link(df: DataFrame, right: DataFrame, tries: Sequence[tuple[str, str, str]], value: str, order: Sequence[Column], id_col: str) -> DataFrame:
    """link and link_kind: the value found by the first of tries (left column, right column, label) that hits.

    The tries' lookups are one table of (label, key, value) with one join: each left row asks with all its keys,
    and the answer of the first try wins. id_col must be unique in df; rows without any hit keep nulls.
    """
    known = right.filter(F.col(value).isNotNull())
    tables = []
    for rank, (_, key, _) in enumerate(tries):
        unique = first_by(known.filter(F.col(key).isNotNull()), [key], order)
        tables.append(unique.select(F.lit(rank).alias("_rank"), F.col(key).cast("string").alias("_key"), F.col(value).alias("_value")))
    answers = tables[0]
    for t in tables[1:]:
        answers = answers.unionByName(t)
    asks = F.array(*[F.struct(F.lit(r).alias("_rank"), F.col(left).cast("string").alias("_key")) for r, (left, _, _) in enumerate(tries)])
    asked = df.select(id_col, F.explode(asks).alias("_ask")).select(id_col, "_ask._rank", "_ask._key").filter("_key IS NOT NULL")
    best = asked.join(answers, ["_rank", "_key"]).groupBy(id_col).agg(F.min(F.struct("_rank", "_value")).alias("_best"))
    label = F.element_at(F.array(*[F.lit(t[2]) for t in tries]), F.col("_best._rank") + 1)
    return df.join(best, id_col, "left").withColumns({"link": F.col("_best._value"), "link_kind": F.when(F.col("_best").isNotNull(), label)}).drop("_best")


def best_candidate(df: DataFrame, candidates: DataFrame, key: str, order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """Left join to each key's first candidate; candidates without a key do not count."""
    best = first_by(candidates.filter(F.col(key).isNotNull()), [key], order).select(key, *values)
    return df.join(best, key, "left")


def with_means(df: DataFrame, rows: DataFrame, key: str, means: Mapping[str, str]) -> DataFrame:
    """df joined to the mean of each of rows' columns by key; means maps a new name to a column.

    Means are taken before the join. Rows of df whose key is null, is not in rows, or lacks one of the means, go.
    """
    found = rows.groupBy(key).agg(*[F.avg(c).alias(name) for name, c in means.items()]).na.drop()
    return df.join(found, key)


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def members(df: DataFrame, other: DataFrame, on: str, key: str) -> DataFrame:
    return df.join(other.select(F.col(key).alias("_key")), F.col(on) == F.col("_key"), "left_semi")


def collected_candidates(df: DataFrame, keys: Sequence[str], candidate: str) -> DataFrame:
    """The sorted distinct candidates of each key as a list; meant for keys whose candidates are few."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(candidate)).alias("candidates"))


def asof(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, value: str) -> DataFrame:
    """Extension: the right value last known at each left time, by one sorted pass over both sides."""
    from pyspark.sql import Window

    cols = [c for c in left.columns if c != key]
    a = left.select(key, F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), F.struct(*cols).alias("_left"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    b = right.select(key, F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), F.col(value).alias("_v"))
    seen = Window.partitionBy(key).orderBy("_t", "_side", F.col("_v").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    filled = a.unionByName(b).withColumn(value, F.last("_v", ignorenulls=True).over(seen))
    return filled.filter("_side = 1").select(key, "_left.*", value)
