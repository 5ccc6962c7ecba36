"""Columns: alignment, recoding, choice between sources, units, gates, flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.operators import quantiles


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the columns that exist, in the order asked for."""
    return df.select(*[c for c in columns if c in df.columns])


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order: missing ones as typed nulls, others dropped."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def union_aligned(*frames: DataFrame) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(*columns: tuple[DataFrame, str], name: str = "value") -> DataFrame:
    """Distinct non-null values of several columns."""
    parts = [df.select(F.col(c).cast("string").alias(name)) for df, c in columns]
    return reduce(DataFrame.unionByName, parts).filter(F.col(name).isNotNull()).distinct()


def recode(col: Column, mapping: Mapping[str, str]) -> Column:
    """Mapped value, or the value itself where the mapping has none."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col) if pairs else col


def preferred(has: Column, first: Column, second: Column) -> Column:
    """first where the preferred source exists, even if first is null; else second. Not a coalesce."""
    return F.when(has, first).otherwise(second)


def gated(ok: Column, **columns: Column) -> dict[str, Column]:
    """Columns that are null together unless ok holds; a null ok does not hold."""
    return {name: F.when(F.coalesce(ok, F.lit(False)), col) for name, col in columns.items()}


def flag(col: Column, missing: bool = False) -> Column:
    """A three-valued flag as a two-valued one."""
    return F.coalesce(col.cast("boolean"), F.lit(missing))


def to_units(df: DataFrame, lengths: Mapping[str, str], areas: Mapping[str, str], per_unit: str) -> DataFrame:
    """New columns: lengths divided by the scale, areas by its square; null where the scale is null or zero."""
    k = F.col(per_unit)
    new = {to: F.try_divide(F.col(c), k) for c, to in lengths.items()}
    new |= {to: F.try_divide(F.col(c), k * k) for c, to in areas.items()}
    return df.withColumns(new)


def year_of(col: Column) -> Column:
    """The year of a date, timestamp or text; null where it is none."""
    return F.year(F.try_to_timestamp(col.cast("string")))


def zipped(**lists: Column) -> Column:
    """Records of parallel lists, as long as the shortest; null where one of the lists is null."""
    shortest = [F.size(c) for c in lists.values()]
    records = F.arrays_zip(*[c.alias(n) for n, c in lists.items()])
    return F.slice(records, 1, F.least(*shortest) if len(shortest) > 1 else shortest[0])


def intersects(col: Column, values: Sequence[str]) -> Column:
    """Whether a list has one of the values; a null list has none."""
    return F.coalesce(F.arrays_overlap(F.filter(col, lambda x: x.isNotNull()), F.array(*[F.lit(v) for v in values])), F.lit(False))


def number(col: Column) -> Column:
    return col.try_cast("double")


def fixed_annotation_frame(df: DataFrame, groups: Sequence[str], measured: str, annotated: str, coords: Sequence[str], tolerance: float = 0.08) -> DataFrame:
    """frame_factor, frame_ok and coordinates in the measured frame.

    The factor is the group's median of measured / annotated scale where that is off by more than the tolerance,
    and 1 otherwise; coordinates are multiplied by it. Groups that are off, or without a median, are not ok.
    """
    medians = quantiles.exact_quantiles(df, groups, F.try_divide(F.col(measured), F.col(annotated)), {"_median": 0.5})
    joined = df.join(medians, list(groups), "left")
    off = F.coalesce(F.abs(F.col("_median") - 1) > tolerance, F.lit(False))
    factor = F.when(off, F.col("_median")).otherwise(F.lit(1.0))
    moved = {c: F.col(c) * factor for c in coords}
    return joined.withColumns(moved | {"frame_factor": factor, "frame_ok": F.col("_median").isNotNull() & ~off}).drop("_median")
