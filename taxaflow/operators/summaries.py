"""Aggregates: modes, pivots, histograms, funnels, agreement and detection statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.operators import quantiles
from taxaflow.operators.selection import first_by


def preferred_else_most_frequent(df: DataFrame, group: str, value: str, wanted: str) -> DataFrame:
    """(group, value, n): the wanted value where the group has it, else its most frequent; ties go to the smallest."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    return first_by(counts, [group], [(F.col(value) == wanted).desc(), F.desc("n"), F.asc(value)])


def pivoted(df: DataFrame, index: str, by: str, values: Sequence[str], agg: Column, fill: float | None = None) -> DataFrame:
    """One column for each of the stated values, in their order."""
    found = df.groupBy(index).pivot(by, list(values)).agg(agg)
    return found.na.fill(fill) if fill is not None else found


def share_of_total(df: DataFrame, group: str, within: str, name: str = "share") -> DataFrame:
    """(within, group, n, share): counts and their part of the count of all of `within`."""
    counts = df.groupBy(within, group).agg(F.count("*").alias("n"))
    return counts.withColumn(name, F.col("n") / F.sum("n").over(Window.partitionBy(within)))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n): equal bins from low to high; the last is closed on the right, values outside do not count."""
    width = (high - low) / bins
    inside = df.filter((F.col(value) >= low) & (F.col(value) <= high))
    return inside.groupBy(F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """(step, stage, n, share): how many rows satisfy each step and all before it, and their share of the first."""
    so_far, counts = F.lit(True), []
    for name, condition in steps.items():
        so_far = so_far & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(so_far).alias(name))
    wide = df.agg(*counts)
    first = F.col(next(iter(steps)))
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("stage"), F.col(n).alias("n"), F.try_divide(F.col(n), first).alias("share")) for i, n in enumerate(steps)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def _pairs(truth: Column, measured: Column) -> tuple[Column, Column, Column]:
    """The truth and the measurement of usable pairs, null in others, and whether both are there."""
    both = truth.isNotNull() & measured.isNotNull()
    ok = both & (truth > 0)
    return F.when(ok, truth.cast("double")), F.when(ok, measured.cast("double")), both


def _moments(t: Column, m: Column, both: Column) -> dict[str, Column]:
    """The statistics of agreement that partial aggregates give; the median of deviations is not among them."""
    n = F.count(t)
    stats = {
        "bias": F.avg(m - t), "mae": F.avg(F.abs(m - t)), "within_10pct": F.avg((F.abs(m - t) / t <= 0.1).cast("double")),
        "pearson_r": F.corr(m, t), "slope": F.regr_slope(m, t),
    }
    return {"n": n, "n_both": F.count_if(both)} | {k: F.when(n >= 3, v) for k, v in stats.items()}


def agreement(truth: Column, measured: Column) -> dict[str, Column]:
    """Agreement of two measurements as aggregates, for groups whose values fit a task; agreement_by() has no such limit.

    Pairs need both values and a truth above zero; with fewer than 3 only n has a value. n_both counts pairs
    with any truth.
    """
    t, m, both = _pairs(truth, measured)
    median = F.when(F.count(t) >= 3, F.median(F.abs(m - t) / t) * 100)
    return _moments(t, m, both) | {"median_abs_pct": median}


def agreement_by(df: DataFrame, groups: Sequence[str], truth: Column, measured: Column) -> DataFrame:
    """(groups, the statistics of agreement()) for groups of any size: medians are exact quantiles by counted values."""
    t, m, both = _pairs(truth, measured)
    rows = df.select(*groups, t.alias("_t"), m.alias("_m"), both.alias("_both"))
    stats = rows.groupBy(*groups).agg(*[c.alias(k) for k, c in _moments(F.col("_t"), F.col("_m"), F.col("_both")).items()])
    medians = quantiles.exact_quantiles(rows, groups, F.abs(F.col("_m") - F.col("_t")) / F.col("_t"), {"median_abs_pct": 0.5})
    return quantiles.with_quantiles(stats, medians, groups).withColumn("median_abs_pct", F.when(F.col("n") >= 3, F.col("median_abs_pct") * 100))


def agreement_long(df: DataFrame, subsets: Mapping[str, Column], pairs: Mapping[str, tuple[str, str]], stats: Sequence[str] = ("bias", "mae", "median_abs_pct")) -> DataFrame:
    """(subset, pair, metric, value, n): a row goes to each subset and pair that it belongs to; n counts pairs with any truth.

    A subset without pairs has rows too, with n = 0 and null values.
    """
    parts = [(F.coalesce(condition, F.lit(False)), F.struct(F.lit(s).alias("subset"), F.lit(p).alias("pair"), F.col(t).cast("double").alias("t"), F.col(m).cast("double").alias("m"))) for s, condition in subsets.items() for p, (t, m) in pairs.items()]
    own = F.filter(F.array(*[F.when(ok & part["t"].isNotNull() & part["m"].isNotNull(), part) for ok, part in parts]), lambda x: x.isNotNull())
    found = agreement_by(df.select(F.explode(own).alias("x")).select("x.*"), ["subset", "pair"], F.col("t"), F.col("m"))
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.struct(F.lit(s).alias("subset"), F.lit(p).alias("pair")) for s in subsets for p in pairs])).alias("x")).select("x.*")
    whole = names.join(found, ["subset", "pair"], "left").withColumn("n", F.coalesce("n_both", F.lit(0).cast("long")))
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value")) for k in stats])
    return whole.select("subset", "pair", F.explode(rows).alias("r"), "n").select("subset", "pair", "r.metric", "r.value", "n")


def precision_recall(tp: Column, detected: Column, truth: Column) -> dict[str, Column]:
    """Of summed counts; zero denominators count as one."""
    return {
        "precision": F.sum(tp) / F.greatest(F.sum(detected), F.lit(1)),
        "recall": F.sum(tp) / F.greatest(F.sum(truth), F.lit(1)),
    }


def count_agreement(found: Column, expected: Column) -> dict[str, Column]:
    gap = found - expected
    share = lambda c: F.avg(c.cast("double"))
    return {"exact": share(gap == 0), "within_one": share(F.abs(gap) <= 1), "over": share(gap > 0), "under": share(gap < 0)}


def nested_accuracy(df: DataFrame, correct: Column, subsets: Mapping[str, Column]) -> DataFrame:
    """(subset, n, n_correct, accuracy) of nested or any subsets in one pass."""
    aggs = []
    for name, condition in subsets.items():
        kept = F.coalesce(condition, F.lit(False))
        hits = F.count_if(kept & F.coalesce(correct, F.lit(False)))
        aggs.append(F.struct(F.lit(name).alias("subset"), F.count_if(kept).alias("n"), hits.alias("n_correct"), F.try_divide(hits, F.count_if(kept)).alias("accuracy")))
    return df.agg(F.array(*aggs).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def joined_distinct(col: str, none: str = "none", sep: str = ", ") -> Column:
    """Sorted distinct values as one text."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set(col)), sep), F.lit("")), F.lit(none))
