"""Exact quantiles of groups of any size: no task holds a group's values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Groups of more distinct values are cut into ranges: SIDE * SIDE of them.
WHOLE, SIDE = 20_000, 16


def _cuts(counts: DataFrame) -> DataFrame:
    """(_of, _fine, _coarse) of large groups: about even cuts of their distinct values, and every SIDE-th of these.

    Groups are sized first, so that small ones are not summarised. There are at most a row for each WHOLE distinct values.
    """
    n = SIDE * SIDE
    sizes = counts.groupBy("_of").agg(F.count("*").alias("_values"), F.sum("_n").alias("_rows"))
    # the second test says no more than the first, but reads _n: so this branch has the shuffle of counts that others have
    large = sizes.filter((F.col("_values") > WHOLE) & (F.col("_rows") > WHOLE)).select("_of")
    number = F.when(~F.isnan("_v") & (F.col("_n") > 0), F.col("_v"))
    cuts = counts.join(F.broadcast(large), "_of", "left_semi").groupBy("_of").agg(F.percentile_approx(number, [i / n for i in range(1, n)]).alias("_fine"))
    coarse = F.transform(F.sequence(F.lit(SIDE), F.lit(n - SIDE), F.lit(SIDE)), lambda i: F.element_at("_fine", i))
    return cuts.select("_of", "_fine", coarse.alias("_coarse"))


def _range(value: Column) -> Column:
    """The range of a value: how many cuts are below it, found among the coarse ones and then among SIDE fine ones."""
    below = lambda cuts: F.size(F.filter(cuts, lambda c: c < value))
    coarse = below(F.col("_coarse"))
    fine = below(F.slice("_fine", coarse * SIDE + 1, F.lit(SIDE)))
    return F.when(F.col("_coarse").isNull(), 0).otherwise(coarse * SIDE + fine)


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str | Column, wanted: Mapping[str, float]) -> DataFrame:
    """(groups, the wanted names): linearly interpolated quantiles of each group's values, as doubles.

    Rows are counted by value first, with partial counts before the shuffle. Large groups' distinct values are dealt to
    ranges between approximate cuts, which decide about balance alone. The counts of ranges say in which range each of
    the two ranks of a quantile lies, and only in those ranges are the values sorted.

    Null values do not count, and a group without others is absent. Not-a-number is above all numbers. Null keys are a
    key. wanted maps a name to a part of one, 0 to 1.
    """
    of = F.struct(*[F.col(g).alias(g) for g in groups]) if groups else F.struct(F.lit(0).alias("_all"))
    number = (F.col(value) if isinstance(value, str) else value).cast("double")
    counts = df.select(of.alias("_of"), number.alias("_v")).filter("_v IS NOT NULL").groupBy("_of", "_v").agg(F.count("*").alias("_n"))
    # a join by group would bring all values of a group to one task, and so would what follows
    placed = counts.join(F.broadcast(_cuts(counts)), "_of", "left").select("_of", "_v", "_n", _range(F.col("_v")).alias("_range"))
    per = Window.partitionBy("_of")
    sizes = placed.groupBy("_of", "_range").agg(F.sum("_n").alias("_size"))
    upto = F.sum("_size").over(per.orderBy("_range"))
    sizes = sizes.select("_of", "_range", (upto - F.col("_size")).alias("_before"), upto.alias("_upto"), F.sum("_size").over(per).alias("_total"))
    at = {name: (F.col("_total") - 1) * F.lit(float(q)) for name, q in wanted.items()}
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), rank(position).cast("long").alias("rank")) for i, position in enumerate(at.values()) for k, rank in enumerate((F.floor, F.ceil))])
    asked = sizes.withColumn("_asked", F.filter(ranks, lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_upto")))).filter(F.size("_asked") > 0)
    near = placed.join(asked.select("_of", "_range", "_before", "_total", "_asked"), ["_of", "_range"])
    last = F.col("_before") + F.sum("_n").over(Window.partitionBy("_of", "_range").orderBy("_v"))
    hit = near.withColumn("_last", last).withColumn("_hit", F.explode(F.filter("_asked", lambda r: (r["rank"] < F.col("_last")) & (r["rank"] >= F.col("_last") - F.col("_n")))))
    ends = [F.max(F.when((F.col("_hit.i") == i) & (F.col("_hit.k") == k), F.col("_v"))).alias(f"_{i}_{k}") for i in range(len(wanted)) for k in range(2)]
    found = hit.groupBy("_of").agg(F.max("_total").alias("_total"), *ends)

    def between(i: int, position: Column) -> Column:
        low, high, part = F.col(f"_{i}_0"), F.col(f"_{i}_1"), position - F.floor(position)
        return F.when(part == 0, low).otherwise(low * (1 - part) + high * part)

    return found.select(*[F.col("_of").getField(g).alias(g) for g in groups], *[between(i, p).alias(name) for i, (name, p) in enumerate(at.items())])


def with_quantiles(aggregated: DataFrame, quantiles: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row of each group with its quantiles; null keys match. Groups without values keep nulls."""
    keyed = quantiles.withColumnsRenamed({g: f"_of_{g}" for g in groups})
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return aggregated.join(keyed, same, "left").drop(*[f"_of_{g}" for g in groups])
