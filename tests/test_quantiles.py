"""Exact quantiles against sorted lists: ties, nulls, null keys, large groups cut into ranges, values that are no numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaflow.operators import quantiles, summaries

WANTED = {"low": 0.0, "p10": 0.1, "med": 0.5, "p995": 0.995, "high": 1.0}


def plain(rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    return {g: [float(np.quantile(v, q)) for q in WANTED.values()] for g, v in groups.items()}


def found(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    return {r.g: [r[name] for name in WANTED] for r in quantiles.exact_quantiles(df, ["g"], "v", WANTED).collect()}


def close(a, b):
    return a.keys() == b.keys() and all(a[g] == pytest.approx(b[g], rel=1e-12) for g in a)


@pytest.mark.parametrize("whole, side", [(20_000, 16), (30, 3), (0, 2)])
def test_quantiles_of_groups(spark, monkeypatch, whole, side):
    monkeypatch.setattr(quantiles, "WHOLE", whole)
    monkeypatch.setattr(quantiles, "SIDE", side)
    rng = random.Random(whole)
    rows = [("hot", rng.gauss(0, 1000)) for _ in range(3000)] + [("ties", float(rng.randrange(5))) for _ in range(1000)] + [("skew", math.exp(rng.random() * 40)) for _ in range(999)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("null", None), (None, 4.0), (None, 8.0), ("same", 7.0), ("same", 7.0), ("zeros", 0.0), ("zeros", -0.0)]
    rows += [(f"g{i}", rng.random()) for i in range(200) for _ in range(i % 7)]
    assert close(found(spark, rows), plain(rows))


def test_large_group_is_cut(spark):
    rows = spark.range(300_000).select(F.lit("a").alias("g"), (F.col("id") * 7919 % 300_000).cast("double").alias("v"))
    got = quantiles.exact_quantiles(rows, ["g"], F.col("v") * 2, {"med": 0.5, "p": 0.123456}).first()
    assert got.med == 299_999.0 and got.p == pytest.approx(0.123456 * 299_999 * 2)


def test_no_numbers_are_above_all_others(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", float("nan"))], "g string, v double")
    row = quantiles.exact_quantiles(df, ["g"], "v", {"med": 0.5, "high": 1.0}).first()
    assert row.med == 2.0 and math.isnan(row.high)


def test_no_groups_many_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 7), (2, "x", 9)], "a int, b string, v int")
    assert quantiles.exact_quantiles(df, [], "v", {"med": 0.5}).first().med == 7.0
    assert {(r.a, r.b): r.med for r in quantiles.exact_quantiles(df, ["a", "b"], "v", {"med": 0.5}).collect()} == {(1, None): 6.0, (2, "x"): 9.0}
    counts = df.groupBy("a", "b").count()
    joined = quantiles.with_quantiles(counts, quantiles.exact_quantiles(df.filter("a = 1"), ["a", "b"], "v", {"med": 0.5}), ["a", "b"])
    assert {(r.a, r.b, r["count"]): r.med for r in joined.collect()} == {(1, None, 2): 6.0, (2, "x", 1): None}
    assert quantiles.exact_quantiles(df.filter("a > 5"), ["a"], "v", {"med": 0.5}).count() == 0


def test_agreement_of_large_groups_is_that_of_aggregates(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 0.0, -1.0, rng.random() * 10]), rng.choice([None, rng.random() * 10])) for _ in range(600)] + [("few", 1.0, 1.0), ("few", 2.0, 3.0), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, t double, m double")
    one = {r.g: r.asDict() for r in df.groupBy("g").agg(*[c.alias(k) for k, c in summaries.agreement(F.col("t"), F.col("m")).items()]).collect()}
    two = {r.g: r.asDict() for r in summaries.agreement_by(df, ["g"], F.col("t"), F.col("m")).collect()}
    assert one.keys() == two.keys()
    for g in one:
        for k, v in one[g].items():
            assert two[g][k] == (pytest.approx(v, rel=1e-9) if isinstance(v, float) else v), (g, k)


def test_no_join_brings_a_groups_values_to_one_task(spark):
    rows = spark.range(50_000).select(F.lit("a").alias("g"), (F.col("id") * 1.5).alias("v"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = quantiles.exact_quantiles(rows, ["g"], "v", {"half": 0.5})._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    merged = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert merged and all("_range" in line for line in merged)
