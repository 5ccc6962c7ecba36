"""Similarities by blocks against plain arithmetic: ties, zero and odd vectors, lists by site, many blocks and groups."""

import math
import random

import pytest

from taxaflow.operators import vectors

A, C = "key long, site string, vector array<float>", "label string, site string, vector array<double>"


def unit(v):
    n = math.sqrt(sum(x * x for x in v))
    return [x / n if n else x for x in v]


def plain(rows, offers, scale, on):
    """key -> {label: (score, probability)}; None for a vector that cannot be compared, absent without candidates."""
    out = {}
    for k, s, v in rows:
        own = {c: w for c, t, w in offers if w is not None and (not on or (s is not None or t is None) and s == t)}
        if not own:
            continue
        dims = {len(w) for w in own.values() if w}
        if v is None or None in v or len(v) not in dims:
            out[k] = None
            continue
        a = unit(v)
        scores = {c: sum(x * y for x, y in zip(a, unit(w), strict=True)) for c, w in own.items()}
        top = max(scores.values())
        total = sum(math.exp(scale * (x - top)) for x in scores.values())
        out[k] = {c: (x, math.exp(scale * (x - top)) / total) for c, x in scores.items()}
    return out


def data(rng, n=60, m=23, dims=5):
    vec = lambda: [round(rng.uniform(-1, 1), 3) for _ in range(dims)]
    offers = [(f"c{i:02}", rng.choice("xyz"), vec()) for i in range(m)]
    offers += [(f"d{i}", s, offers[0][2]) for i, s in enumerate("xyz")] + [("none", "x", None), ("zero", "y", [0.0] * dims), ("nil", None, vec())]
    rows = [(i, rng.choice(["x", "y", "z", "w", None]), vec()) for i in range(n)]
    rows += [(100, "x", None), (101, "x", [1.0, None, 1.0, 1.0, 1.0]), (102, "y", [1.0]), (103, "z", [0.0] * dims), (104, "x", []), (105, "x", [float(v) for v in offers[0][2]]), (106, None, vec())]
    return rows, offers


@pytest.mark.parametrize("block, group", [(4096, 20_000), (4, 7)])
@pytest.mark.parametrize("on", [[], ["site"]])
def test_scores_of_blocks(spark, monkeypatch, block, group, on):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "GROUP", group)
    rows, offers = data(random.Random(block))
    frames = spark.createDataFrame(rows, A), spark.createDataFrame(offers, C).withColumnRenamed("vector", "centre")
    want = plain(rows, offers, 30.0, on)
    found = {r.key: r for r in vectors.softmax_top1(*frames, "key", "vector", "label", "centre", 30.0, on).collect()}
    assert found.keys() == want.keys()
    for k, own in want.items():
        r = found[k]
        if own is None:
            assert (r.label, r.score, r.probability) == (None, None, None)
            continue
        top = max(s for s, _ in own.values())
        assert r.score == pytest.approx(top, abs=1e-6) and r.probability == pytest.approx(own[r.label][1], rel=1e-4)
        assert r.label == min(c for c, (s, _) in own.items() if s > top - 1e-9)
    every = vectors.softmax_all(*frames, "key", "vector", "label", "centre", 30.0, on).collect()
    got = {}
    for r in every:
        got.setdefault(r.key, {})[r.label] = (r.score, r.probability)
    assert sum(len(v) for v in got.values()) == len(every)
    assert got.keys() == {k for k, own in want.items() if own is not None}
    for k, own in got.items():
        assert own.keys() == want[k].keys() and all(own[c] == (pytest.approx(want[k][c][0], abs=1e-6), pytest.approx(want[k][c][1], rel=1e-4, abs=1e-9)) for c in own)


def test_no_candidates_and_no_vectors(spark):
    rows, offers = data(random.Random(1), n=3)
    df, none = spark.createDataFrame(rows, A), spark.createDataFrame([], C)
    assert vectors.softmax_top1(df, none, "key", "vector", "label", "vector").count() == 0
    assert vectors.softmax_top1(spark.createDataFrame([], A), spark.createDataFrame(offers, C), "key", "vector", "label", "vector").count() == 0
    assert vectors.softmax_all(df, spark.createDataFrame([("a", "x", None)], C), "key", "vector", "label", "vector").count() == 0


def test_mean_of_specimens(spark):
    shares = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.4), (1, "a", 0.1), (1, "b", 0.9), (2, "b", 0.5), (2, "a", 0.5)], "record long, label string, p double")
    assert sorted((r.record, r.label, round(r.probability, 6)) for r in vectors.mean_probability(shares, "record", "label", "p").withColumnRenamed("p", "probability").collect()) == [(1, "b", 0.65), (2, "a", 0.5)]
