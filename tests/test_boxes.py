"""Boxes that meet on grids against all pairs: mixed sizes, edges of cells, no area, no numbers, one crowded image."""

import random

import pytest
from pyspark.sql import functions as F

from taxaflow.operators import boxes

SCHEMA = "image long, id long, score double, box struct<x1:double,y1:double,x2:double,y2:double>"
NAN, INF = float("nan"), float("inf")


def random_boxes(rng, n, images=3, start=0):
    out = []
    for i in range(n):
        side = rng.choice([0.3, 1, 5, 8, 30, 64, 500])
        x, y = rng.choice([rng.uniform(-300, 300), float(rng.randrange(-64, 64, 8))]), rng.choice([rng.uniform(-300, 300), 0.0])
        w, h = rng.choice([side, side * rng.random(), 0.0 if rng.random() < 0.1 else side]), side * rng.choice([1, 0.1, 3])
        out.append((rng.randrange(images), start + i, rng.choice([0.1, 0.5, 0.5, rng.random()]), (x, y, x + w, y + h)))
    return out


ODD = [
    (0, 900, 1.0, None), (0, 901, 1.0, (NAN, 0.0, 10.0, 10.0)), (0, 902, 1.0, (-INF, 0.0, 10.0, 10.0)), (0, 903, 1.0, (10.0, 0.0, -10.0, 10.0)),
    (0, 904, 1.0, (0.0, None, 10.0, 10.0)), (None, 905, 1.0, (0.0, 0.0, 10.0, 10.0)), (None, 906, 0.5, (0.0, 0.0, 10.0, 10.0)), (0, 907, 1.0, (5.0, 5.0, 5.0, 5.0)),
]


def whole(b):
    return b is not None and all(v is not None and abs(v) < 1e15 for v in b) and b[2] > b[0] and b[3] > b[1]


def inter(a, b):
    if not (whole(a) and whole(b)):
        return 0.0
    return max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0)


def area(b):
    return max(b[2] - b[0], 0) * max(b[3] - b[1], 0) if whole(b) else 0.0


def iou(a, b):
    return inter(a, b) / max(area(a) + area(b) - inter(a, b), 1e-9)


@pytest.mark.parametrize("seed", range(3))
def test_pairs_are_those_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    left, right = random_boxes(rng, 150) + ODD, random_boxes(rng, 150) + ODD
    found = boxes.iou_pairs(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), "image").collect()
    want = {(i, a, b): iou(x, y) for i, a, _, x in left for j, b, _, y in right if i is not None and i == j and inter(x, y) > 0}
    assert {(r.image, r.l_id, r.r_id): pytest.approx(r.iou) for r in found} == want
    assert len(found) == len(want)


@pytest.mark.parametrize("seed", range(3))
def test_suppression_is_the_greedy_one(spark, seed):
    rng = random.Random(10 + seed)
    rows = random_boxes(rng, 200) + ODD
    found = boxes.suppressed(spark.createDataFrame(rows, SCHEMA), "image").collect()
    want = {}
    for i, n, s, b in sorted(rows, key=lambda r: (-r[2], r[1])):
        kept = want.setdefault(i, [])
        if not any(iou(k, b) > 0.5 or inter(k, b) > 0.8 * max(area(b), 1e-9) for _, _, k in kept):
            kept.append((n, s, b))
    assert {r.image: [k.id for k in r.kept] for r in found} == {i: [n for n, _, _ in kept] for i, kept in want.items()}


@pytest.mark.parametrize("seed", range(3))
def test_points_find_the_smallest_box(spark, seed):
    rng = random.Random(20 + seed)
    rows = random_boxes(rng, 150) + ODD
    edges = [v for _, _, _, b in rows[:40] for v in (b[0], b[2])]
    points = [(rng.randrange(3), i, rng.choice([rng.uniform(-300, 300), rng.choice(edges)]), rng.choice([rng.uniform(-300, 300), 0.0])) for i in range(300)]
    points += [(0, 300, None, 1.0), (0, 301, NAN, 1.0), (0, 302, INF, 1.0), (None, 303, 1.0, 1.0), (7, 304, 1.0, 1.0)]
    found = boxes.smallest_containing(spark.createDataFrame(points, "image long, p_id long, x double, y double"), spark.createDataFrame(rows, SCHEMA), "image")
    want = {}
    for i, p, x, y in points:
        inside = [(area(b), n) for j, n, _, b in rows if i is not None and i == j and whole(b) and x is not None and y is not None and b[0] <= x <= b[2] and b[1] <= y <= b[3]]
        want[p] = min(inside)[1] if inside else None
    assert {r.p_id: r.box_id for r in found.collect()} == want


def test_one_crowded_image_has_few_candidates(spark):
    """10,000 boxes and one as large as the image: the pairs that meet follow those that overlap, not all 10^8."""
    rows = [(1, i, 0.5, (i % 100 * 30.0, i // 100 * 30.0, i % 100 * 30.0 + 20, i // 100 * 30.0 + 20)) for i in range(10_000)] + [(1, 10_000, 0.4, (0.0, 0.0, 3000.0, 3000.0))]
    df = spark.createDataFrame(rows, SCHEMA)
    placed = boxes._placed(df, boxes._corners("box"))
    dealt = boxes._dealt(placed, "box", boxes._levels(placed))
    assert dealt.count() < 10_001 * 5
    cells = dealt.groupBy("_at", "_cx", "_cy").agg(F.count("*").alias("n"), F.count_if("_home").alias("homes"))
    assert cells.agg(F.sum(F.col("n") * F.col("homes"))).first()[0] < 6 * 30_001
    assert boxes.iou_pairs(df, df, "image").count() == 10_001 + 2 * 10_000


def test_empty_sides(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, 1, 1.0, (0.0, 0.0, 2.0, 2.0))], SCHEMA)
    assert boxes.iou_pairs(none, some, "image").count() == boxes.iou_pairs(some, none, "image").count() == 0
    assert boxes.suppressed(none, "image").count() == 0
    assert [r.box_id for r in boxes.smallest_containing(spark.createDataFrame([(1, 5, 1.0, 1.0)], "image long, p_id long, x double, y double"), none, "image").collect()] == [None]


def test_trays(spark):
    """Image 1: tiles find little more; image 2: clearly more, with a part of a whole one and a box of the whole tray; image 3: tiles alone."""
    flat = lambda i, n, s, x, w=10.0: (i, n, s, (x, 0.0, x + w, 10.0))
    whole = [flat(1, 1, 0.9, 0.0), flat(1, 2, 0.8, 20.0), flat(2, 3, 0.9, 0.0), (2, 4, 1.0, (0.0, 0.0, 300.0, 300.0)), flat(4, 5, 0.9, 0.0)]
    tiled = [flat(1, k, 0.5, 20.0 * k) for k in range(10, 13)] + [flat(2, 20, 0.7, 0.0, 5.0)] + [flat(2, k, 0.6, 20.0 * k) for k in range(21, 27)] + [flat(3, k, 0.6, 20.0 * k) for k in range(30, 33)]
    sizes = spark.createDataFrame([(i, 600, 600) for i in range(1, 4)], "image long, width int, height int")
    found = boxes.tray_boxes(spark.createDataFrame(whole, SCHEMA), spark.createDataFrame(tiled, SCHEMA), sizes, "image").collect()
    assert sorted((r.image, r.source, r.id) for r in found) == [(1, "whole", 1), (1, "whole", 2), (2, "tiles", 3), *[(2, "tiles", k) for k in range(21, 27)], *[(3, "tiles", k) for k in range(30, 33)]]
