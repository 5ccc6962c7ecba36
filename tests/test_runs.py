"""The algebra of runs against decoded masks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaflow.functions import kernels, rasters, runs
from taxaflow.functions.runs import Window
from taxaflow.operators import inference
from taxaflow.sources.files import TableStore


def masks(seed):
    rng = np.random.default_rng(seed)
    h, w = (int(v) for v in rng.integers(1, 24, 2))
    kinds = [lambda: rng.random((h, w)) < 0.5, lambda: np.zeros((h, w), bool), lambda: np.ones((h, w), bool), lambda: np.add.outer(np.arange(h), np.arange(w)) % 9 < 4]
    return rng, h, w, [kinds[int(rng.integers(4))]() for _ in range(2)]


def decoded(code, h, w):
    return rasters.rle_decode(code, h, w) if code else np.zeros((h, w), bool)


@pytest.mark.parametrize("seed", range(40))
def test_and_or_minus(seed):
    _, h, w, (a, b) = masks(seed)
    x, y = (runs.intervals(rasters.rle_encode(m)) for m in (a, b))
    for got, want in ((runs.both(x, y), a & b), (runs.either(x, y, h * w), a | b), (runs.minus(x, y, h * w), a & ~b), (runs.outside(x, h * w), ~a)):
        assert got.pixels == want.sum()
        assert runs.coded(got, h * w) == rasters.rle_encode(want)
    ys, xs = np.nonzero(a)
    assert runs.extent(rasters.rle_encode(a), h) == ((xs.min(), ys.min(), xs.max(), ys.max()) if len(xs) else None)


@pytest.mark.parametrize("seed", range(60))
def test_windows(seed):
    rng, h, w, (a, _) = masks(seed)
    h2, w2 = (int(v) for v in rng.integers(1, 24, 2))
    b = rng.random((h2, w2)) < 0.6
    ax, ay, bx, by = (int(v) for v in rng.integers(-8, 12, 4))
    canvas = np.zeros((2, 80, 80), bool)
    canvas[0, ay + 20 : ay + 20 + h, ax + 20 : ax + 20 + w], canvas[1, by + 20 : by + 20 + h2, bx + 20 : bx + 20 + w2] = a, b
    both = canvas[0] & canvas[1]
    codes, places = [rasters.rle_encode(m) for m in (a, b)], [Window(ax, ay, h, w), Window(bx, by, h2, w2)]
    assert runs.overlap(codes[0], places[0], codes[1], places[1]) == both.sum()
    assert runs.restricted(codes[0], places[0], codes[1], places[1]) == rasters.rle_encode(both[ay + 20 : ay + 20 + h, ax + 20 : ax + 20 + w])


def test_large_masks_are_not_decoded():
    """A band of 40,000 by 40,000 pixels has 40,000 runs, and a sixth of a gigabyte as an array."""
    n = 40_000
    band = rasters.encode_runs([n // 4, *[n // 2, n // 2] * (n - 1), n // 2, n // 4])
    other = Window(n // 2, n // 4, n, n)
    assert runs.overlap(band, Window(0, 0, n, n), band, other) == (n // 2) * (n // 4)


def test_columns(spark):
    a, b = np.zeros((6, 5), bool), np.zeros((4, 9), bool)
    a[1:5, 1:4], b[0:3, 2:8] = True, True
    row = (1, rasters.rle_encode(a), 10, 20, 6, 5, rasters.rle_encode(b), 9, 21, 4, 9)
    df = spark.createDataFrame([row, (2, None, *row[2:]), (3, *row[1:7], None, *row[8:])], "id int, mask_rle string, win_x1 int, win_y1 int, mask_h int, mask_w int, head_rle string, pwin_x1 int, pwin_y1 int, parts_h int, parts_w int")
    got = {r.id: r for r in kernels.parts_in_mask(df, ["head"]).collect()}
    want = np.zeros((4, 9), bool)
    want[0:3, 2:5] = True
    assert (got[1].head_rle, got[1].head_area_px) == (rasters.rle_encode(want), 9)
    assert got[2].head_rle is None and got[2].head_area_px is None and got[3].head_area_px is None
    how = F.explode(F.array(*[F.lit(x) for x in ("and", "or", "minus")]))
    same = df.filter("id = 1").select(how.alias("how"), "mask_rle").select("how", kernels.mask_combined("how", "mask_rle", "mask_rle", F.lit(30)).alias("c"), kernels.mask_extent("mask_rle", F.lit(6)).alias("e"))
    assert {r.how: r.c.pixels for r in same.collect()} == {"and": 12, "or": 12, "minus": 0} and tuple(same.first().e) == (1, 1, 3, 4)


@pytest.mark.parametrize("seed", range(3))
def test_masks_inside_larger_ones_go(spark, seed):
    rng = np.random.default_rng(seed)
    rows, windows = [], {}
    for i in range(60):
        h, w = (int(v) for v in rng.integers(2, 40, 2))
        m = rng.random((h, w)) < rng.choice([0.3, 0.9, 1.0])
        if i % 11 == 0:
            m[:] = False
        x, y, image = int(rng.integers(0, 60)), int(rng.integers(0, 60)), int(i % 3)
        rows.append((image, i, x, y, rasters.rle_encode(m), h, w))
        windows.setdefault(image, []).append((i, (x, y, m)))
    df = spark.createDataFrame(rows, "image_id int, instance_id int, win_x1 int, win_y1 int, mask_rle string, mask_h int, mask_w int")
    want = {ids[k] for own in windows.values() for ids in [[i for i, _ in own]] for k in rasters.distinct_masks([m for _, m in own])}
    assert {r.instance_id for r in kernels.without_duplicate_masks(df).collect()} == want


@pytest.mark.parametrize("seed", range(20))
def test_borders(seed):
    _, h, w, (a, _) = masks(seed)
    assert runs.border_coverage(rasters.rle_encode(a), h, w) == pytest.approx(rasters.border_coverage(a))


def test_prompts_of_crops_and_backdrops(spark):
    labels, bare = np.zeros((60, 80), np.uint8), np.zeros((60, 80), np.uint8)
    labels[10:20, 30:50], labels[20:30, 30:50], labels[30:50, 25:55] = 1, 2, 3
    bare[30:50, 25:55] = 3
    image = np.full((100, 120, 3), 200, np.uint8)
    image[30:60, 40:90] = 30
    df = spark.createDataFrame([(1, labels.tobytes(), image.tobytes()), (2, bare.tobytes(), np.full((100, 120, 3), 9, np.uint8).tobytes()), (3, None, None)], "id int, labels binary, rgb binary")
    got = {r.id: r for r in df.select("id", kernels.crop_prompt("labels", F.lit(60), F.lit(80)).alias("p"), kernels.backdrop_box("rgb", F.lit(100), F.lit(120)).alias("b")).collect()}
    assert tuple(got[1].p) == (25, 10, 55, 50, "parts") and tuple(got[2].p) == (1, 1, 79, 59, "frame") and got[3].p.source is None
    assert tuple(got[1].b) == pytest.approx((40, 30, 90, 60), abs=2) and got[2].b.x1 is None and got[3].b.x1 is None


def test_backdrops_are_run_again(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    store = TableStore(spark, str(tmp_path))
    inner, ring = np.zeros((20, 20), bool), np.ones((20, 20), bool)
    inner[5:9, 5:9], ring[5:9, 5:9] = True, False
    held = [("x", "a", rasters.rle_encode(inner)), ("x", "b", rasters.rle_encode(ring)), ("x", "b", rasters.rle_encode(inner)), ("y", "c", rasters.rle_encode(ring)), ("y", "d", None)]
    store.append_shard("instances", spark.createDataFrame([(s, i, c, 20, 20) for s, i, c in held], "source string, image_id string, mask_rle string, mask_h int, mask_w int"))
    store.append_shard("images", spark.createDataFrame([(s, i) for s, i, _ in held[:2] + held[3:]], "source string, image_id string"))
    again = inference.requeued(store, inference.backdrop_queue(store.read_shards("instances")))
    assert sorted(r.image_id for r in again.collect()) == ["b", "c"]
    assert [sorted(r.image_id for r in store.read_shards(kind).collect()) for kind in ("instances", "images")] == [["a", "d"], ["a", "d"]]


def test_an_outlines_cover_is_that_of_the_array():
    rng = np.random.default_rng(5)
    for _ in range(200):
        mask = rng.random(rng.integers(1, 9, 2)) < rng.random()
        assert runs.border_coverage(rasters.rle_encode(mask), *mask.shape) == pytest.approx(rasters.border_coverage(mask))
