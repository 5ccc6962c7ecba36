"""Small golden tables for null, tie and priority rules, and the composite plans on drawn data."""

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.functions import kernels, rasters, signals, text
from taxaflow.operators import boxes, inference, linkage, selection, shaping, summaries
from taxaflow.plans import measurements, specimens, validation
from taxaflow.plans.queries import QUERIES


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_a_record_without_a_date_is_the_latest(spark):
    df = spark.createDataFrame([("A", "2020", 1), ("A", None, 2), ("A", "2021", 3), ("B", "2019", 4), (None, "1", 5), (None, "2", 6)], "k string, d string, i int")
    assert rows(selection.latest(df, ["k"], "d", [F.desc("i")]), "k", "i") == rows(selection.latest_wide(df, ["k"], "d", "i"), "k", "i") == sorted([("A", 2), ("B", 4), (None, 6)], key=repr)


def test_the_experts_missing_taxon_stays_missing(spark):
    para = spark.createDataFrame([("i1", "P1", "Par a", "2020-01-01", "2019-07-04", "p1"), ("i2", "P2", "Par b", None, "bad", "p2")], "individualID string, taxonID string, scientificName string, identifiedDate string, collectDate string, plotID string")
    expert = spark.createDataFrame([("i1", None, "Exp a", "2021-01-01")], "individualID string, taxonID string, scientificName string, identifiedDate string")
    field = spark.createDataFrame([("p1", "forest", 1.0, 2.0, 3.0, None), ("p1", "late", 1.0, 2.0, 3.0, "2020")], "plotID string, nlcdClass string, decimalLatitude double, decimalLongitude double, elevation double, collectDate string")
    man = specimens.specimen_manifest(para, expert, field)
    assert rows(man, "individualID", "bestTaxonID", "bestScientificName", "idSource", "year", "nlcdClass") == [("i1", None, "Exp a", "expert", 2019, "late"), ("i2", "P2", "Par b", "parataxonomist", None, None)]
    assert man.count() == 2
    plain = specimens.specimen_manifest(para)
    assert rows(plain, "individualID", "bestTaxonID", "idSource") == [("i1", "P1", "parataxonomist"), ("i2", "P2", "parataxonomist")]


def test_vouchers_come_before_other_records(spark):
    man = spark.createDataFrame([("i1",), ("i2",), (None,)], "individualID string")
    rec = spark.createDataFrame([("i1", "DNA", "c1", "o1", 5), ("i1", "CARC-PV", "c2", "o2", 0), (None, "CARC-PV", "c3", "o3", 9)], "individualID string, collection string, catalogNumber string, occid string, n_images int")
    gbif = spark.createDataFrame([("g2", "c2"), ("g0", None)], "gbifID string, catalogNumber string")
    out = specimens.link_repository(man, rec, gbif)
    assert rows(out, "individualID", "biorepo_collection", "biorepo_n_images", "in_biorepository", "gbifID") == sorted([("i1", "CARC-PV", 0, True, "g2"), ("i2", None, 0, False, None), (None, None, 0, False, None)], key=repr)


def test_samples_link_by_id_then_hash_then_barcode(spark):
    sort = spark.createDataFrame([("s1", "b1", "2019-05-01", "carabid", "3"), ("s2", "b2", None, "odd", "x"), ("s3", "b3", "2020", "carabid", None), ("s4", "b4", None, None, None), (None, "b3", None, None, None), ("s1", "zz", "2020", None, None)], "subsampleID string, subsampleCode string, collectDate string, sampleType string, individualCount string")
    pool = spark.createDataFrame([("v1", "b9", "a|b||c"), ("v2", None, None)], "archiveVialID string, archiveSampleCode string, subsampleIDList string")
    rec = spark.createDataFrame([("c1", "s1", None, "b1", "X", "o1", 1), ("c2", None, "s2", "b1", "X", "o2", 2), ("c3", None, None, "b3", "Y", "o3", None), (None, "s4", "s4", "b4", "Y", "o4", 4)], "catalogNumber string, neon_sampleID string, neon_sampleID_hash string, neon_barcode string, collection string, occid string, n_images int")
    out = specimens.preserved_samples(sort, pool, rec)
    assert rows(out, "sample_id", "biorepo_catalogNumber", "biorepo_link", "biorepo_n_images", "in_biorepository") == sorted([
        ("s1", "c1", "sample ID", 1, True), ("s2", "c2", "sample ID hash", 2, True), ("s3", "c3", "barcode", 0, True), ("s4", None, None, 0, False),
        ("v1", None, None, 0, False), ("v2", None, None, 0, False)], key=repr)
    assert rows(out.filter("level = 'archive pooling'"), "sample_id", "n_pooled_subsamples") == [("v1", 3), ("v2", 0)]
    assert rows(out.filter("sample_id IN ('s1', 's2')"), "sample_id", "specimen_group", "individualCount", "year") == [("s1", "bulk carabid", 3.0, 2019), ("s2", "odd", None, None)]


@pytest.mark.parametrize("value,expected", [
    ("NEON sampleID: KONZ_007.20180612.HARPEN.04; NEON sampleUUID: u-17", ("KONZ_007.20180612.HARPEN.04", None, None, "u-17")),
    ("NEON sampleCode (barcode): B000555 | NEON sampleID Hash: q9+/=|colour: dark", (None, "q9+/=", "B000555", None)),
    ("", (None, None, None, None)), ("no labels: here", (None, None, None, None)), (None, (None, None, None, None)),
])
def test_identifiers(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string").select(text.labelled_pairs(F.col("v"), specimens.IDENTIFIERS).alias("p"))
    assert tuple(df.first().p) == expected


def column_of(spark, f, values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in values], f"v {kind}").select(f(F.col("v"))).collect()]


def test_scale_labels_in_millimetres(spark):
    stated = {"2 cm": 20, "250um": 0.25, "Bar 0.75MM": 0.75, "12,25 mm": 12.25, "7 rnm wide": 7, "40 µm": 0.04, "mm": None, "9 inches": None, None: None}
    assert column_of(spark, text.label_millimetres, stated) == [v if v is None else pytest.approx(v) for v in stated.values()]


def test_names_parts_and_padding(spark):
    assert column_of(spark, text.part_count, ["||", "x|y", "z", None]) == [0, 2, 1, 0]
    assert column_of(spark, text.binomial, ["Harpalus cf. affinis", "Harpalus  affinis Schrank", " Amara ", None]) == ["Harpalus", "Harpalus affinis", "Amara", None]
    assert column_of(spark, lambda c: text.padded(c, 5), ["", "42", "123456", None]) == ["00000", "00042", "123456", None]


def test_markup_becomes_plain_text(spark):
    given = ["<p>Caf&eacute; &#8217;n&#x27; bar</p>", "<ol><li class=x>one<li>two</ol>", "a&nbsp;&nbsp;b &lt;i&gt; &amp;lt;", "<br><hr>", None]
    assert column_of(spark, text.plain_text, given) == ["Café ’n' bar", "- one - two", "a b <i> &lt;", None, None]


def test_coordinates_of_lines(spark):
    given = ['[{"x1":7,"y1":0.5,"x2":-3,"y2":2}]', "[[9,8,7.5,6],[1,1,1,1]]", "[]", "{", None]
    assert [tuple(r) for r in column_of(spark, text.line_coords, given)] == [(7, 0.5, -3, 2), (9, 8, 7.5, 6), (None,) * 4, (None,) * 4, (None,) * 4]


@pytest.mark.parametrize("collection,url,kind,view", [
    ("TREE", "https://host/p/A00000870021.jpeg", "tray_ethanol", None), ("IVBC", "http://host/LATERAL-2.png?w=9", "bycatch", "lateral"),
    ("CARC-PV", "http://host/dorsal/b.tif", "pinned", None), ("BULK", "z_ventral.gif", "individual", "ventral"),
])
def test_kinds_and_views_of_images(spark, collection, url, kind, view):
    df = spark.createDataFrame([(collection, url)], "c string, u string")
    assert tuple(df.select(text.image_kind(F.col("c"), F.col("u")), text.image_view(F.col("u"))).first()) == (kind, view)


def test_a_bar_and_its_first_readable_label(spark):
    df = spark.createDataFrame([(10, 210, ["fig", "4 mm", "1 cm"]), (0, 90, ["none"]), (0, 90, None)], "x1 int, x2 int, labels array<string>")
    found = df.select(kernels.printed_bar_scale(F.struct("x1", "x2"), F.col("labels")).alias("v")).collect()
    assert [r.v for r in found] == [50, None, None]


def test_kernels_over_rows_of_images(spark):
    page = np.full((300, 420), 210, np.uint8)
    page[250:253, 60:200] = 12
    labels = np.zeros((60, 120), np.uint8)
    labels[18:42, 8:22], labels[12:48, 22:45], labels[6:54, 45:110] = 1, 2, 3
    df = spark.createDataFrame([(page.tobytes(), labels.tobytes()), (None, None)], "page binary, labels binary")
    at = (F.lit(300), F.lit(420))
    got = df.select(kernels.printed_bar("page", *at).alias("bar"), kernels.checkerboard_scale("page", *at).alias("board"), kernels.part_metrics("labels", F.lit(60), F.lit(120)).alias("parts")).collect()
    assert tuple(got[0].bar) == (60, 250, 200, 253) and got[0].board.px_per_mm is None and got[0].parts.parts_complete
    assert got[0].parts.elytra_length_px == pytest.approx(65, abs=2) and got[1].bar.x1 is None and got[1].parts.parts_ok is None


def test_duplicates_keep_earlier_marks(spark):
    df = spark.createDataFrame([("b", "h", None), ("a", "h", None), ("c", "u", None), ("0", "h", "tray"), ("d", None, None)], "i string, h string, m string")
    assert rows(selection.content_duplicates(df, "i", "h", "m"), "i", "duplicate_of") == [("0", "tray"), ("a", None), ("b", "a"), ("c", None), ("d", None)]


def test_frames_of_annotations(spark):
    df = spark.createDataFrame([(g, 1.0, m, 10.0) for g, m in (("a", 1.0), ("b", 1.05), ("c", 1.09), ("d", None))], "g string, a double, m double, x double")
    out = shaping.fixed_annotation_frame(df, ["g"], "m", "a", ["x"])
    assert [(r.g, r.frame_ok, r.x) for r in out.orderBy("g").collect()] == [("a", True, 10), ("b", True, 10), ("c", False, pytest.approx(10.9)), ("d", False, 10)]


def test_preference_mode_agreement_and_histogram(spark):
    lines = spark.createDataFrame([("t", "x")] * 5 + [("t", "Isa"), ("u", "y"), ("u", "x"), ("u", None)], "g string, v string")
    assert rows(summaries.preferred_else_most_frequent(lines, "g", "v", "Isa"), "g", "v", "n") == [("t", "Isa", 1), ("u", "x", 1)]
    pairs = spark.createDataFrame([("a", 1.0, 1.1), ("a", 2.0, 2.0), ("a", 4.0, 3.0), ("a", 0.0, 9.0), ("b", 1.0, 1.0), ("b", 2.0, None)], "g string, t double, m double")
    out = {r.g: r for r in pairs.groupBy("g").agg(*[c.alias(k) for k, c in summaries.agreement(F.col("t"), F.col("m")).items()]).collect()}
    assert (out["a"].n, out["a"].n_both, out["a"].bias) == (3, 4, pytest.approx(-0.3)) and out["a"].within_10pct == pytest.approx(1 / 3)
    assert out["b"].n == 1 and out["b"].bias is None and out["b"].pearson_r is None
    h = summaries.histogram(spark.createDataFrame([(0.0,), (2.0,), (42.0,), (43.0,), (None,)], "v double"), "v", 0.0, 42.0, 21)
    assert rows(h, "bin", "n") == [(0, 1), (1, 1), (20, 1)]


def box(x1, y1, x2, y2):
    return (float(x1), float(y1), float(x2), float(y2))


BOX = "struct<x1:double,y1:double,x2:double,y2:double>"


def test_the_higher_of_two_overlapping_boxes_stays(spark):
    schema = f"image_id string, id int, score double, box {BOX}"
    held = [("p", 4, 0.61, box(3, 2, 23, 22)), ("p", 9, 0.95, box(4, 2, 24, 22)), ("p", 2, 0.33, box(60, 60, 64, 90)), ("q", 1, 0.2, box(4, 2, 24, 22))]
    found = boxes.suppressed(spark.createDataFrame(held, schema), "image_id")
    assert {r.image_id: [k.id for k in r.kept] for r in found.collect()} == {"p": [9, 2], "q": [1]}
    assert boxes.suppressed(spark.createDataFrame([], schema), "image_id").count() == 0


def test_a_truth_is_matched_once(spark):
    schema = f"image_id string, id int, box {BOX}"
    found = spark.createDataFrame([("p", 1, box(0, 0, 8, 8)), ("p", 2, box(0, 0, 8, 7)), ("q", 3, box(6, 0, 14, 8)), ("r", 4, box(1, 1, 2, 2))], schema)
    truth = spark.createDataFrame([("p", 50, box(0, 0, 8, 8)), ("q", 51, box(0, 0, 8, 8))], schema)
    assert rows(boxes.matched(found, truth, "image_id"), "image_id", "tp") == [("p", 1)]
    assert {r.l_id: r.iou for r in boxes.iou_pairs(found, truth, "image_id").collect()} == {1: 1, 2: pytest.approx(7 / 8), 3: pytest.approx(16 / 112)}


def test_matching_is_the_greedy_loop_on_random_boxes(spark):
    rng = np.random.default_rng(5)
    make = lambda n, k: [(f"i{i}", j, box(x, y, x + w, y + h)) for i in range(k) for j, (x, y, w, h) in enumerate(rng.integers(1, 12, (n, 4)).tolist())]
    det, tru = make(7, 25), make(6, 25)
    iou = lambda a, b: (lambda i: i / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i))(max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1])))
    expected = {}
    for image in {d[0] for d in det}:
        used, truth = set(), [t for t in tru if t[0] == image]
        found = sorted(([iou(d[2], t[2]) for t in truth] for d in det if d[0] == image), key=lambda v: -max(v))
        for v in found:
            if max(v) >= 0.5 and int(np.argmax(v)) not in used:
                used.add(int(np.argmax(v)))
        if used:
            expected[image] = len(used)
    frames = [spark.createDataFrame(x, f"image_id string, id int, box {BOX}") for x in (det, tru)]
    assert dict(rows(boxes.matched(*frames, "image_id"), "image_id", "tp")) == expected


@pytest.mark.parametrize("width,height", [(640, 480), (1856, 1857), (4003, 2511)])
def test_tiles_cover_each_pixel_and_are_small(spark, width, height):
    tiles = boxes.tiles(spark.createDataFrame([(width, height)], "w int, h int"), "w", "h", 1856).collect()
    seen = np.zeros((height, width), bool)
    for r in tiles:
        assert 0 < r.x2 - r.x1 <= 1856 and 0 < r.y2 - r.y1 <= 1856
        seen[r.y1 : r.y2, r.x1 : r.x2] = True
    assert seen.all() and (len(tiles) == 1) == (max(width, height) <= 1856)


@pytest.mark.parametrize("given,window", [(box(20, 30, 40, 38), (10, 26, 50, 42)), (box(0, 60, 9, 70), (0, 55, 14, 70)), (box(65, 1, 80, 9), (57, 0, 80, 13))])
def test_windows_stay_inside_the_image(spark, given, window):
    df = spark.createDataFrame([(given,)], f"b {BOX}")
    assert tuple(df.select(boxes.crop_window(F.col("b"), F.lit(80), F.lit(70), 0.5).alias("w")).first().w) == window


def instance(i, x, y, mask):
    h, w = mask.shape
    return ("img", i, x, y, rasters.rle_encode(mask), h, w, box(x, y, x + w, y + h))


INSTANCE = f"image_id string, instance_id string, win_x1 int, win_y1 int, mask_rle string, mask_h int, mask_w int, box {BOX}"


def test_points_fall_on_masks_before_boxes(spark):
    full, left = np.ones((10, 20), bool), np.zeros((10, 20), bool)
    left[:, :5] = True
    inst = spark.createDataFrame([instance("b", 0, 0, full), instance("a", 0, 0, full), instance("c", 50, 50, left), instance("d", 48, 48, np.zeros((40, 40), bool))], INSTANCE)
    pts = spark.createDataFrame([("img", 1, 2.0, 2.0), ("img", 2, 60.0, 55.0), ("img", 3, 300.0, 1.0), ("img", 4, None, 1.0), ("img", 5, 52.4, 58.6), ("none", 6, 1.0, 1.0)], "image_id string, p_id int, x double, y double")
    assert rows(kernels.points_in_masks(pts, inst), "p_id", "instance_id") == [(1, "a"), (2, "c"), (3, None), (4, None), (5, "c"), (6, None)]
    kept = kernels.without_duplicate_masks(inst.filter("instance_id IN ('a', 'b', 'c')"))
    assert rows(kept, "instance_id") == [("a",), ("c",)]


def test_measured_columns_of_masks(spark):
    y, x = np.mgrid[:100, :150]
    mask = ((x - 75) / 60) ** 2 + ((y - 50) / 30) ** 2 <= 1
    df = spark.createDataFrame([(rasters.rle_encode(mask), 100, 150), (None, 1, 1)], "c string, h int, w int")
    out = df.select("h", kernels.mask_metrics("c", "h", "w").alias("m"), kernels.midline("c", "h", "w").alias("l"), kernels.mask_code(kernels.mask_runs("c"), "h", "w").alias("again"), "c").collect()
    assert out[0].m.length_px == pytest.approx(120, abs=3) and out[0].again == out[0].c and out[0].l > 60
    assert out[1].m.area_px is None and out[1].l is None


def test_measurements_of_a_small_lake(spark):
    lab = np.zeros((60, 120), np.uint8)
    lab[20:40, 10:20], lab[15:45, 20:40], lab[10:50, 40:100] = 1, 2, 3
    codes = [rasters.rle_encode(lab == k) for k in (1, 2, 3)]
    inst = spark.createDataFrame([("img#001", "img", 0, 0, 60.0, 120.0, *codes, 100.0, 0.4), ("img#002", "img", 0, 0, None, None, None, None, None, 50.0, None)], "instance_id string, image_id string, pwin_x1 int, pwin_y1 int, parts_h double, parts_w double, head_rle string, pronotum_rle string, elytra_rle string, length_px double, solidity double")
    sizes = spark.createDataFrame([("img", 500, 400)], "image_id string, width int, height int")
    wide = measurements.with_base_widths(inst, sizes)
    got = {r.instance_id: r for r in wide.collect()}
    assert got["img#001"].elytra_base_width_px == pytest.approx(40, abs=2) and got["img#001"].trunk_touches_edge is False
    assert got["img#002"].elytra_base_width_px is None and got["img#002"].trunk_touches_edge is None
    scales = spark.createDataFrame([("img", 10.0, "ruler", 0.9)], "image_id string, px_per_mm double, scale_source string, scale_confidence double")
    man = spark.createDataFrame([("img", "herp", "i9", "Carabus x", "P1")], "image_id string, source string, individualID string, scientificName string, plotID string")
    ann = spark.createDataFrame([("img#001", "i1", None, 4.0)], "instance_id string, ann_individualID string, ann_scientificName string, ann_elytra_length_mm double")
    out = {r.instance_id: r for r in measurements.measurements(wide, scales, man, ann).collect()}
    a, b = out["img#001"], out["img#002"]
    assert (a.length_mm, a.individualID, a.scientificName, a.qc_low_solidity, a.qc_has_scale) == (10.0, "i1", "Carabus x", True, True)
    assert (b.length_mm, b.individualID, b.qc_low_solidity) == (5.0, "i9", False) and "head_rle" not in out["img#001"].asDict()


def test_scales_are_gated_together_by_source(spark):
    held = [
        ("board", "hf2018", 10.0, 0.98, 5, 0.02, None), ("loose", "hf2018", 10.0, 0.96, 5, 0.04, None), ("lone", "hf2018", 10.0, 1.0, 1, 0.0, None),
        ("ruler", "sentinel", 12.0, 0.4, 8, None, None), ("weak", "sentinel", 12.0, 0.39, 9, None, None), ("short", "sentinel", 12.0, 0.9, 7, None, None),
        ("frog", "herp", 9.0, 0.41, 20, None, None), ("dim", "herp", 9.0, 0.35, 25, None, None), ("bar", "biorepo", 30.0, None, None, None, 0.15), ("stub", "biorepo", 30.0, None, None, None, 0.14),
        ("none", "sentinel", None, 0.0, 0, None, None), ("other", "hawaii", 7.0, 1.0, 9, 0.0, 1.0),
    ]
    r = spark.createDataFrame(held, "image_id string, source string, px_per_mm double, strength double, n int, spread double, part double")
    want = {
        "board": (10.0, "checkerboard", 0.98), "loose": (None, None, 0.0), "lone": (None, None, 0.0), "ruler": (12.0, "ruler_ticks", 0.4), "weak": (None, None, 0.39), "short": (None, None, 0.9),
        "frog": (9.0, "ruler_ticks", 0.41), "dim": (None, None, 0.35), "bar": (30.0, "printed_bar", 1.0), "stub": (None, None, 0.0), "none": (None, None, 0.0), "other": (None, None, None),
    }
    shown = lambda df: {x.image_id: (x.px_per_mm, x.scale_source, x.scale_confidence) for x in df.collect()}
    assert shown(measurements.image_scale(r)) == want
    given = spark.createDataFrame([("weak", 5.0), ("new", 6.0), ("board", 4.0), ("loose", None)], "image_id string, px_per_mm double")
    assert shown(measurements.image_scale(r, given)) == want | {"weak": (5.0, "annotated", 1.0), "new": (6.0, "annotated", 1.0)}


def test_scales_are_read_from_drawn_images(spark):
    def page(h, w, light=222):
        return np.full((h, w), light, np.uint8)

    ruler, low = page(90, 330), page(400, 700)
    for k in range(16):
        ruler[18:72, 25 + 17 * k : 28 + 17 * k] = 40
    for k in range(30):
        low[290:370, 20 + 14 * k : 23 + 14 * k] = 40
    board = page(480, 640, 35)
    for i, j in ((i, j) for i in range(7) for j in range(6) if (i + j) % 2 == 0):
        board[90 + 47 * j : 137 + 47 * j, 110 + 47 * i : 157 + 47 * i] = 225
    printed = page(640, 980, 205)
    printed[560:563, 120:385] = 25
    images = [("r", "sentinel", ruler, None), ("f", "herp", low, None), ("c", "hf2018", board, None), ("p", "biorepo", printed, ["fig", "5 mm"]), ("q", "biorepo", printed, None), ("x", "unknown", ruler, None)]
    rows_ = [(i, s, a.tobytes(), *a.shape, labels) for i, s, a, labels in images] + [("null", "sentinel", None, None, None, None)]
    df = spark.createDataFrame(rows_, "image_id string, source string, pixels binary, height int, width int, labels array<string>")
    got = {r.image_id: r for r in measurements.image_scale(measurements.read_scales(df)).collect()}
    assert got.keys() == {"r", "f", "c", "p", "q", "null"}
    assert [got[i].scale_source for i in "rfcpq"] == ["ruler_ticks", "ruler_ticks", "checkerboard", "printed_bar", None]
    assert [got[i].px_per_mm for i in "rfcp"] == [pytest.approx(17, rel=0.02), pytest.approx(14, rel=0.02), pytest.approx(4.7, rel=0.05), pytest.approx(53, abs=0.5)]
    uses = spark.createDataFrame([("crop1", "r"), ("crop2", "r"), ("crop3", "gone")], "image_id string, scale_image string")
    shared = {r.image_id: r for r in measurements.read_scales(df, uses).collect()}
    assert shared["crop1"].px_per_mm == shared["crop2"].px_per_mm == got["r"].px_per_mm and shared["crop3"].source is None


def test_manifest_routes_and_duplicates(spark):
    bio = spark.createDataFrame([("biorepo/A1", "http://x/A1_lg.jpg", "tray_ethanol", "bulk carabid", "Carabidae", "o1", None), ("biorepo/z", "http://x/z.jpg", "pinned", "pinned carabid", "Carabidae", "o2", None), ("biorepo/y", "http://x/y.jpg", "pinned", "pinned carabid", "Carabidae", "o3", None), ("biorepo/h", "http://x/h.jpg", "bycatch", "herptile bycatch", "Bufonidae", "o4", None), ("biorepo/e", "http://x/e.jpg", "pinned", "x", "Carabidae", "o5", None)], "image_id string, image_url string, image_kind string, specimen_group string, family string, occid string, neon_barcode string")
    files = spark.createDataFrame([("biorepo/A1", "ok", "h1"), ("biorepo/z", "ok", "h2"), ("biorepo/y", "ok", "h2"), ("biorepo/h", "ok", "h3"), ("biorepo/e", "error", None)], "image_id string, status string, sha256 string")
    crops = measurements.anonymous_manifest(spark.createDataFrame([("c1", "S", "2018-01")], "public_id string, siteID string, collectDate string"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("image_id", "source", "route", "duplicate_of", "neon_barcode", "anon_siteID")] + [T.StructField("is_carabid", T.BooleanType())])
    out = measurements.image_manifest(bio, files, [crops], spark.createDataFrame([("A1",)], "barcode string"), schema)
    assert rows(out, "image_id", "source", "route", "duplicate_of", "process") == [
        ("biorepo/A1", "biorepo", "tray", "hf2018/A1", False), ("biorepo/h", "herp", "herp", None, True), ("biorepo/y", "biorepo", "single", None, True),
        ("biorepo/z", "biorepo", "single", "biorepo/y", False), ("sentinel/c1", "sentinel", "crop", None, True)]


def test_species_suggestions(spark):
    rec = spark.createDataFrame([(f"o{i}", "herptile bycatch", rank, name, None, "S", "1", "x", key) for i, (rank, name, key) in enumerate([("genus", "Anaxyrus", None), ("family", "Ranidae", None), ("class", "Amphibia", None), ("Species", "Anaxyrus boreas", 1)])], "occid string, specimen_group string, taxonRank string, scientificName string, identificationQualifier string, siteID string, decimalLatitude string, decimalLongitude string, speciesKey int")
    r = validation.species_records(rec)
    assert rows(r, "occid", "to_species", "higher_taxon", "decimalLongitude") == [("o0", False, "Anaxyrus", None), ("o1", False, "Ranidae", None), ("o2", False, "Amphibia", None), ("o3", True, "Anaxyrus", None)]
    cand = spark.createDataFrame([("S", "Anaxyrus", "A. boreas", 1, 9), ("S", "Ranidae", "R. a", 2, 5), ("S", "Ranidae", "R. b", 3, 5), ("S", "Ranidae", "R. c", 4, 1)], "siteID string, higher_taxon string, species string, speciesKey int, n_observations int")
    models = spark.createDataFrame([("o1", "R. b", 3, 0.6), ("o3", "A. boreas", 1, 0.7)], "occid string, model_pick string, model_pick_key int, model_prob double")
    out = validation.suggestions(r, validation.range_picks(cand), models)
    assert rows(out, "occid", "suggested_species", "range_pick", "range_agrees") == [("o0", "A. boreas", "A. boreas", None), ("o1", "R. b", "R. a", None), ("o2", None, None, None), ("o3", None, "A. boreas", True)]
    acc = validation.suggestion_accuracy(out, cand)
    assert rows(acc, "subset", "records", "range_pick_accuracy") == [("all", 1, 1.0)]
    weak = validation.suggestions(r, validation.range_picks(cand), models.withColumn("model_prob", F.lit(0.59)))
    assert rows(weak.filter("occid = 'o1'"), "suggested_species") == [(None,)]


def test_validation_of_detections(spark):
    det = spark.createDataFrame([("i", 1, box(0, 0, 10, 10)), ("i", 2, box(50, 50, 60, 60))], f"image_id string, id int, box {BOX}")
    tru = spark.createDataFrame([("i", 7, box(0, 0, 10, 9)), ("j", 8, box(0, 0, 5, 5))], f"image_id string, id int, box {BOX}")
    lines = spark.createDataFrame([("i", "Isa", 5, 1), ("i", "Isa", 5, 2), ("i", "Isa", 6, 3), ("i", "bob", 5, 9)], "image_id string, user_name string, workflowID int, individual int")
    placed = spark.createDataFrame([("i", 1, "i#1"), ("i", 2, None)], "image_id string, individual int, instance_id string")
    v = validation.detection_validation(det, tru, lines.withColumn("workflowID", F.col("workflowID").cast("string")), placed, "Isa")
    assert rows(v, "image_id", "n_detected", "n_human_boxes", "tp_iou50", "n_annotated", "n_annotated_covered") == [("i", 2, 1, 1, 2, 1), ("j", 0, 1, 0, 0, 0)]
    s = validation.detection_summary(v).first()
    assert (s.precision, s.recall, s.within_one) == (0.5, 0.5, 1.0)
    assert validation.compared_methods(det, det, tru, 5).count() == 2


def test_reports(spark):
    spec = spark.createDataFrame([("S", "Carabus", True, 2019, "expert"), ("S", None, False, 2020, "parataxonomist")], "siteID string, bestScientificName string, in_biorepository boolean, year int, idSource string")
    man = spark.createDataFrame([("i", True), ("j", None)], "image_id string, process boolean")
    mea = spark.createDataFrame([("i", "herp", True, True, 4.0, "Carabus sp."), ("i", "herp", None, False, None, None)], "image_id string, source string, parts_ok boolean, qc_has_scale boolean, length_mm double, scientificName string")
    tables = {n: [r.asDict() for r in df.collect()] for n, df in validation.report_aggregates(spec, man, mea).items()}
    assert tables["sites"] == [{"siteID": "S", "n": 2, "taxa": 1, "linked": 0.5}]
    assert [r["n"] for r in sorted(tables["funnel"], key=lambda r: r["step"])] == [2, 1, 1, 1]
    page = validation.render_report("A & B", tables)
    assert "A &amp; B" in page and page.count("<table>") == len(tables)


def test_models_isolate_errors_and_resume(spark):
    class Halves:
        def predict(self, batch):
            if any(r["v"] == 0 for r in batch):
                raise ZeroDivisionError
            return [{"half": r["v"] / 2} for r in batch]

    man = spark.createDataFrame([("a", "tray", True, 4), ("b", "tray", True, 0), ("c", "crop", True, 8), ("d", "crop", None, 2), ("e", "tray", True, 6)], "image_id string, route string, process boolean, v int")
    run = lambda df: inference.predicted(df, "halves", Halves, "half double")
    done = spark.createDataFrame([("e",)], "image_id string")
    out = inference.routed(man, {"tray": run, "crop": run}, done)
    assert rows(out, "image_id", "half", "status") == [("a", 2.0, "ok"), ("b", None, "error:ZeroDivisionError"), ("c", 4.0, "ok")]
    assert rows(inference.recheck_queue(out, out.filter("image_id = 'a'").select("image_id")), "image_id") == [("b",), ("c",)]


def test_asof_takes_the_last_known_value(spark):
    t = [dt.datetime(2020, 1, d) for d in range(1, 6)]
    left = spark.createDataFrame([("k", 1, t[1]), ("k", 2, t[4]), ("m", 3, t[4])], "k string, i int, ts timestamp")
    right = spark.createDataFrame([("k", t[1], 5.0), ("k", t[2], 6.0)], "k string, ts timestamp, v double")
    assert rows(linkage.asof(left, right, "k", "ts", "ts", "v"), "i", "v") == [(1, 5.0), (2, 6.0), (3, None)]


def test_periods_of_a_batch_are_read_in_blocks(spark, monkeypatch):
    calls = []
    real = signals.periods
    monkeypatch.setattr(signals, "periods", lambda x, a, b: calls.append(len(x)) or real(x, a, b))
    waves = [np.cos(2 * np.pi * np.arange(n) / s) for n, s in ((400, 8), (300, 9), (400, 11))]
    profile = pd.Series([waves[0], None, waves[1], waves[2], np.zeros(400), waves[0]])
    high = pd.Series([60, 60, 60, 60, 60, None])
    got = kernels.signal_period.func(profile, pd.Series([4] * 6), high)
    assert sorted(calls) == [1, 3]
    expected = [real(w, 4, 60) for w in (waves[0], waves[1], waves[2], np.zeros(400))]
    assert np.allclose(got.loc[[0, 2, 3, 4]].to_numpy(), [[float(p[0]), float(k[0])] for p, k in expected])
    assert got.loc[[1, 5]].isna().all(None)


def test_rows_with_much_work_are_dealt_to_all_cores(spark):
    rows = spark.range(1000).coalesce(1)
    assert kernels.spread(rows).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["ruler_period", "backdrop_masks"])
def test_kernel_queries_are_dealt_to_all_cores(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()


def test_decoded_masks_are_not_broadcast_and_every_pixel_is_told(spark):
    mask = np.random.default_rng(3).random((7, 9)) < 0.5
    inst = spark.createDataFrame([(1, 5, (-1.0, -1.0, -1.0, -1.0), 2, 3, rasters.rle_encode(mask), 7, 9)], "image_id long, instance_id long, box struct<x1 double, y1 double, x2 double, y2 double>, win_x1 int, win_y1 int, mask_rle string, mask_h int, mask_w int")
    at = [(x, y) for x in range(0, 13) for y in range(0, 12)] + [(1 << 40, 4)]
    points = spark.createDataFrame([(1, i, float(x), float(y)) for i, (x, y) in enumerate(at)], "image_id long, p_id long, x double, y double")
    placed = kernels.points_in_masks(points, inst)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert not any("BroadcastHashJoin [image_id" in line for line in plan.splitlines())
    inside = {i for i, (x, y) in enumerate(at) if 2 <= x < 11 and 3 <= y < 10 and mask[y - 3, x - 2]}
    assert {r.p_id for r in placed.collect() if r.instance_id == 5} == inside


def test_photos_of_masks_are_put_together_from_bytes_of_rows(spark, tmp_path):
    """A photo's pixels are not written as digits first: only one row of it is."""
    spark.createDataFrame([(1, 7), (2, 50)], "p_partkey long, p_size long").write.parquet(str(tmp_path / "part.parquet"))
    df = QUERIES["specimen_metrics"](spark, str(tmp_path))
    assert re.findall(r"(?<=\W)unhex\(.*? AS (\w+)#", df._jdf.queryExecution().optimizedPlan().toString()) == ["row"]
    assert [(r.p_partkey, r.area_px, r.mean_r, r.mean_g, r.mean_b) for r in df.orderBy("p_partkey").collect()] == [(1, 60.0, 7.0, 1.0, 7.0), (2, 150.0, 50.0, 2.0, 7.0)]
