"""Axis-aligned boxes: overlap, suppression, matching, tiles, windows, containment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOX = ("x1", "y1", "x2", "y2")


def area(b: str | Column) -> Column:
    c = (lambda n: F.col(f"{b}.{n}")) if isinstance(b, str) else (lambda n: b[n])
    return F.greatest(c("x2") - c("x1"), F.lit(0.0)) * F.greatest(c("y2") - c("y1"), F.lit(0.0))


def intersection(a: Column, b: Column) -> Column:
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two box structs; an empty union counts as 1e-9."""
    inter = intersection(a, b)
    return inter / F.greatest(area(a) + area(b) - inter, F.lit(1e-9))


def _placed(df: DataFrame, corners: tuple[Column, Column, Column, Column]) -> DataFrame:
    """Rows with an area, and _level: the power of two that the longer side does not exceed, 0 at least.

    Null, infinite, not-a-number and crossing coordinates have no area.
    """
    x1, y1, x2, y2 = corners
    finite = F.lit(True)
    for c in corners:
        finite = finite & (F.abs(c) < 1e15)
    level = F.greatest(F.ceil(F.log2(F.greatest(x2 - x1, y2 - y1))), F.lit(0)).cast("int")
    return df.filter(finite & (x2 > x1) & (y2 > y1)).withColumn("_level", level)


def _cell(c: Column, level: Column) -> Column:
    return F.floor(c / F.pow(F.lit(2.0), level)).cast("long")


def _cells(corners: tuple[Column, Column, Column, Column], level: Column) -> Column:
    """The cells of a level's grid that a box touches, as structs (cx, cy); at its own level or above, four at most."""
    x1, y1, x2, y2 = corners
    ys = F.sequence(_cell(y1, level), _cell(y2, level))
    return F.flatten(F.transform(F.sequence(_cell(x1, level), _cell(x2, level)), lambda cx: F.transform(ys, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def _in_cells(df: DataFrame, box: str) -> DataFrame:
    """A row for each cell (_cx, _cy) that a box touches at the level _at."""
    each = df.withColumn("_cell", F.explode(_cells(_corners(box), F.col("_at"))))
    return each.withColumns({"_cx": F.col("_cell.cx"), "_cy": F.col("_cell.cy")}).drop("_cell")


def _corners(box: str) -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{box}.{n}").cast("double") for n in BOX)


def _levels(df: DataFrame) -> DataFrame:
    """One row: the levels that df's rows have, some fifty at most."""
    return df.agg(F.collect_set("_level").alias("_levels"))


def _dealt(df: DataFrame, box: str, levels: DataFrame) -> DataFrame:
    """A row for each cell that a box touches at its own level and at those of levels above it: _at, _home, _cx and _cy.

    A box is at home at its own level and a visitor above it.
    """
    there = df.crossJoin(F.broadcast(levels))
    own = F.col("_level")
    each = there.withColumn("_at", F.explode(F.array_union(F.array(own), F.filter("_levels", lambda v: v > own)))).drop("_levels")
    return _in_cells(each.withColumn("_home", F.col("_at") == own), box)


def overlaps(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """(on, l_id, r_id, l_box, r_box) of all boxes (id, box) that share an image and overlap.

    Boxes meet in cells of grids, one for each power of two, at the level of the larger of the two: each is dealt to the
    cells that it touches at its own level and at the other side's levels above, four cells a level at most. So an image
    of any number of boxes is many keys, and candidates follow the overlaps, whatever mix of sizes there is. A pair that
    meets in several cells counts in the one that has the intersection's lower corner. Boxes without an area, or with
    coordinates that are null or not finite, overlap nothing; rows of a null image do not meet.
    """
    a = _placed(left.select(on, F.col("id").alias("l_id"), F.col("box").alias("l_box")), _corners("l_box"))
    b = _placed(right.select(on, F.col("id").alias("r_id"), F.col("box").alias("r_box")), _corners("r_box"))
    a, b = _dealt(a, "l_box", _levels(b)), _dealt(b, "r_box", _levels(a))
    # side 0: a box of the left at home meets all of the right; side 1: a visitor of the left meets those at home
    a = a.withColumn("_side", F.when(F.col("_home"), 0).otherwise(1)).drop("_level", "_home")
    b = b.withColumn("_side", F.explode(F.when(F.col("_home"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_level", "_home")
    met = a.join(b, [on, "_at", "_cx", "_cy", "_side"])
    (ax1, ay1, ax2, ay2), (bx1, by1, bx2, by2) = _corners("l_box"), _corners("r_box")
    x, y = F.greatest(ax1, bx1), F.greatest(ay1, by1)
    here = (F.col("_cx") == _cell(x, F.col("_at"))) & (F.col("_cy") == _cell(y, F.col("_at")))
    return met.filter((F.least(ax2, bx2) > x) & (F.least(ay2, by2) > y) & here).select(on, "l_id", "r_id", "l_box", "r_box")


def iou_pairs(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """(on, l_id, r_id, iou) of all boxes (id, box) that share an image and overlap; see overlaps()."""
    return overlaps(left, right, on).select(on, "l_id", "r_id", iou(F.col("l_box"), F.col("r_box")).alias("iou"))


def _in_doubt(pairs: DataFrame, group: str, rank: str) -> DataFrame:
    """(group, doubt): the ids that something would take away, in the order of their ranks, each with what would: by."""
    threatened = pairs.groupBy(group, "r_id").agg(F.collect_set("l_id").alias("by"), F.min(rank).alias("rank"))
    return threatened.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("rank", F.col("r_id").alias("id"), "by"))).alias("doubt"))


def _gone(doubt: Column, before: Column, by: Callable[[Column], Column]) -> Column:
    """Ids that greedy elimination takes away, after those of `before`: in order, one goes if not all of by(it) have gone."""
    stays = lambda gone, x: F.array_contains(gone, x["id"]) | (F.size(F.array_except(by(x), gone)) == 0)
    return F.aggregate(doubt, before, lambda gone, x: F.when(stays(gone, x), gone).otherwise(F.array_append(gone, x["id"])))


def eliminated(pairs: DataFrame, group: str, rank: str) -> DataFrame:
    """(group, id): what greedy elimination takes away. pairs (group, l_id, r_id, rank): l_id stays before r_id and would take it.

    rank is r_id's place in the order, smaller first (ties: the smaller id). What nothing would take away stays; of the
    others a group's ids are brought together in order, and one goes if not all that would take it have gone.
    """
    none = F.array().cast(f"array<{pairs.schema['r_id'].dataType.simpleString()}>")
    return _in_doubt(pairs, group, rank).select(group, F.explode(_gone(F.col("doubt"), none, lambda x: x["by"])).alias("id"))


def _better_covers(most_iou: float, most_inside: float) -> Column:
    """Whether the left box of a pair of overlaps() comes first and would suppress the right one; boxes have their score."""
    a, b = F.col("l_box"), F.col("r_box")
    better = (a["score"] > b["score"]) | ((a["score"] == b["score"]) & (F.col("l_id") < F.col("r_id")))
    return better & ((iou(a, b) > most_iou) | (intersection(a, b) > most_inside * F.greatest(area(b), F.lit(1e-9))))


def suppressed(df: DataFrame, group: str, most_iou: float = 0.5, most_inside: float = 0.8) -> DataFrame:
    """(group, kept): boxes left by greedy suppression, the best score first.

    A box goes if its overlap with a kept one is above most_iou, or above most_inside of its own area. Input rows
    are (group, id, score, box); ties of scores go to the smaller id, and ids are unique in a group.

    Which better boxes would suppress a box is found by the grid join of overlaps(), and only those that some would are
    brought together; see eliminated().
    """
    of = F.struct(F.col(group)).alias("_group")  # a null group is a group
    ranked = df.select(of, "id", F.struct(*[F.col(f"box.{n}").alias(n) for n in BOX], "score").alias("box"))
    covering = overlaps(ranked, ranked, "_group").filter(_better_covers(most_iou, most_inside))
    gone = eliminated(covering.select("_group", "l_id", "r_id", (-F.col("r_box.score")).alias("rank")), "_group", "rank")
    left = df.withColumn("_group", of).join(gone, ["_group", "id"], "left_anti")
    kept = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("rank"), "id", "score", "box")))
    return left.groupBy(group).agg(F.transform(kept, lambda k: F.struct(k["id"].alias("id"), k["score"].alias("score"), k["box"].alias("box"))).alias("kept"))


def matched(detections: DataFrame, truth: DataFrame, on: str, least: float = 0.5) -> DataFrame:
    """(on, tp): truth boxes that some detection's best overlap, of least or more, falls on.

    A detection only claims the truth box that it overlaps most (ties: the smaller id), so counting distinct
    claimed boxes is the greedy one-to-one match, in any order. Images without overlaps are absent.
    """
    best = iou_pairs(detections, truth, on).groupBy(on, "l_id").agg(F.min(F.struct((-F.col("iou")).alias("rank"), "r_id")).alias("_best"))
    claimed = best.filter(F.col("_best.rank") <= -least).select(on, "_best.r_id").distinct()
    return claimed.groupBy(on).agg(F.count("*").alias("tp"))


def tiles(df: DataFrame, width: str, height: str, tile: int, overlap: float = 0.25) -> DataFrame:
    """A row for each tile of each image: x1, y1, x2, y2. An image not larger than a tile is one tile.

    Tiles start every tile * (1 - overlap) pixels while they fit, and once more at the far edge.
    """
    step = int(tile * (1 - overlap))

    def starts(size: Column) -> Column:
        last = F.greatest(size - tile, F.lit(0))
        regular = F.filter(F.sequence(F.lit(0), last, F.lit(step)), lambda s: s < last)
        return F.concat(regular, F.array(last))

    w, h = F.col(width).cast("int"), F.col(height).cast("int")
    whole = F.greatest(w, h) <= tile
    xs = F.when(whole, F.array(F.lit(0))).otherwise(starts(w))
    ys = F.when(whole, F.array(F.lit(0))).otherwise(starts(h))
    rows = df.withColumn("x1", F.explode(xs)).withColumn("y1", F.explode(ys))
    return rows.withColumns({"x2": F.least(F.col("x1") + F.when(whole, w).otherwise(F.lit(tile)), w), "y2": F.least(F.col("y1") + F.when(whole, h).otherwise(F.lit(tile)), h)})


def crop_window(box: Column, width: Column, height: Column, pad: float, min_side: float = 0) -> Column:
    """The box grown by pad of its sides, to min_side at least, rounded outwards and kept inside the image."""
    bw, bh = box["x2"] - box["x1"], box["y2"] - box["y1"]
    gx = F.greatest(pad * bw, (min_side - bw) / 2, F.lit(0.0))
    gy = F.greatest(pad * bh, (min_side - bh) / 2, F.lit(0.0))
    low = lambda c: F.greatest(F.floor(c), F.lit(0)).cast("int")
    return F.struct(
        low(box["x1"] - gx).alias("x1"), low(box["y1"] - gy).alias("y1"),
        F.least(F.ceil(box["x2"] + gx), width).cast("int").alias("x2"), F.least(F.ceil(box["y2"] + gy), height).cast("int").alias("y2"),
    )


def within_tile(df: DataFrame, box: str, tile: str, width: str, height: str, margin: float = 3) -> DataFrame:
    """Boxes of tiles in image coordinates, without those that an inner tile edge cuts (within margin of it)."""
    b, t = F.col(box), F.col(tile)
    tw, th = t["x2"] - t["x1"], t["y2"] - t["y1"]
    cut = (
        ((b["x1"] <= margin) & (t["x1"] > 0)) | ((b["y1"] <= margin) & (t["y1"] > 0))
        | ((b["x2"] >= tw - margin) & (t["x2"] < F.col(width))) | ((b["y2"] >= th - margin) & (t["y2"] < F.col(height)))
    )
    moved = F.struct(*[(b[n] + t[n[0] + "1"]).alias(n) for n in BOX])
    return df.filter(~F.coalesce(cut, F.lit(False))).withColumn(box, moved)


def sized(df: DataFrame, box: str, width: str, height: str, least: float = 0.0, most: float = 1.0, lowest_centre: float | None = None) -> DataFrame:
    """Boxes whose part of the image area is above least and below most, and whose centre is not too low."""
    part = area(F.col(box)) / (F.col(width) * F.col(height))
    kept = (part > least) & (part < most)
    if lowest_centre is not None:
        kept = kept & ((F.col(box)["y1"] + F.col(box)["y2"]) / 2 < lowest_centre * F.col(height))
    return df.filter(kept)


def arbitrated(whole: DataFrame, tiled: DataFrame, on: str, gain: float = 1.25, margin: int = 3) -> DataFrame:
    """(on, source): "tiles" where tiles found at least gain times as many as the whole image and margin more."""
    a = whole.groupBy(on).agg(F.count("*").alias("n_whole"))
    b = tiled.groupBy(on).agg(F.count("*").alias("n_tiled"))
    n = a.join(b, on, "full").na.fill(0, ["n_whole", "n_tiled"])
    return n.withColumn("source", F.when(F.col("n_tiled") >= gain * F.col("n_whole") + margin, "tiles").otherwise("whole"))


def tray_boxes(whole: DataFrame, tiled: DataFrame, sizes: DataFrame, on: str, most: float = 0.2, gain: float = 1.25, margin: int = 3) -> DataFrame:
    """(on, source, id, score, box): the boxes of each image of sizes (on, width, height).

    Boxes of `most` of their image or more go, and each detection is cleaned by suppression. Where at least gain times as
    many boxes of tiles are left as of the whole image and margin more, both are taken together ("tiles") and cleaned
    again, so that a specimen cut by a tile's border gives way to the whole one; elsewhere the whole image's stay ("whole").

    Pairs that suppress are found once, for both detections together; then an image's ids in doubt pass three eliminations
    in one row. Ids are unique in each detection, as long numbers or texts; boxes of images without a size do not count.
    """
    every = whole.select(on, "id", "score", "box", F.lit(0).alias("_tile")).unionByName(tiled.select(on, "id", "score", "box", F.lit(1).alias("_tile")))
    part = area(F.col("box")) < most * F.col("width") * F.col("height")
    rows = every.join(sizes.select(on, "width", "height"), on).filter(part).withColumn("_id", F.struct("_tile", "id")).drop("width", "height")
    ranked = rows.select(on, F.col("_id").alias("id"), F.struct(*[F.col(f"box.{n}").alias(n) for n in BOX], "score").alias("box"))
    # of equal scores a whole image's box comes before a tile's, then the smaller id
    pairs = overlaps(ranked, ranked, on).filter(_better_covers(0.5, 0.8)).select(on, "l_id", "r_id", (-F.col("r_box.score")).alias("rank"))
    doubt = _in_doubt(pairs, on, "rank")
    none = F.array().cast(f"array<{rows.schema['_id'].dataType.simpleString()}>")
    alone = doubt.withColumn("_alone", _gone(F.col("doubt"), none, lambda x: F.filter(x["by"], lambda b: b["_tile"] == x["id"]["_tile"])))
    lost = lambda tile: F.coalesce(F.size(F.filter("_alone", lambda i: i["_tile"] == tile)), F.lit(0))
    counts = rows.groupBy(on).agg(*[F.count_if(F.col("_tile") == k).alias(f"_n{k}") for k in (0, 1)])
    known = counts.join(alone, on, "left")
    crowded = F.col("_n1") - lost(1) >= gain * (F.col("_n0") - lost(0)) + margin
    together = F.when(crowded, _gone(F.col("doubt"), F.col("_alone"), lambda x: x["by"])).otherwise(F.col("_alone"))
    chosen = known.select(on, F.when(crowded, "tiles").otherwise("whole").alias("source"), F.coalesce(together, none).alias("_out"))
    gone = chosen.select(on, F.explode("_out").alias("_id"))
    left = rows.join(gone, [on, "_id"], "left_anti").join(chosen.select(on, "source"), on)
    return left.filter((F.col("source") == "tiles") | (F.col("_tile") == 0)).select(on, "source", "id", "score", "box")


def best_box(df: DataFrame, on: str, width: str, height: str, weight: float = 0.1) -> DataFrame:
    """The box of each image with the largest score + weight * part of the image; ties: the smaller id."""
    value = F.col("score") + weight * area(F.col("box")) / (F.col(width) * F.col(height))
    return df.groupBy(on).agg(F.max_by(F.struct("id", "score", "box"), F.struct(value, -F.col("id"))).alias("best"))


def smallest_containing(points: DataFrame, boxes: DataFrame, on: str) -> DataFrame:
    """points (on, p_id, x, y) with box_id: the smallest box (on, id, box) that contains the point; ties: the smaller id.

    A box is dealt to the cells that it touches at its own level (see iou_pairs), and a point to its one cell at each
    level that boxes have, so each pair meets once. Points without finite coordinates or outside all boxes keep a null
    box_id; boxes without an area contain nothing.
    """
    b = boxes.select(on, F.col("id").alias("box_id"), F.col("box").alias("_b"), area(F.col("box")).alias("_area"))
    b = _placed(b, _corners("_b"))
    at = _in_cells(b.withColumnRenamed("_level", "_at"), "_b")
    x, y = F.col("x"), F.col("y")
    p = points.select(on, "p_id", "x", "y").filter((F.abs(x) < 1e15) & (F.abs(y) < 1e15)).crossJoin(F.broadcast(_levels(b)))
    p = p.withColumn("_at", F.explode("_levels")).withColumns({"_cx": _cell(x, F.col("_at")), "_cy": _cell(y, F.col("_at"))}).drop("_levels")
    inside = (x >= F.col("_b.x1")) & (x <= F.col("_b.x2")) & (y >= F.col("_b.y1")) & (y <= F.col("_b.y2"))
    found = p.join(at, [on, "_at", "_cx", "_cy"]).filter(inside).groupBy("p_id").agg(F.min(F.struct("_area", "box_id")).alias("_m"))
    return points.join(found.select("p_id", F.col("_m.box_id").alias("box_id")), "p_id", "left")


def touches_edge(extent: Column, width: Column, height: Column, near: Sequence[int] = (1, 2)) -> Column:
    """Whether an extent is within near[0] pixels of the left or top, or near[1] of the right or bottom."""
    return (extent["x1"] <= near[0]) | (extent["y1"] <= near[0]) | (extent["x2"] >= width - near[1]) | (extent["y2"] >= height - near[1])
