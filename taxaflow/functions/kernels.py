"""Array kernels as Arrow functions over DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.functions import rasters, runs, signals, text
from taxaflow.operators import boxes

BODY = T.StructType([T.StructField(n, T.DoubleType()) for n in rasters.BODY_COLUMNS])
PARTS = T.StructType(
    [T.StructField(n, T.BooleanType()) for n in ("parts_ok", "parts_complete")]
    + [T.StructField(n, T.DoubleType()) for n in (*(f"{p}_area_px" for p in rasters.PARTS), "body_length_parts_px", *rasters.PART_COLUMNS)]
)
BAR = T.StructType([T.StructField(n, T.IntegerType()) for n in ("x1", "y1", "x2", "y2")])
BOARD = T.StructType([T.StructField("px_per_mm", T.DoubleType()), T.StructField("n_squares", T.IntegerType()), T.StructField("spread", T.DoubleType())])
BASE = T.StructType([T.StructField(n, T.DoubleType()) for n in ("elytra_midline_length_px", "elytra_base_width_px", "pronotum_base_width_px")])
#: Samples of the profiles that are transformed together.
SAMPLES = 1 << 17
RULER = T.StructType([T.StructField("px_per_mm", T.DoubleType()), T.StructField("confidence", T.DoubleType()), T.StructField("orientation", T.StringType()), T.StructField("n_ticks", T.IntegerType())])


def spread(df: DataFrame) -> DataFrame:
    """Rows of few bytes and much work for each, dealt to some tasks for each core, whatever the files are."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def _per_row(f: Callable, columns: Iterable[pd.Series], names: list[str]) -> pd.DataFrame:
    """f of each row, equal rows once; a row with a null gives nulls."""
    none, known, rows = dict.fromkeys(names), {}, []
    for values in zip(*columns, strict=True):
        if any(v is None or v is pd.NA or (np.isscalar(v) and pd.isna(v)) for v in values):
            rows.append(none)
        elif any(isinstance(v, np.ndarray) for v in values):
            rows.append(f(*values))
        else:
            if values not in known:
                known[values] = f(*values)
            rows.append(known[values])
    return pd.DataFrame(rows, columns=names)


@F.pandas_udf(BODY)
def mask_metrics(code: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Body metrics of run-length coded masks; null columns give nulls."""
    return _per_row(lambda c, h, w: rasters.body_metrics(rasters.rle_decode(c, int(h), int(w))), (code, height, width), BODY.names)


@F.pandas_udf(BODY)
def specimen_metrics(code: pd.Series, height: pd.Series, width: pd.Series, pixels: pd.Series) -> pd.DataFrame:
    """Body metrics with the mean colour; pixels: the window's RGB bytes, row by row. Null columns give nulls."""

    def one(c: str, h: int, w: int, p: bytes) -> dict:
        return rasters.body_metrics(rasters.rle_decode(c, int(h), int(w)), np.frombuffer(p, np.uint8).reshape(int(h), int(w), 3))

    return _per_row(one, (code, height, width, pixels), BODY.names)


@F.pandas_udf(T.DoubleType())
def midline(code: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    return _per_row(lambda c, h, w: {"x": rasters.midline_length(rasters.rle_decode(c, int(h), int(w)))}, (code, height, width), ["x"])["x"].astype("float64")


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def mask_runs(code: pd.Series) -> pd.Series:
    """Lengths of a coded mask's runs, zeros first."""
    return code.map(lambda c: None if c is None else rasters.rle_runs(c))


@F.pandas_udf(T.StructType([T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("first", T.ArrayType(T.IntegerType()))]))
def mask_columns(code: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Where a coded mask's runs end, and how many end at or before the start of each column and of the one after the last.

    A place is set if an odd number of runs end at or before it.
    """

    def one(c: str, h: int, w: int) -> dict:
        ends = np.cumsum(np.array(rasters.rle_runs(c), np.int64))
        return {"ends": ends, "first": np.searchsorted(ends, np.arange(int(w) + 1) * int(h), "right").astype(np.int32)}

    return _per_row(one, (code, height, width), ["ends", "first"])


@F.pandas_udf(T.StringType())
def mask_code(lengths: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """The code of a mask given by its runs, zeros first."""
    return pd.Series([None if r is None else _code_of_runs(np.asarray(r, np.int64), int(h) * int(w)) for r, h, w in zip(lengths, height, width, strict=True)], dtype=object)


def _code_of_runs(lengths: np.ndarray, size: int) -> str:
    if lengths.sum() != size:
        raise ValueError(f"the runs have {lengths.sum()} pixels, not {size}")
    return rasters.encode_runs(lengths.tolist()) if (lengths[1:] > 0).all() else runs.coded(runs.of_lengths(lengths), size)


@F.pandas_udf(BASE)
def base_widths(head: pd.Series, pronotum: pd.Series, elytra: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    def one(a: str, b: str, c: str, h: int, w: int) -> dict:
        return rasters.base_widths(*(rasters.rle_decode(x, int(h), int(w)) for x in (a, b, c)))

    return _per_row(one, (head, pronotum, elytra, height, width), BASE.names)


@F.pandas_udf(T.StructType([T.StructField("period", T.DoubleType()), T.StructField("strength", T.DoubleType())]))
def signal_period(profile: pd.Series, low: pd.Series, high: pd.Series) -> pd.DataFrame:
    """Period and strength of each profile; null columns give nulls. Profiles of one length and one choice of lags are read in blocks."""
    found = np.full((len(profile), 2), np.nan)
    rows = pd.DataFrame({"n": profile.map(len, na_action="ignore"), "low": low, "high": high}).dropna()
    for (n, a, b), at in rows.groupby(["n", "low", "high"]).indices.items():
        places, block = rows.index[at], max(1, SAMPLES // max(int(n), 1))
        for i in range(0, len(places), block):
            some = places[i : i + block]
            found[some] = np.stack(signals.periods(np.stack(profile[some].to_list()).astype(float), int(a), int(b)), 1)
    return pd.DataFrame(found, columns=["period", "strength"])


@F.pandas_udf(PARTS)
def part_metrics(labels: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Part measures of label maps given as bytes, row by row; null columns give nulls."""
    return _per_row(lambda p, h, w: rasters.part_metrics(np.frombuffer(p, np.uint8).reshape(int(h), int(w))), (labels, height, width), PARTS.names)


@F.pandas_udf(BAR)
def printed_bar(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Box of the printed bar of grey images given as bytes; nulls where there is none."""
    return _per_row(lambda p, h, w: signals.printed_bar(np.frombuffer(p, np.uint8).reshape(int(h), int(w))) or {}, (pixels, height, width), BAR.names)


@F.pandas_udf(BOARD)
def checkerboard_scale(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Scale of the checkerboard of grey images given as bytes."""
    return _per_row(lambda p, h, w: signals.checkerboard_scale(np.frombuffer(p, np.uint8).reshape(int(h), int(w))), (pixels, height, width), BOARD.names)


def printed_bar_scale(bar: F.Column, labels: F.Column) -> F.Column:
    """Pixels per millimetre of a bar (x1, x2) by the first of its labels, an array of texts read, that states a length."""
    lengths = F.filter(F.transform(labels, text.label_millimetres), lambda mm: mm.isNotNull())
    return (bar["x2"] - bar["x1"]) / F.try_element_at(lengths, F.lit(1))


@F.pandas_udf(RULER)
def ruler_scale(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Ruler scale of grey images given as bytes, row by row."""
    return _per_row(lambda p, h, w: signals.ruler_scale(np.frombuffer(p, np.uint8).reshape(int(h), int(w))), (pixels, height, width), RULER.names)


def _windowed(f: Callable, columns: Iterable[pd.Series]) -> list:
    """f of a code and a window, and of another code and its window, in each row; a row with a null gives None."""
    out = []
    for a, ax, ay, ah, aw, b, bx, by, bh, bw in zip(*columns, strict=True):
        row = (a, ax, ay, ah, aw, b, bx, by, bh, bw)
        none = any(v is None or v is pd.NA or v != v for v in row)
        out.append(None if none else f(a, runs.Window(int(ax), int(ay), int(ah), int(aw)), b, runs.Window(int(bx), int(by), int(bh), int(bw))))
    return out


@F.pandas_udf(T.LongType())
def _overlap(*columns: pd.Series) -> pd.Series:
    return pd.Series(_windowed(runs.overlap, columns), dtype="Int64")


@F.pandas_udf(T.StringType())
def _restricted(*columns: pd.Series) -> pd.Series:
    return pd.Series(_windowed(runs.restricted, columns), dtype=object)


MASK = ("mask_rle", "win_x1", "win_y1", "mask_h", "mask_w")


def mask_overlap(a: Sequence[F.Column | str], b: Sequence[F.Column | str]) -> F.Column:
    """Pixels that two masks share; each is given by its code and its window's x, y, height and width in the image."""
    return _overlap(*a, *b)


def mask_restricted(part: Sequence[F.Column | str], mask: Sequence[F.Column | str]) -> F.Column:
    """The code of a part's pixels inside another mask, in the part's own window."""
    return _restricted(*part, *mask)


@F.pandas_udf(T.LongType())
def mask_pixels(code: pd.Series) -> pd.Series:
    return code.map(lambda c: None if c is None else runs.intervals(c).pixels).astype("Int64")


@F.pandas_udf(BAR)
def mask_extent(code: pd.Series, height: pd.Series) -> pd.DataFrame:
    """First and last column and row of a mask; nulls where it has no pixels."""
    return _per_row(lambda c, h: dict(zip(BAR.names, runs.extent(c, int(h)) or [None] * 4, strict=True)), (code, height), BAR.names)


@F.pandas_udf(T.StructType([T.StructField("code", T.StringType()), T.StructField("pixels", T.LongType())]))
def mask_combined(how: pd.Series, a: pd.Series, b: pd.Series, size: pd.Series) -> pd.DataFrame:
    """and, or, or minus of two masks of one window of `size` pixels: the code, and how many pixels it has."""

    def one(how: str, a: str, b: str, size: int) -> dict:
        x, y, n = runs.intervals(a), runs.intervals(b), int(size)
        found = {"and": lambda: runs.both(x, y), "or": lambda: runs.either(x, y, n), "minus": lambda: runs.minus(x, y, n)}[how]()
        return {"code": runs.coded(found, n), "pixels": found.pixels}

    return _per_row(one, (how, a, b, size), ["code", "pixels"]).astype({"pixels": "Int64"})


def parts_in_mask(df: DataFrame, parts: Sequence[str], part_window: Sequence[str] = ("pwin_x1", "pwin_y1", "parts_h", "parts_w")) -> DataFrame:
    """Each part's code (<part>_rle) restricted to the row's own mask (MASK), in the parts' window, and <part>_area_px.

    On a crowded tray a part's window also shows neighbours; what lies outside the specimen's mask goes. A row with a
    null among a part's code, the windows and the mask has nulls for this part.
    """
    kept = {f"{p}_rle": mask_restricted([f"{p}_rle", *part_window], MASK) for p in parts}
    return df.withColumns(kept).withColumns({f"{p}_area_px": mask_pixels(f"{p}_rle") for p in parts})


@F.pandas_udf(T.DoubleType())
def border_coverage(code: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """Part of a window's outline that a coded mask covers, from its runs."""
    return _per_row(lambda c, h, w: {"x": runs.border_coverage(c, int(h), int(w))}, (code, height, width), ["x"])["x"].astype("float64")


@F.pandas_udf(T.StructType([T.StructField("code", T.StringType()), T.StructField("fix", T.StringType())]))
def specimen_mask(code: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """A mask, or the specimen that a mask of the backdrop leaves, and what was done: see rasters.specimen_of.

    Only masks that cover more than half of their window's outline are decoded.
    """

    def one(c: str, h: int, w: int) -> dict:
        if runs.border_coverage(c, int(h), int(w)) <= 0.5:
            return {"code": c, "fix": None}
        mask, fix = rasters.specimen_of(rasters.rle_decode(c, int(h), int(w)))
        return {"code": rasters.rle_encode(mask), "fix": fix}

    return _per_row(one, (code, height, width), ["code", "fix"])


BOX = T.StructType([T.StructField(n, T.DoubleType()) for n in BAR.names])


@F.pandas_udf(BOX)
def backdrop_box(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Box of the largest thing that differs from the border's colour in RGB images given as bytes; nulls where there is none."""

    def one(p: bytes, h: int, w: int) -> dict:
        found = rasters.backdrop_difference_box(np.frombuffer(p, np.uint8).reshape(int(h), int(w), 3))
        return dict(zip(BOX.names, found or [None] * 4, strict=True))

    return _per_row(one, (pixels, height, width), BOX.names)


@F.pandas_udf(T.StructType([*BOX.fields, T.StructField("source", T.StringType())]))
def crop_prompt(labels: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """The box that a crop's part labels (bytes, row by row) give a segmenter, and where it is from.

    The extent of the largest labelled blob ("parts") counts only if the labels show a whole specimen: each part of the
    trunk has 0.2 % of the crop and the blob 1 %. Else it is the crop without its outermost pixels ("frame").
    """

    def one(p: bytes, h: int, w: int) -> dict:
        lab = np.frombuffer(p, np.uint8).reshape(int(h), int(w))
        trunk = min(np.count_nonzero(lab == rasters.PARTS[name]) for name in rasters.NEEDED)
        blob = rasters.largest_blob(lab > 0, fill=False)
        box, source = (1, 1, lab.shape[1] - 1, lab.shape[0] - 1), "frame"
        if trunk >= 0.002 * lab.size and np.count_nonzero(blob) >= 0.01 * lab.size:
            ys, xs = np.nonzero(blob)
            box, source = (xs.min(), ys.min(), xs.max() + 1, ys.max() + 1), "parts"
        return dict(zip(BOX.names, map(float, box), strict=True)) | {"source": source}

    return _per_row(one, (labels, height, width), [*BOX.names, "source"])


READING = T.StructType([
    T.StructField("px_per_mm", T.DoubleType()), T.StructField("strength", T.DoubleType()), T.StructField("n", T.IntegerType()), T.StructField("spread", T.DoubleType()),
    T.StructField("orientation", T.StringType()), T.StructField("bar", BAR),
])


def _reading(how: str, image: np.ndarray, least: int, x1: float, y1: float, x2: float, y2: float) -> dict:
    """A region (in parts of the sides) of an image read in one of the ways: checkerboard, ruler or bar."""
    h, w = image.shape
    part = image[int(y1 * h) : int(y2 * h), int(x1 * w) : int(x2 * w)]
    if how == "checkerboard":
        r = signals.checkerboard_scale(part)
        return {"px_per_mm": r["px_per_mm"], "strength": None if r["spread"] is None else 1 - r["spread"], "n": r["n_squares"], "spread": r["spread"]}
    if how == "ruler":
        r = signals.ruler_scale(part, int(least))
        return {"px_per_mm": r["px_per_mm"], "strength": r["confidence"], "n": r["n_ticks"], "orientation": r["orientation"]}
    if how == "bar":
        bar = signals.printed_bar(part)
        return {"bar": bar and {n: int(bar[n]) for n in BAR.names}}
    raise ValueError(f"no way to read a scale: {how}")


@F.pandas_udf(READING)
def scale_reading(how: pd.Series, pixels: pd.Series, height: pd.Series, width: pd.Series, least: pd.Series, x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.DataFrame:
    """The scale that a grey image (bytes, row by row) shows, read in the way that the row says; null columns give nulls.

    One function has all ways, as Spark would run a function of each branch of a CASE on all rows.
    """

    def one(how: str, p: bytes, h: int, w: int, least: int, *region: float) -> dict:
        return dict.fromkeys(READING.names) | _reading(how, np.frombuffer(p, np.uint8).reshape(int(h), int(w)), least, *region)

    found = _per_row(one, (how, pixels, height, width, least, x1, y1, x2, y2), READING.names)
    bars = pd.DataFrame([b if isinstance(b, dict) else dict.fromkeys(BAR.names) for b in found["bar"]], columns=BAR.names)
    found["bar"] = bars.to_dict("records")
    return found


def without_duplicate_masks(df: DataFrame, image: str = "image_id", most: float = 0.5) -> DataFrame:
    """Rows (instance_id, win_x1, win_y1, mask_rle, mask_h, mask_w) of each image without masks inside larger ones.

    From the largest mask on, a mask goes if more than `most` of its pixels lie in one that stays; of equally large ones
    the smaller instance_id comes first. Masks without pixels stay. Only masks whose extents overlap are compared, by
    their runs; then an image's ids that are in doubt are brought together. instance_id is unique.
    """
    code, x, y, height, width = (F.col(c) for c in MASK)
    sized = df.select(image, F.col("instance_id").alias("id"), *MASK, mask_pixels("mask_rle").alias("pixels"), mask_extent("mask_rle", "mask_h").alias("e"))
    corners = {"x1": x + F.col("e.x1"), "y1": y + F.col("e.y1"), "x2": x + F.col("e.x2") + 1, "y2": y + F.col("e.y2") + 1}
    placed = sized.select(image, "id", F.struct(*[c.cast("double").alias(n) for n, c in corners.items()], "pixels", code, x, y, height, width).alias("box"))
    pairs = boxes.overlaps(placed, placed, image)
    a, b = F.col("l_box"), F.col("r_box")
    larger = (a["pixels"] > b["pixels"]) | ((a["pixels"] == b["pixels"]) & (F.col("l_id") < F.col("r_id")))
    shared = pairs.filter(larger).withColumn("shared", mask_overlap([b[c] for c in MASK], [a[c] for c in MASK]))
    inside = shared.filter(F.col("shared") > most * b["pixels"]).select(image, "l_id", "r_id", (-b["pixels"]).alias("rank"))
    return df.join(boxes.eliminated(inside, image, "rank").select(F.col("id").alias("instance_id")), "instance_id", "left_anti")


def points_in_masks(points: DataFrame, instances: DataFrame, image: str = "image_id") -> DataFrame:
    """points (image, p_id, x, y) with instance_id: the first instance whose mask holds the point, else the smallest box.

    instances: (instance_id, box, win_x1, win_y1, mask_rle, mask_h, mask_w). A point's pixel in a
    mask's window is rounded half to even; a point without coordinates, or nowhere, has a null instance_id.
    """
    cols = ["instance_id", "box", "win_x1", "win_y1", "mask_h", "mask_w"]
    held = instances.select(image, *cols, mask_columns("mask_rle", "mask_h", "mask_w").alias("_m"))  # decoded once, not for each point
    # no broadcast: the size of decoded runs is not what the size of the files lets expect
    near = points.filter("x IS NOT NULL AND y IS NOT NULL").select(image, "p_id", "x", "y").join(held.hint("merge"), image)
    dx, dy = F.rint(F.col("x") - F.col("win_x1")).cast("long"), F.rint(F.col("y") - F.col("win_y1")).cast("long")
    window = (dx >= 0) & (dy >= 0) & (dx < F.col("mask_w")) & (dy < F.col("mask_h"))
    in_box = (F.col("x") >= F.col("box.x1")) & (F.col("x") <= F.col("box.x2")) & (F.col("y") >= F.col("box.y1")) & (F.col("y") <= F.col("box.y2"))
    # the pixel's place in column-major order falls into a run of ones if it is in an odd run; only its column's runs are looked through
    place = dx * F.col("mask_h") + dy
    first, end = (F.get("_m.first", F.when(window, dx).cast("int") + i) for i in (0, 1))
    ended = first + F.size(F.filter(F.when(window, F.slice("_m.ends", first + 1, end - first)), lambda e: e <= place))
    hit = F.coalesce(window & (ended % 2 == 1), F.lit(False))
    size = (F.col("box.x2") - F.col("box.x1")) * (F.col("box.y2") - F.col("box.y1"))
    ranked = near.filter(window | in_box).withColumn("_hit", hit).filter(F.col("_hit") | in_box)
    order = F.struct((~F.col("_hit")).alias("a"), F.when(F.col("_hit"), 0.0).otherwise(size).alias("b"), F.col("instance_id").alias("c"))
    best = ranked.groupBy("p_id").agg(F.min_by("instance_id", order).alias("instance_id"))
    return points.join(best, "p_id", "left")


def per_image(df: DataFrame, f: Callable[[dict], dict], schema: str, key: str = "image_id") -> DataFrame:
    """f of each row as a dict, with the row's key and a status: "ok" or "error:<Type>". An error ends no other row."""
    names = [s.split()[0] for s in schema.split(",")]
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                try:
                    found = {n: v for n, v in f(row).items() if n in names} | {"status": "ok"}
                except Exception as error:  # noqa: BLE001  a row's failure is its result
                    found = {"status": f"error:{type(error).__name__}"}
                rows.append({key: row[key]} | found)
            yield pd.DataFrame(rows, columns=[key, *names, "status"])

    return df.mapInPandas(run, f"{key} {kind}, {schema}, status string")
