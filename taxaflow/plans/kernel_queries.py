"""Array-kernel queries: rectangular masks and periodic profiles derived from the parts table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions import kernels
from taxaflow.plans.registry import Tables, query

_H, _W = 60, 80


def _rectangles(t: Tables) -> DataFrame:
    """Masks of _H by _W pixels with a rectangle of p_size % 30 + 5 columns and p_partkey % 20 + 4 rows, as runs."""
    wide, tall = (F.col("p_size") % 30 + 5).cast("int"), (F.col("p_partkey") % 20 + 4).cast("int")
    x, y = (F.col("p_partkey") % 7 + 1).cast("int"), (F.col("p_size") % 9 + 1).cast("int")
    between: Column = F.flatten(F.array_repeat(F.array(tall, F.lit(_H) - tall), wide - 1))
    rest = F.lit(_H * _W) - (x + wide - 1) * _H - y - tall
    runs = F.concat(F.array(x * _H + y), between, F.array(tall, rest))
    rows = kernels.spread(t.part).select("p_partkey", "p_size", wide.alias("wide"), tall.alias("tall"), x.alias("x"), y.alias("y"), runs.alias("runs"))
    return rows.withColumn("code", kernels.mask_code("runs", F.lit(_H), F.lit(_W)))


@query("SELECT p_partkey, true AS same, CAST(2 * (p_size % 30 + 5) + 1 AS INT) AS n_runs FROM part")
def rle_roundtrip(t: Tables) -> DataFrame:
    back = _rectangles(t).withColumn("again", kernels.mask_runs("code"))
    return back.select("p_partkey", (F.col("again") == F.col("runs")).alias("same"), F.size("again").alias("n_runs"))


@query("""SELECT p_partkey, (a * b)::DOUBLE AS area_px, (greatest(a, b) - 1)::DOUBLE AS length_px, (least(a, b) - 1)::DOUBLE AS width_px,
(2 * (a - 1) + 2 * (b - 1))::DOUBLE AS perimeter_px, 1.0::DOUBLE AS largest_blob_frac FROM (SELECT p_partkey, p_size % 30 + 5 AS a, p_partkey % 20 + 4 AS b FROM part)""")
def mask_metrics(t: Tables) -> DataFrame:
    m = _rectangles(t).withColumn("m", kernels.mask_metrics("code", F.lit(_H), F.lit(_W)))
    return m.select("p_partkey", *[F.round(f"m.{c}", 6).alias(c) for c in ("area_px", "length_px", "width_px", "perimeter_px", "largest_blob_frac")])


#: The ellipse of a rectangle's outline: for points symmetric in both axes the constrained least squares have a closed form
#: in the means and variances of their squared coordinates.
@query("""WITH s AS (SELECT DISTINCT p_size % 30 + 5 AS a, p_partkey % 20 + 4 AS b FROM part), g AS (SELECT a, b, unnest(range(a)) AS i, b AS rows FROM s), o AS (SELECT a, b, i, unnest(range(rows)) AS j FROM g),
e AS (SELECT a, b, (i - (a - 1) / 2.0) ** 2 AS x, (j - (b - 1) / 2.0) ** 2 AS y FROM o WHERE i IN (0, a - 1) OR j IN (0, b - 1)),
f AS (SELECT a, b, avg(x) AS mx, avg(y) AS my, sqrt(var_pop(x) / var_pop(y)) AS q FROM e GROUP BY ALL), r AS (SELECT a, b, 2 * sqrt(mx + q * my) AS u, 2 * sqrt(my + mx / q) AS v FROM f),
p AS (SELECT p_partkey, p_size, p_size % 30 + 5 AS a, p_partkey % 20 + 4 AS b FROM part)
SELECT p_partkey, (a * b)::DOUBLE AS area_px, (2 * (a + b - 2))::DOUBLE AS perimeter_px, (greatest(a, b) - 1)::DOUBLE AS length_px, (least(a, b) - 1)::DOUBLE AS width_px, round(greatest(u, v), 6) AS ellipse_major_px,
round(least(u, v), 6) AS ellipse_minor_px, CASE WHEN a >= b THEN 0.0 ELSE 90.0 END::DOUBLE AS orientation_deg, (greatest(a, b) - 1)::DOUBLE AS core_length_px, (least(a, b) - 1)::DOUBLE AS core_width_px,
round(a * b / ((a - 1) * (b - 1)), 6) AS solidity, p_size::DOUBLE AS mean_r, (p_partkey % 256)::DOUBLE AS mean_g, 7.0::DOUBLE AS mean_b, 1.0::DOUBLE AS largest_blob_frac FROM p JOIN r USING (a, b)""")
def specimen_metrics(t: Tables) -> DataFrame:
    """All fourteen measures of a mask, with the colour of its pixels; everything around it is black."""
    byte = lambda c: F.lpad(F.hex(c.cast("long")), 2, "0")
    inside = F.concat(byte(F.col("p_size")), byte(F.col("p_partkey") % 256), F.lit("07"))
    strip = lambda n, what: F.repeat(what, n.cast("int"))
    black, after = F.lit("000000"), F.lit(_W) - F.col("x") - F.col("wide")
    row = F.unhex(F.concat(strip(F.col("x"), black), strip(F.col("wide"), inside), strip(after, black)))
    empty = F.lit(bytes(3 * _W))
    image = F.concat(*[F.when((F.col("y") <= i) & (F.col("y") + F.col("tall") > i), F.col("row")).otherwise(empty) for i in range(_H)])
    m = _rectangles(t).withColumn("row", row).withColumn("m", kernels.specimen_metrics("code", F.lit(_H), F.lit(_W), image))
    return m.select("p_partkey", *[F.round(f"m.{c}", 6).alias(c) for c in kernels.BODY.names])


@query()
def midline(t: Tables) -> DataFrame:
    return _rectangles(t).select("p_partkey", kernels.midline("code", F.lit(_H), F.lit(_W)).alias("midline_px"))


@query("""SELECT event_id, CASE WHEN p.p_partkey IS NOT NULL THEN p.p_partkey END AS hit FROM (SELECT event_id, event_id % (SELECT count(*) FROM part) + 1 AS image, (event_id % 50)::DOUBLE AS px, (event_id % 37)::DOUBLE AS py FROM events)
LEFT JOIN (SELECT p_partkey, p_partkey % 7 + 1 AS x, p_size % 9 + 1 AS y, p_size % 30 + 5 AS a, p_partkey % 20 + 4 AS b FROM part) p ON p.p_partkey = image AND px >= x AND px < x + a AND py >= y AND py < y + b""")
def point_in_mask(t: Tables) -> DataFrame:
    box = F.struct(*[F.lit(-1.0).alias(n) for n in ("x1", "y1", "x2", "y2")])
    inst = _rectangles(t).select(F.col("p_partkey").alias("image_id"), F.col("p_partkey").alias("instance_id"), F.lit(0).alias("win_x1"), F.lit(0).alias("win_y1"), F.col("code").alias("mask_rle"), F.lit(_H).alias("mask_h"), F.lit(_W).alias("mask_w"), box.alias("box"))
    e = F.col("event_id")
    counted = t.events.crossJoin(F.broadcast(t.part.agg(F.count("*").alias("n"))))  # one row
    points = counted.select(e.alias("p_id"), (e % F.col("n") + 1).alias("image_id"), (e % 50).cast("double").alias("x"), (e % 37).cast("double").alias("y"))
    return kernels.points_in_masks(points, inst).select(F.col("p_id").alias("event_id"), F.col("instance_id").alias("hit"))


#: Rectangles of parts in windows of images: eight parts an image, a window's place by the part.
_PLACED = """m AS (SELECT p_partkey, p_partkey // 8 AS image, p_partkey % 8 * 9 + p_partkey % 7 + 1 AS x1, p_size % 13 + p_size % 9 + 1 AS y1, p_size % 30 + 5 AS a, p_partkey % 20 + 4 AS b FROM part),
o AS (SELECT s.image, s.p_partkey AS small, l.p_partkey AS large, s.a * s.b AS area, l.a * l.b AS larger,
greatest(least(s.x1 + s.a, l.x1 + l.a) - greatest(s.x1, l.x1), 0) * greatest(least(s.y1 + s.b, l.y1 + l.b) - greatest(s.y1, l.y1), 0) AS shared
FROM m s JOIN m l ON s.image = l.image AND (l.a * l.b, -l.p_partkey) > (s.a * s.b, -s.p_partkey))"""


def _instances(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    placed = {"image_id": F.floor(k / 8), "instance_id": k, "win_x1": k % 8 * 9, "win_y1": F.col("y") - 1 + F.col("p_size") % 13 - F.col("p_size") % 9, "mask_h": F.lit(_H), "mask_w": F.lit(_W)}
    return _rectangles(t).withColumns(placed).withColumnRenamed("code", "mask_rle")


@query(f"""WITH {_PLACED} SELECT small, large, shared FROM o WHERE shared > 0""")
def mask_overlaps(t: Tables) -> DataFrame:
    """Pixels that each two masks of an image share, by their runs."""
    m = _instances(t).select("image_id", "instance_id", *kernels.MASK, (F.col("wide") * F.col("tall")).alias("area"))
    a, b = (m.withColumnsRenamed({c: f"{p}_{c}" for c in m.columns if c != "image_id"}) for p in "ab")
    bigger = (F.col("b_area") > F.col("a_area")) | ((F.col("b_area") == F.col("a_area")) & (F.col("b_instance_id") < F.col("a_instance_id")))
    met = a.join(b, "image_id").filter(bigger)
    shared = kernels.mask_overlap([f"a_{c}" for c in kernels.MASK], [f"b_{c}" for c in kernels.MASK])
    return met.select(F.col("a_instance_id").alias("small"), F.col("b_instance_id").alias("large"), shared.alias("shared")).filter("shared > 0")


@query(f"""WITH RECURSIVE {_PLACED}, r AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY a * b DESC, p_partkey) AS n FROM m),
k AS (SELECT image, 0 AS n, []::BIGINT[] AS kept FROM (SELECT DISTINCT image FROM m)
UNION ALL SELECT r.image, r.n, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.small = r.p_partkey AND list_contains(k.kept, o.large) AND o.shared > 0.5 * o.area) THEN k.kept ELSE list_append(k.kept, r.p_partkey) END
FROM k JOIN r ON r.image = k.image AND r.n = k.n + 1)
SELECT image AS image_id, unnest(kept) AS instance_id FROM k QUALIFY n = max(n) OVER (PARTITION BY image)""")
def duplicate_masks(t: Tables) -> DataFrame:
    """Instances that stay when masks inside larger ones go."""
    return kernels.without_duplicate_masks(_instances(t)).select("image_id", "instance_id")


@query("""SELECT p_partkey, greatest(least(x + a, 50) - greatest(x, 10), 0) * greatest(least(y + b, 40) - greatest(y, 6), 0) AS head_area_px
FROM (SELECT p_partkey, p_partkey % 7 + 1 AS x, p_size % 9 + 1 AS y, p_size % 30 + 5 AS a, p_partkey % 20 + 4 AS b FROM part)""")
def parts_in_mask(t: Tables) -> DataFrame:
    """A part's pixels inside its specimen's mask, which lies in a window of its own: the rectangle of 40 by 34 pixels at (10, 6)."""
    whole = F.concat(F.array(F.lit(0), F.lit(34 * 40)))
    own = {"mask_rle": kernels.mask_code(whole, F.lit(34), F.lit(40)), "win_x1": F.lit(10), "win_y1": F.lit(6), "mask_h": F.lit(34), "mask_w": F.lit(40)}
    part = {"pwin_x1": F.lit(0), "pwin_y1": F.lit(0), "parts_h": F.lit(_H), "parts_w": F.lit(_W)}
    rows = _rectangles(t).withColumnRenamed("code", "head_rle").withColumns(own | part)
    return kernels.parts_in_mask(rows, ["head"]).select("p_partkey", "head_area_px")


@query("""WITH k AS (SELECT p_partkey, p_partkey % 81 AS k FROM part), c AS (SELECT *, (CASE WHEN k > 0 THEN 60 ELSE 0 END + 2 * k + CASE WHEN k = 80 THEN 60 ELSE 0 END) / 280 AS covered FROM k)
SELECT p_partkey, round(covered, 9) AS covered, CASE WHEN covered <= 0.5 THEN NULL WHEN (80 - k) * 60 < 48 THEN 'backdrop_unfixed' ELSE 'inverted_backdrop' END AS fix,
(CASE WHEN covered <= 0.5 OR (80 - k) * 60 < 48 THEN k ELSE 80 - k END * 60)::BIGINT AS pixels FROM c""")
def backdrop_masks(t: Tables) -> DataFrame:
    """Masks of the first columns of a window: those that cover most of its outline are the backdrop, and are turned around."""
    k = (F.col("p_partkey") % 81).cast("int")
    masks = kernels.spread(t.part).select("p_partkey", kernels.mask_code(F.array(F.lit(0), k * _H, F.lit(_H * _W) - k * _H), F.lit(_H), F.lit(_W)).alias("code"))
    size = F.lit(_H), F.lit(_W)
    found = masks.select("p_partkey", kernels.border_coverage("code", *size).alias("covered"), kernels.specimen_mask("code", *size).alias("s"))
    return found.select("p_partkey", F.round("covered", 9).alias("covered"), "s.fix", kernels.mask_pixels("s.code").alias("pixels"))


@query("SELECT p_partkey, (p_size % 20 + 6)::DOUBLE AS period, true AS strong FROM part")
def ruler_period(t: Tables) -> DataFrame:
    step = F.col("p_size") % 20 + 6
    profile = F.transform(F.sequence(F.lit(0), F.lit(399)), lambda i: F.cos(2 * F.pi() * i / step))
    found = kernels.spread(t.part).select("p_partkey", kernels.signal_period(profile, F.lit(4), F.lit(60)).alias("p"))
    return found.select("p_partkey", F.round("p.period", 0).alias("period"), (F.col("p.strength") > 0.8).alias("strong"))
