"""Text, box, vector and array-kernel queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.functions import text
from taxaflow.operators import boxes, vectors
from taxaflow.plans.registry import Tables, query


@query("""SELECT c_custkey, c_name AS sample, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) END AS hash, CASE WHEN c_custkey % 3 = 0 THEN 'b:' || c_mktsegment ELSE c_mktsegment END AS barcode FROM customer""")
def parse_label_pairs(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    source = F.concat(
        F.lit("sample ID: "), F.col("c_name"), F.lit("; other: x | hash:"), F.when(k % 2 == 0, k.cast("string")).otherwise(F.lit("  ")),
        F.lit(" ;barcode: first; barcode :"), F.when(k % 3 == 0, F.lit("b:")).otherwise(F.lit("")), F.col("c_mktsegment"),
    )
    parsed = text.labelled_pairs(source, {"sample ID": "sample", "hash": "hash", "barcode": "barcode"})
    return t.customer.select("c_custkey", parsed.alias("p")).select("c_custkey", "p.*")


@query(r"""SELECT c_custkey, nullif(regexp_extract(c_name, '^([A-Za-z]+)#', 1), '') AS kind, nullif(regexp_extract(c_name, '#0*([1-9][0-9]*)$', 1), '') AS number,
regexp_matches(c_name, '^Customer#\d{9}$') AS is_full, nullif(regexp_extract(c_name, '^(Supplier)#', 1), '') AS none FROM customer""")
def regex_keys(t: Tables) -> DataFrame:
    c = F.col("c_name")
    return t.customer.select(
        "c_custkey", text.extract(c, "^([A-Za-z]+)#").alias("kind"), text.extract(c, "#0*([1-9][0-9]*)$").alias("number"),
        F.rlike(c, F.lit(r"^Customer#\d{9}$")).alias("is_full"), text.extract(c, "^(Supplier)#").alias("none"),
    )


@query(r"""SELECT page_id, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) AS file, regexp_replace(regexp_replace(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1), '(.)\.[^.]*$', '\1'), '_(lg|tn)$', '') AS stem FROM pages""")
def url_stem(t: Tables) -> DataFrame:
    file = text.url_file(F.col("url"))
    return t.pages.select("page_id", file.alias("file"), text.without_size(text.stem(file)).alias("stem"))


@query("""SELECT doc_id, CASE WHEN starts_with(source, 'src1') THEN 'bycatch' WHEN regexp_matches(source, '^src[23]$') THEN 'tray_ethanol' WHEN source IN ('src5', 'src7') THEN 'pinned' ELSE 'individual' END AS kind,
CASE WHEN contains(lower(lang), 'd') THEN 'd' WHEN contains(lower(lang), 'f') THEN 'f' WHEN contains(lower(lang), 'e') THEN 'e' END AS first_word FROM documents""")
def rule_cascade_classify(t: Tables) -> DataFrame:
    s = F.col("source")
    rules = [(F.startswith(s, F.lit("src1")), "bycatch"), (F.rlike(s, F.lit("^src[23]$")), "tray_ethanol"), (s.isin("src5", "src7"), "pinned")]
    return t.documents.select("doc_id", text.cascade(rules, "individual").alias("kind"), text.first_contained(F.col("lang"), ["d", "f", "e"]).alias("first_word"))


@query(r"""SELECT page_id, nullif(trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<li[^>]*>', ' - ', 'g'), '<[^>]+>', ' ', 'g'),
'&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')), '') AS plain FROM pages""")
def html_to_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.plain_text(F.col("html")).alias("plain"))


@query("""SELECT doc_id, CAST(len(list_filter(string_split(text, '|'), lambda x: x <> '')) AS INT) AS parts FROM documents""")
def token_count(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.part_count(F.col("text")).alias("parts"))


@query("""SELECT p_partkey, (CASE p_partkey % 6 WHEN 0 THEN p_size * 1.0 WHEN 1 THEN p_size * 10.0 WHEN 2 THEN p_size * 0.001 WHEN 3 THEN p_size * 1.0 WHEN 4 THEN p_size + 0.5 END)::DOUBLE AS mm FROM part""")
def label_to_mm(t: Tables) -> DataFrame:
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    label = (
        F.when(kind == 0, F.concat(F.lit("SR: "), size, F.lit("MM"))).when(kind == 1, F.concat(size, F.lit(" cm")))
        .when(kind == 2, F.concat(size, F.lit("um"))).when(kind == 3, F.concat(size, F.lit(" rnm")))
        .when(kind == 4, F.concat(size, F.lit(",5 mm"))).otherwise(F.concat(F.lit("hello "), size))
    )
    return t.part.select("p_partkey", text.label_millimetres(label).alias("mm"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'Genus' WHEN p_partkey % 4 = 1 THEN 'Genus epithet' || p_size WHEN p_partkey % 4 = 2 THEN 'Genus' ELSE 'Genus e' || p_size END AS name FROM part""")
def binomial_name(t: Tables) -> DataFrame:
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    name = F.when(kind == 0, F.lit("Genus")).when(kind == 1, F.concat(F.lit("Genus epithet"), size, F.lit(" sub"))).when(kind == 2, F.lit("Genus sp. 3")).otherwise(F.concat(F.lit(" Genus  e"), size, F.lit("  x")))
    return t.part.select("p_partkey", text.binomial(name).alias("name"))


@query("""SELECT event_id, CAST(props ->> '$.k' AS INT) AS k, CAST(value AS DOUBLE) AS x1, CAST(event_id AS DOUBLE) AS y1, CAST(NULL AS DOUBLE) AS none FROM events""")
def json_fields(t: Tables) -> DataFrame:
    point = text.line_coords(F.concat(F.lit('[{"x1": '), F.col("value").cast("string"), F.lit(', "y1": '), F.col("event_id").cast("string"), F.lit("}]")))
    return t.events.select("event_id", F.from_json("props", "k int").getField("k").alias("k"), point["x1"].alias("x1"), point["y1"].alias("y1"), text.line_coords(F.lit("bad"))["x1"].alias("none"))


@query("""SELECT c_custkey, CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END AS padded,
CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ', ' || c_name ELSE c_name END AS prompt FROM customer""")
def padding_and_prompts(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    parts = text.prompt(F.when(k % 2 == 0, F.col("c_mktsegment")), F.lit(""), F.col("c_name"))
    return t.customer.select("c_custkey", text.padded(k.cast("string"), 3).alias("padded"), parts.alias("prompt"))


#: Boxes of orders: an image has those of 50 customers, so images grow with the table. One box in 40 is ten times as large.
_DET = """SELECT o_custkey // 50 AS image, o_orderkey AS id, o_totalprice / 1000 AS score, (o_orderkey * 37 % 601)::DOUBLE AS x1, (o_orderkey * 53 % 607)::DOUBLE AS y1,
(o_orderkey * 37 % 601 + (20 + o_orderkey % 30) * CASE WHEN o_orderkey % 40 = 7 THEN 10 ELSE 1 END)::DOUBLE AS x2,
(o_orderkey * 53 % 607 + (20 + o_orderkey % 25) * CASE WHEN o_orderkey % 40 = 7 THEN 10 ELSE 1 END)::DOUBLE AS y2 FROM orders{}"""
_ALL, _EVEN, _ODD = _DET.format(""), _DET.format(" WHERE o_orderkey % 2 = 0"), _DET.format(" WHERE o_orderkey % 2 = 1")
_IOU = """(greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0)) AS inter"""
_PAIRS = f"""d AS ({_EVEN}), g AS ({_ODD}), x AS (SELECT a.image, a.id AS l_id, b.id AS r_id, {_IOU}, (a.x2 - a.x1) * (a.y2 - a.y1) AS area_a, (b.x2 - b.x1) * (b.y2 - b.y1) AS area_b
FROM d a JOIN g b ON a.image = b.image), p AS (SELECT image, l_id, r_id, inter / greatest(area_a + area_b - inter, 1e-9) AS iou FROM x WHERE inter > 0)"""


def _boxes(t: Tables, odd: int | None = None) -> DataFrame:
    """The boxes of all orders, or one side of two: those of even or of odd orders."""
    k = F.col("o_orderkey")
    x1, y1 = (k * 37 % 601).cast("double"), (k * 53 % 607).cast("double")
    times = F.when(k % 40 == 7, 10).otherwise(1)
    box = F.struct(x1.alias("x1"), y1.alias("y1"), (x1 + (20 + k % 30) * times).alias("x2"), (y1 + (20 + k % 25) * times).alias("y2"))
    rows = t.orders if odd is None else t.orders.filter(k % 2 == odd)
    return rows.select(F.floor(F.col("o_custkey") / 50).alias("image"), k.alias("id"), (F.col("o_totalprice") / 1000).alias("score"), box.alias("box"))


@query(f"WITH {_PAIRS} SELECT image, l_id, r_id, round(iou, 9) AS iou FROM p")
def box_iou_pairs(t: Tables) -> DataFrame:
    return boxes.iou_pairs(_boxes(t, 0), _boxes(t, 1), "image").withColumn("iou", F.round("iou", 9))


@query(f"WITH {_PAIRS} SELECT image, count(DISTINCT r_id) AS tp FROM (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY image, l_id ORDER BY iou DESC, r_id) = 1) WHERE iou >= 0.5 GROUP BY 1")
def box_match_tp(t: Tables) -> DataFrame:
    return boxes.matched(_boxes(t, 0), _boxes(t, 1), "image")


def _greedy(rows: str, name: str) -> str:
    """SQL: <name> (image, id, score, x1, ...) of rows that greedy suppression leaves, one row of an image after the other."""
    inter = "greatest(least(b.x2, r.x2) - greatest(b.x1, r.x1), 0) * greatest(least(b.y2, r.y2) - greatest(b.y1, r.y1), 0)"
    kind = "STRUCT(id BIGINT, score DOUBLE, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE)[]"
    return f"""{name}_r AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, id) AS n FROM {rows}),
{name}_k AS (SELECT image, 0 AS n, []::{kind} AS kept FROM (SELECT DISTINCT image FROM {rows}) UNION ALL
SELECT r.image, r.n, CASE WHEN len(list_filter(k.kept, lambda b: {inter} / greatest((b.x2 - b.x1) * (b.y2 - b.y1) + (r.x2 - r.x1) * (r.y2 - r.y1) - {inter}, 1e-9) > 0.5 OR {inter} > 0.8 * (r.x2 - r.x1) * (r.y2 - r.y1))) > 0
THEN k.kept ELSE list_append(k.kept, {{'id': r.id, 'score': r.score, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2}}) END FROM {name}_k k JOIN {name}_r r ON r.image = k.image AND r.n = k.n + 1),
{name} AS (SELECT image, unnest(kept, recursive := true) FROM (SELECT image, kept FROM {name}_k QUALIFY n = max(n) OVER (PARTITION BY image)))"""


@query(f"""WITH RECURSIVE d AS (SELECT * FROM ({_EVEN}) WHERE image % 2 = 0 OR id % 4 = 0), g AS (SELECT * FROM ({_ODD}) WHERE image % 2 = 1 OR id % 3 = 0),
a AS (SELECT * FROM d WHERE (x2 - x1) * (y2 - y1) < 0.2 * 600 * 600), b AS (SELECT * FROM g WHERE (x2 - x1) * (y2 - y1) < 0.2 * 600 * 600), {_greedy("a", "one")}, {_greedy("b", "two")},
n AS (SELECT image, (SELECT count(*) FROM one WHERE one.image = i.image) AS w, (SELECT count(*) FROM two WHERE two.image = i.image) AS t FROM (SELECT image FROM one UNION SELECT image FROM two) i),
u AS (SELECT * FROM (SELECT * FROM one UNION ALL SELECT * FROM two) WHERE image IN (SELECT image FROM n WHERE t >= 1.25 * w + 3)), {_greedy("u", "three")}
SELECT image, 'whole' AS source, id FROM one WHERE image IN (SELECT image FROM n WHERE NOT t >= 1.25 * w + 3) UNION ALL SELECT image, 'tiles', id FROM three""")
def tray_cleanup(t: Tables) -> DataFrame:
    """Whole images' boxes, or those of tiles and whole together where tiles found clearly more; every other image is crowded."""
    whole = _boxes(t, 0).filter((F.col("image") % 2 == 0) | (F.col("id") % 4 == 0))
    tiled = _boxes(t, 1).filter((F.col("image") % 2 == 1) | (F.col("id") % 3 == 0))
    sizes = t.orders.select(F.floor(F.col("o_custkey") / 50).alias("image")).distinct().withColumns({"width": F.lit(600), "height": F.lit(600)})
    return boxes.tray_boxes(whole, tiled, sizes, "image").select("image", "source", "id")


@query(f"""WITH RECURSIVE d AS ({_ALL}), r AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, id) AS n FROM d),
k AS (SELECT image, 0 AS n, []::STRUCT(id BIGINT, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE)[] AS kept FROM (SELECT DISTINCT image FROM d)
UNION ALL SELECT r.image, r.n, CASE WHEN len(list_filter(k.kept, lambda b: (greatest(least(b.x2, r.x2) - greatest(b.x1, r.x1), 0) * greatest(least(b.y2, r.y2) - greatest(b.y1, r.y1), 0)) /
greatest((b.x2 - b.x1) * (b.y2 - b.y1) + (r.x2 - r.x1) * (r.y2 - r.y1) - greatest(least(b.x2, r.x2) - greatest(b.x1, r.x1), 0) * greatest(least(b.y2, r.y2) - greatest(b.y1, r.y1), 0), 1e-9) > 0.5
OR greatest(least(b.x2, r.x2) - greatest(b.x1, r.x1), 0) * greatest(least(b.y2, r.y2) - greatest(b.y1, r.y1), 0) > 0.8 * (r.x2 - r.x1) * (r.y2 - r.y1))) > 0
THEN k.kept ELSE list_append(k.kept, {{'id': r.id, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2}}) END FROM k JOIN r ON r.image = k.image AND r.n = k.n + 1)
SELECT image, unnest(kept).id AS id FROM k QUALIFY n = max(n) OVER (PARTITION BY image)""")
def nms_greedy(t: Tables) -> DataFrame:
    kept = boxes.suppressed(_boxes(t), "image")
    return kept.select("image", F.explode("kept").alias("k")).select("image", "k.id")


@query("""WITH i AS (SELECT o_orderkey, CAST(o_orderkey % 4000 + 100 AS INT) AS w, CAST(o_custkey % 3000 + 100 AS INT) AS h FROM orders),
x AS (SELECT *, CASE WHEN greatest(w, h) <= 1000 THEN [0] ELSE list_append(list_filter(range(0, greatest(w - 1000, 0) + 1, 750), lambda s: s < greatest(w - 1000, 0)), greatest(w - 1000, 0)) END AS xs,
CASE WHEN greatest(w, h) <= 1000 THEN [0] ELSE list_append(list_filter(range(0, greatest(h - 1000, 0) + 1, 750), lambda s: s < greatest(h - 1000, 0)), greatest(h - 1000, 0)) END AS ys FROM i),
t AS (SELECT o_orderkey, w, h, unnest(xs) AS x1, ys FROM x), u AS (SELECT o_orderkey, w, h, x1, unnest(ys) AS y1 FROM t)
SELECT o_orderkey, CAST(x1 AS INT) AS x1, CAST(y1 AS INT) AS y1, CAST(least(x1 + 1000, w) AS INT) AS x2, CAST(least(y1 + 1000, h) AS INT) AS y2 FROM u""")
def tile_grid(t: Tables) -> DataFrame:
    sizes = t.orders.select("o_orderkey", (F.col("o_orderkey") % 4000 + 100).alias("w"), (F.col("o_custkey") % 3000 + 100).alias("h"))
    return boxes.tiles(sizes, "w", "h", 1000).select("o_orderkey", "x1", "y1", "x2", "y2")


@query(f"""WITH d AS ({_ALL}) SELECT id, CAST(greatest(floor(x1 - 0.5 * (x2 - x1)), 0) AS INT) AS x1, CAST(greatest(floor(y1 - 0.5 * (y2 - y1)), 0) AS INT) AS y1,
CAST(least(ceil(x2 + 0.5 * (x2 - x1)), 120) AS INT) AS x2, CAST(least(ceil(y2 + 0.5 * (y2 - y1)), 110) AS INT) AS y2 FROM d""")
def crop_windows(t: Tables) -> DataFrame:
    window = boxes.crop_window(F.col("box"), F.lit(120), F.lit(110), 0.5)
    return _boxes(t).select("id", window.alias("w")).select("id", "w.*")


@query(f"""WITH d AS ({_ALL}), p AS (SELECT event_id AS p_id, user_id // 5 AS image, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value * 2 END AS x, (event_id % 620) + 0.5 AS y FROM events)
SELECT p_id, p.image, (SELECT id FROM d WHERE d.image = p.image AND x BETWEEN x1 AND x2 AND y BETWEEN y1 AND y2 ORDER BY (x2 - x1) * (y2 - y1), id LIMIT 1) AS box_id FROM p""")
def point_in_box_smallest(t: Tables) -> DataFrame:
    e = F.col("event_id")
    points = t.events.select(e.alias("p_id"), F.floor(F.col("user_id") / 5).alias("image"), F.when(e % 9 != 0, F.col("value") * 2).alias("x"), (e % 620 + 0.5).alias("y"))
    return boxes.smallest_containing(points, _boxes(t), "image").select("p_id", "image", "box_id")


@query(f"""WITH d AS ({_ALL}) SELECT image, arg_max(id, score / 500 + 0.1 * (x2 - x1) * (y2 - y1) / 10000) AS id FROM d GROUP BY 1""")
def best_box_per_image(t: Tables) -> DataFrame:
    rows = _boxes(t).withColumns({"w": F.lit(100.0), "h": F.lit(100.0), "score": F.col("score") / 500})
    return boxes.best_box(rows, "image", "w", "h").select("image", F.col("best.id").alias("id"))


@query(f"""WITH d AS ({_EVEN}), g AS ({_ODD}), a AS (SELECT image, count(*) AS n_whole FROM d GROUP BY 1), b AS (SELECT image, count(*) AS n_tiled FROM g GROUP BY 1)
SELECT image, coalesce(n_whole, 0) AS n_whole, coalesce(n_tiled, 0) AS n_tiled, CASE WHEN coalesce(n_tiled, 0) >= 1.25 * coalesce(n_whole, 0) + 3 THEN 'tiles' ELSE 'whole' END AS source FROM a FULL JOIN b USING (image)""")
def tile_arbitration(t: Tables) -> DataFrame:
    return boxes.arbitrated(_boxes(t, 0), _boxes(t, 1), "image")


@query(f"""WITH d AS ({_ALL}) SELECT id FROM d WHERE (x2 - x1) * (y2 - y1) / 22500 > 0.03 AND (x2 - x1) * (y2 - y1) / 22500 < 0.2 AND (y1 + y2) / 2 < 0.72 * 150""")
def box_filters(t: Tables) -> DataFrame:
    rows = _boxes(t).withColumns({"w": F.lit(150.0), "h": F.lit(150.0)})
    return boxes.sized(rows, "box", "w", "h", least=0.03, most=0.2, lowest_centre=0.72).select("id")


@query(f"""WITH d AS ({_ALL}) SELECT id, x1 + 1000 AS x1, y1 AS y1, x2 + 1000 AS x2, y2 AS y2 FROM d WHERE NOT (x1 <= 3 OR x2 >= 97)""")
def tile_edge_cut(t: Tables) -> DataFrame:
    tile = F.struct(F.lit(1000).alias("x1"), F.lit(0).alias("y1"), F.lit(1100).alias("x2"), F.lit(150).alias("y2"))
    rows = _boxes(t).withColumns({"tile": tile, "w": F.lit(2000), "h": F.lit(150)})
    return boxes.within_tile(rows, "box", "tile", "w", "h").select("id", "box.*")


_CENTRES = """m AS (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL),
c AS (SELECT label, list(x ORDER BY i) AS c FROM m GROUP BY 1), n AS (SELECT label, list_transform(c, lambda v: v / sqrt(list_inner_product(c, c))) AS c FROM c),
e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)"""


@query(f"""WITH {_CENTRES}, s AS (SELECT vec_id, label, list_inner_product(list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))), c) AS score FROM e, n),
p AS (SELECT *, exp(100 * (score - max(score) OVER (PARTITION BY vec_id))) AS power FROM s)
SELECT vec_id, label, round(score, 6) AS score, round(power / sum(power) OVER (PARTITION BY vec_id), 6) AS probability FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) = 1""")
def vector_softmax_top1(t: Tables) -> DataFrame:
    centres = vectors.centroids(t.embeddings, "label", "embedding", 64)
    found = vectors.softmax_top1(t.embeddings.select("vec_id", "embedding"), centres, "vec_id", "embedding", "label", "centroid")
    return found.withColumns({c: F.round(c, 6) for c in ("score", "probability")})


@query(f"""WITH {_CENTRES}, r AS (SELECT vec_id, vec_id // 4 AS record, vec_id // 4 % 3 AS site, v FROM e), k AS (SELECT label, site, c FROM n, range(3) AS s(site) WHERE (label + site) % 3 <> 0),
s AS (SELECT record, vec_id, label, exp(20 * list_inner_product(list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))), c)) AS power FROM r JOIN k USING (site)),
p AS (SELECT *, power / sum(power) OVER (PARTITION BY vec_id) AS share FROM s), g AS (SELECT record, label, avg(share) AS probability FROM p GROUP BY ALL)
SELECT record, label AS pick, round(probability, 6) AS probability FROM g QUALIFY row_number() OVER (PARTITION BY record ORDER BY round(probability, 9) DESC, label) = 1""")
def mean_probability_pick(t: Tables) -> DataFrame:
    """The pick of records of four specimens, each among the candidates of its site, by the mean of the specimens' shares."""
    centres = vectors.centroids(t.embeddings, "label", "embedding", 64)
    listed = centres.withColumn("site", F.explode(F.array(*[F.lit(i).cast("long") for i in range(3)]))).filter((F.col("label") + F.col("site")) % 3 != 0)
    record = F.floor(F.col("vec_id") / 4)
    specimens = t.embeddings.select("vec_id", "embedding", record.alias("record"), (record % 3).alias("site"))
    shares = vectors.softmax_all(specimens, listed, "vec_id", "embedding", "label", "centroid", scale=20.0, on=["site"])
    picks = vectors.mean_probability(shares.join(specimens.select("vec_id", "record"), "vec_id"), "record", "label", "probability")
    return picks.select("record", F.col("label").alias("pick"), F.round("probability", 6).alias("probability"))
