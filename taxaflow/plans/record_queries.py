"""Composites of the manifests: repository records and images, trays, linked annotations, searches and queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.operators import inference, shaping
from taxaflow.plans import measurements, specimens, validation
from taxaflow.plans.kernel_queries import _PLACED, _instances
from taxaflow.plans.registry import Tables, query

_RECORDS = """o AS (SELECT CAST(o_orderkey AS VARCHAR) AS occid, o_orderkey % 3 AS k, o_orderkey % 26 AS l, * FROM orders),
m AS (SELECT CAST(l_orderkey AS VARCHAR) AS coreid, l_linenumber, l_partkey, l_returnflag FROM lineitem),
r AS (SELECT occid, CASE k WHEN 0 THEN 'CARC-PV' WHEN 1 THEN 'HEVC-X' ELSE 'OTHER' END AS collection, 'NEON.BET.D0' || o_custkey % 9 || '.' || CASE WHEN k = 2 THEN 'x' ELSE '' END || o_custkey AS neon_sampleID,
CASE WHEN k = 1 THEN 'b' || o_orderkey END AS neon_barcode, repeat(chr(CAST(65 + l AS INTEGER)), 4) AS siteID, repeat(chr(CAST(65 + l AS INTEGER)), 4) || '_' || lpad(CAST(l AS VARCHAR), 3, '0') AS plotID, CASE WHEN k <> 1 THEN 'D0' || o_custkey % 9 END AS domainID,
(SELECT count(*) FROM m WHERE m.coreid = o.occid) AS n_images FROM o)"""


def _line() -> Column:
    """An id of each row of lineitem."""
    return ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")) * 1000 + F.col("l_suppkey")


def _occurrences(t: Tables) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    domain = F.concat(F.lit("D0"), (customer % 9).cast("string"))
    sample = F.concat(F.lit("NEON.BET."), domain, F.lit("."), F.when(key % 3 == 2, "x").otherwise(""), customer.cast("string"))
    barcode = F.when(key % 3 == 1, F.concat(F.lit("; NEON sampleCode (barcode): b"), key.cast("string"))).otherwise("")
    site = F.repeat(F.chr(F.lit(65) + key % 26), 4)
    place = F.concat(site, F.lit("_"), F.lpad((key % 26).cast("string"), 3, "0"), F.lit(".basePlot"))
    return t.orders.select(
        key.cast("string").alias("occid"), F.concat(F.lit("NEON sampleID: "), sample, barcode, F.lit(" | other: 5")).alias("otherCatalogNumbers"), place.alias("locationID"),
        F.when(key % 3 == 1, domain).otherwise(F.concat(F.lit("Domain ("), domain, F.lit(")"))).alias("locality"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("eventDate"),
        (key % 5).cast("string").alias("individualCount"), key.alias("_key"),
    )


def _media(t: Tables) -> DataFrame:
    part = F.concat(F.lit("https://x.org/p/"), F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, "_dorsal_lg").otherwise("_Ventral"), F.lit(".jpg?v=1"))
    kind = F.when(F.col("l_returnflag") == "N", "Sound").when(F.col("l_returnflag") == "A", "StillImage")
    low = F.lit(None).cast("string")
    return t.lineitem.select(F.col("l_orderkey").cast("string").alias("coreid"), part.alias("accessURI"), low.alias("goodQualityAccessURI"), kind.alias("type"))


def _collection(key: Column) -> Column:
    return F.when(key % 3 == 0, "CARC-PV").when(key % 3 == 1, "HEVC-X").otherwise("OTHER")


def _records(t: Tables) -> DataFrame:
    return specimens.repository_records(_occurrences(t), _collection(F.col("_key")), F.lit("pinned carabid"), _media(t))


@query(f"""WITH {_RECORDS} SELECT occid, collection, neon_sampleID AS "neon_sampleID", neon_barcode, CASE WHEN regexp_full_match(neon_sampleID, 'NEON\\.BET\\.D\\d\\d\\.\\d+') THEN neon_sampleID END AS "individualID",
siteID AS "siteID", plotID AS "plotID", domainID AS "domainID", n_images FROM r""")
def repository_records(t: Tables) -> DataFrame:
    return _records(t).select("occid", "collection", "neon_sampleID", "neon_barcode", "individualID", "siteID", "plotID", "domainID", "n_images")


@query(f"""WITH {_RECORDS}, i AS (SELECT coreid AS occid, 'https://x.org/p/' || l_partkey || CASE WHEN l_linenumber % 2 = 0 THEN '_dorsal_lg' ELSE '_Ventral' END || '.jpg?v=1' AS image_url,
l_partkey || CASE WHEN l_linenumber % 2 = 0 THEN '_dorsal_lg' ELSE '_Ventral' END AS stem FROM m WHERE l_returnflag <> 'N'),
u AS (SELECT i.*, collection FROM i LEFT JOIN r USING (occid) QUALIFY row_number() OVER (PARTITION BY image_url ORDER BY occid) = 1)
SELECT 'biorepo/' || collection || '/' || stem AS image_id, occid, image_url, CASE collection WHEN 'HEVC-X' THEN 'bycatch' WHEN 'CARC-PV' THEN 'pinned' ELSE 'individual' END AS image_kind,
CASE WHEN stem LIKE '%dorsal%' THEN 'dorsal' ELSE 'ventral' END AS view FROM u""")
def repository_images(t: Tables) -> DataFrame:
    return specimens.repository_images(_records(t).select("occid", "collection"), _media(t)).select("image_id", "occid", "image_url", "image_kind", "view")


@query(f"""WITH {_RECORDS}, c AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'CARC-PV' WHEN 1 THEN 'HEVC-X' ELSE 'OTHER' END AS collection, count(*) AS records, count(DISTINCT o_orderkey % 26) AS sites,
CAST(min(year(o_orderdate)) AS VARCHAR) AS first_year, CAST(max(year(o_orderdate)) AS VARCHAR) AS last_year, sum(o_orderkey % 5)::DOUBLE AS individuals FROM orders GROUP BY 1),
n AS (SELECT collection, count(*) FILTER (n_images > 0) AS records_with_images, sum(n_images)::BIGINT AS images FROM r GROUP BY 1)
SELECT i.collection, 'Beetles & more' AS description, coalesce(records, 0) AS records, records_with_images, sites, first_year, last_year, individuals, coalesce(images, 0) AS images
FROM (VALUES ('CARC-PV'), ('HEVC-X'), ('OTHER'), ('EMPTY')) i(collection) LEFT JOIN c USING (collection) LEFT JOIN n USING (collection)""")
def collection_catalog(t: Tables) -> DataFrame:
    named = F.explode(F.array(*[F.lit(c) for c in ("CARC-PV", "HEVC-X", "OTHER", "EMPTY")]))
    collections = t.region.limit(1).select(named.alias("collection"), F.lit("<p>Beetles &amp;</p><br>more").alias("description"))
    records = _records(t)
    images = specimens.side_table(_media(t).select("coreid"), "").drop("collection").join(records.select("occid", "collection"), "occid")
    return specimens.collection_catalog(collections, records, images).select(
        "collection", "description", "records", "records_with_images", "sites", "first_year", "last_year", "individuals", "images"
    )


@query("""WITH l AS (SELECT l_suppkey, ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey AS id, l_partkey, l_quantity AS q, 100 + l_linenumber AS cm FROM lineitem)
SELECT 'hf2018/P' || l_suppkey AS image_id, min_by('n' || l_partkey % 50, CASE WHEN l_partkey % 4 <> 0 THEN id END) AS "scientificName", 4000::INTEGER AS height, 6000::INTEGER AS width, round(median(cm * 2.0) / 10, 9) AS px_per_mm,
round(sum(sqrt((2 * q) ** 2 + (2 * q) ** 2)), 4) AS pixels FROM l GROUP BY l_suppkey""")
def tray_manifest(t: Tables) -> DataFrame:
    """Trays of measurement rows with JSON lines and sizes as text."""
    q = F.col("l_quantity").cast("string")
    line = F.concat(F.lit('[{"x1": 1, "y1": 2, "x2": '), (F.col("l_quantity") + 1).cast("string"), F.lit(', "y2": '), (F.col("l_quantity") + 2).cast("string"), F.lit("}]"))
    rows = t.lineitem.select(
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string"), F.lit(".jpg")).alias("pictureID"), line.alias("coords_pix"), F.lit("(4000, 6000, 3)").alias("image_dim"), F.lit("(2000, 3000, 3)").alias("resized_image_dim"),
        (100 + F.col("l_linenumber")).cast("string").alias("cm_pix"), _line().alias("measureID"), q.alias("NEON_sampleID"), q.alias("siteID"), q.alias("plotID"),
        F.when(F.col("l_partkey") % 4 != 0, F.concat(F.lit("n"), (F.col("l_partkey") % 50).cast("string"))).alias("scientificName"),
    )
    trays, lines = measurements.tray_manifest(rows)
    drawn = lines.groupBy("image_id").agg(F.round(F.sum("dist_px_full"), 4).alias("pixels"))
    return trays.select("image_id", "scientificName", "height", "width", F.round("px_per_mm", 9).alias("px_per_mm")).join(drawn, "image_id")


#: Lines lie with their middle on a part's rectangle; those of workflow 1 are drawn in a frame that is a tenth too small.
@query(f"""WITH {_PLACED}, l AS (SELECT p_partkey, image, l_linenumber % 2 AS flow, x1 + 0.0 AS x, y1 + 0.0 AS y, l_quantity AS cm, CASE WHEN l_linenumber % 3 = 0 THEN 'ElytraWidth' ELSE 'ElytraLength' END AS structure
FROM lineitem JOIN m ON p_partkey = l_partkey),
h AS (SELECT l.*, (SELECT min(p_partkey) FROM m WHERE m.image = l.image AND l.x >= m.x1 AND l.x < m.x1 + m.a AND l.y >= m.y1 AND l.y < m.y1 + m.b) AS hit FROM l WHERE flow = 0)
SELECT hit AS instance_id, median(cm * 10) FILTER (structure = 'ElytraLength') AS ann_elytra_length_mm, median(cm * 10) FILTER (structure = 'ElytraWidth') AS ann_elytra_width_mm FROM h GROUP BY 1""")
def line_annotations(t: Tables) -> DataFrame:
    placed = _instances(t).withColumns({"x1": F.col("win_x1") + F.col("x"), "y1": F.col("win_y1") + F.col("y")})
    box = F.struct(*[F.lit(-1.0).alias(n) for n in ("x1", "y1", "x2", "y2")])
    flow = F.col("l_linenumber") % 2
    lines = t.lineitem.join(placed.select(F.col("p_partkey").alias("l_partkey"), "image_id", "x1", "y1"), "l_partkey").select(
        _line().alias("measureID"), "image_id", flow.alias("workflowID"), F.when(F.col("l_linenumber") % 3 == 0, "ElytraWidth").otherwise("ElytraLength").alias("structure"),
        F.col("l_quantity").alias("dist_cm"), F.when(flow == 1, 90.0).otherwise(100.0).alias("px_per_cm_full"), F.lit(True).alias("lying_flat"),
        *[F.col(c[0] + "1").cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")],
    )
    scales = placed.select("image_id").distinct().select("image_id", F.lit(10.0).alias("px_per_mm"), F.lit("checkerboard").alias("scale_source"))
    return measurements.line_annotations(lines, placed.withColumn("box", box), scales).drop("ann_lying_flat")


@query("""WITH k AS (SELECT 'S' || o_custkey % 40 AS siteID, o_orderpriority AS higher_taxon, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 97 END AS taxonKey, CASE WHEN o_custkey % 40 <> 7 THEN o_totalprice END AS lat, o_custkey * 1.0 AS lon FROM orders),
s AS (SELECT siteID, avg(lat) AS lat, avg(lon) AS lon FROM k GROUP BY 1)
SELECT siteID AS "siteID", higher_taxon, min(taxonKey) AS "taxonKey", round(any_value(s.lat), 4) AS lat, round(any_value(s.lon), 4) AS lon FROM k JOIN s USING (siteID) WHERE taxonKey IS NOT NULL AND s.lat IS NOT NULL GROUP BY ALL""")
def candidate_searches(t: Tables) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    records = t.orders.select(
        F.concat(F.lit("S"), (customer % 40).cast("string")).alias("siteID"), F.col("o_orderpriority").alias("higher_taxon"), F.when(key % 6 != 0, key % 97).alias("taxonKey"),
        F.when(customer % 40 != 7, F.col("o_totalprice")).alias("decimalLatitude"), customer.cast("double").alias("decimalLongitude"),
    )
    return validation.candidate_searches(records).withColumns({c: F.round(c, 4) for c in ("lat", "lon")})


@query("""WITH p AS (SELECT *, l_extendedprice AS m, l_quantity * 1500 AS x, l_tax * 100 AS y FROM lineitem), s AS (SELECT 'all' AS subset, * FROM p UNION ALL SELECT 'small', * FROM p WHERE l_quantity < 10),
w AS (SELECT subset, 'length' AS pair, m, x FROM s UNION ALL SELECT subset, 'width', l_discount * 100, y FROM s), n AS (SELECT subset, pair, count(*) AS n FROM w GROUP BY ALL),
g AS (SELECT subset, pair, avg(m - x) AS bias, avg(abs(m - x)) AS mae, median(abs(m - x) / x) * 100 AS median_abs_pct, avg(CASE WHEN abs(m - x) / x <= 0.1 THEN 1.0 ELSE 0 END) AS within_10pct, corr(m, x) AS pearson_r, regr_slope(m, x) AS slope FROM w WHERE x > 0 GROUP BY ALL)
SELECT subset, pair, metric, round(value, 4) AS value, n FROM (SELECT subset, pair, unnest(['bias', 'mae', 'median_abs_pct', 'within_10pct', 'pearson_r', 'slope']) AS metric, unnest([bias, mae, median_abs_pct, within_10pct, pearson_r, slope]) AS value FROM g) JOIN n USING (subset, pair)""")
def trait_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumns({"x": F.col("l_quantity") * 1500, "y": F.col("l_tax") * 100, "w": F.col("l_discount") * 100})
    subsets = {"all": F.lit(True), "small": F.col("l_quantity") < 10}
    return validation.trait_summary(rows, {"length": ("x", "l_extendedprice"), "width": ("y", "w")}, subsets).withColumn("value", F.round("value", 4))


@query("""WITH i AS (SELECT o_orderkey AS image_id, o_custkey % 5 <> 0 AS process, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS k, o_orderkey % 11 = 0 AS failed, o_orderkey % 13 = 0 AS bare FROM orders)
SELECT image_id, process AND k IS NULL AS unmeasured, failed OR bare AS again FROM i""")
def scale_backlog(t: Tables) -> DataFrame:
    """Which images still need a scale, as those with an annotated one do not, and which are to be run again."""
    key = F.col("o_orderkey")
    manifest = t.orders.select(key.alias("image_id"), (F.col("o_custkey") % 5 != 0).alias("process"), F.when(key % 3 == 0, F.col("o_totalprice")).alias("px_per_mm"))
    to_do = measurements.unmeasured(manifest, measurements.prior_scales(manifest)).select("image_id", F.lit(True).alias("_to_do"))
    results = t.orders.select(key.alias("image_id"), F.when(key % 11 == 0, "error:ValueError").otherwise("ok").alias("status"))
    again = inference.recheck_queue(results, t.orders.filter(key % 13 != 0).select(key.alias("image_id"))).withColumn("_again", F.lit(True))
    found = manifest.join(to_do, "image_id", "left").join(again, "image_id", "left")
    return found.select("image_id", shaping.flag(F.col("_to_do")).alias("unmeasured"), shaping.flag(F.col("_again")).alias("again"))


@query("""SELECT p_partkey, least(p_size, p_size * 2, p_partkey % 30) >= 0.002 * 4800 AND p_partkey % 100 >= 0.01 * 4800 AS trusted FROM part""")
def trusted_parts(t: Tables) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    return t.part.select("p_partkey", inference.trusted_parts(size, size * 2, key % 30, key % 100, F.lit(4800)).alias("trusted"))


@query("""SELECT o_custkey, bool_or(o_orderstatus IN ('P', 'F')) AS routed FROM orders GROUP BY 1""")
def set_intersection(t: Tables) -> DataFrame:
    """Whether a customer's orders have one of the statuses that need a model."""
    return t.orders.groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("routes")).select("o_custkey", shaping.intersects(F.col("routes"), ["P", "F"]).alias("routed"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber AS n, l_quantity AS q, count(*) OVER (PARTITION BY l_orderkey) AS c, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS i FROM lineitem)
SELECT l_orderkey, n, q FROM l WHERE i <= greatest(c - l_orderkey % 2, 0)""")
def zipped_records(t: Tables) -> DataFrame:
    """Parallel lists of an order's lines as records; odd orders' second list is one shorter, and the last line goes with it."""
    line = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity")))
    lists = t.lineitem.groupBy("l_orderkey").agg(line.alias("l")).withColumns({"n": F.col("l.l_linenumber"), "q": F.col("l.l_quantity")})
    shorter = F.slice("q", 1, F.greatest(F.size("q") - (F.col("l_orderkey") % 2).cast("int"), F.lit(0)))
    return lists.select("l_orderkey", F.explode(shaping.zipped(n=F.col("n"), q=shorter)).alias("r")).select("l_orderkey", "r.n", "r.q")
