"""Composite plans over tables shaped like specimen records, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.plans import specimens, validation
from taxaflow.plans.registry import Tables, query


@query("""WITH p AS (SELECT 'I' || o_custkey AS individualID, o_orderpriority AS taxonID, o_orderstatus AS scientificName, 'P' || o_custkey % 25 AS plotID, o_orderdate AS d, o_orderkey,
strftime(o_orderdate, '%Y-%m-%d') AS collectDate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
e AS (SELECT 'I' || c_custkey AS individualID, CASE WHEN c_custkey % 2 = 0 THEN 'T' || c_custkey END AS t, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS s FROM customer WHERE c_custkey % 3 = 0)
SELECT p.individualID, CASE WHEN s IS NOT NULL THEN t ELSE taxonID END AS "bestTaxonID", CASE WHEN s IS NOT NULL THEN s ELSE scientificName END AS "bestScientificName",
CASE WHEN s IS NOT NULL THEN 'expert' ELSE 'parataxonomist' END AS "idSource", year(d)::BIGINT AS year, n_name AS "nlcdClass" FROM p LEFT JOIN e USING (individualID) LEFT JOIN nation ON 'P' || n_nationkey = plotID""")
def specimen_manifest(t: Tables) -> DataFrame:
    name = lambda c, p="I": F.concat(F.lit(p), F.col(c).cast("string"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    para = t.orders.select(
        name("o_custkey").alias("individualID"), F.col("o_orderpriority").alias("taxonID"), F.col("o_orderstatus").alias("scientificName"),
        F.concat(F.lit("P"), (F.col("o_custkey") % 25).cast("string")).alias("plotID"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("identifiedDate"),
        day.alias("collectDate"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("uid"),
    )
    k = F.col("c_custkey")
    expert = t.customer.filter(k % 3 == 0).select(name("c_custkey").alias("individualID"), F.when(k % 2 == 0, name("c_custkey", "T")).alias("taxonID"), F.when(k % 5 != 0, F.col("c_mktsegment")).alias("scientificName"), F.lit("2020").alias("identifiedDate"))
    field = t.nation.select(name("n_nationkey", "P").alias("plotID"), F.col("n_name").alias("nlcdClass"), *[F.lit(1.0).alias(c) for c in ("decimalLatitude", "decimalLongitude", "elevation")], F.lit(None).cast("string").alias("collectDate"))
    return specimens.specimen_manifest(para, expert, field).select("individualID", "bestTaxonID", "bestScientificName", "idSource", "year", "nlcdClass")


@query("""WITH c AS (SELECT 'S' || c_nationkey AS siteID, c_mktsegment AS higher_taxon, 'sp' || c_custkey % 7 AS species, CAST(c_custkey % 7 AS INT) AS k, count(*) AS n FROM customer GROUP BY ALL)
SELECT siteID AS "siteID", higher_taxon, count(*) AS n_candidates, arg_max(species, n * 100 - k) AS range_pick, max(n) / CAST(sum(n) AS BIGINT) AS range_pick_share FROM c GROUP BY ALL""")
def range_picks(t: Tables) -> DataFrame:
    key = (F.col("c_custkey") % 7).cast("int")
    rows = t.customer.groupBy(F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("siteID"), F.col("c_mktsegment").alias("higher_taxon"), F.concat(F.lit("sp"), key.cast("string")).alias("species"), key.alias("speciesKey"))
    return validation.range_picks(rows.agg(F.count("*").alias("n_observations"))).select("siteID", "higher_taxon", "n_candidates", "range_pick", "range_pick_share")


@query("""WITH s AS (SELECT 'v' || l_orderkey || '-' || l_partkey AS sample_id, CASE WHEN l_partkey % 3 = 0 THEN 'carabid' WHEN l_partkey % 3 = 1 THEN 'invert bycatch' ELSE 'odd' END AS st, min(l_suppkey) AS sup FROM lineitem GROUP BY ALL)
SELECT sample_id, CASE st WHEN 'carabid' THEN 'bulk carabid' WHEN 'invert bycatch' THEN 'invertebrate bycatch' ELSE st END AS specimen_group,
s_name AS "biorepo_catalogNumber", CASE WHEN s_name IS NOT NULL THEN 'barcode' END AS biorepo_link, s_name IS NOT NULL AS in_biorepository FROM s LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON s_suppkey = sup""")
def preserved_samples(t: Tables) -> DataFrame:
    k = F.col("l_partkey") % 3
    kind = F.when(k == 0, "carabid").when(k == 1, "invert bycatch").otherwise("odd")
    sid = F.concat(F.lit("v"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"))
    sorting = t.lineitem.groupBy(sid.alias("subsampleID"), kind.alias("sampleType")).agg(F.min("l_suppkey").cast("string").alias("subsampleCode"))
    none = F.lit(None).cast("string")
    records = t.supplier.filter("s_suppkey % 2 = 0").select(F.col("s_name").alias("catalogNumber"), none.alias("neon_sampleID"), none.alias("neon_sampleID_hash"), F.col("s_suppkey").cast("string").alias("neon_barcode"), F.lit("X").alias("collection"), F.lit("o").alias("occid"), F.lit(1).alias("n_images"))
    return specimens.preserved_samples(sorting, None, records).select("sample_id", "specimen_group", "biorepo_catalogNumber", "biorepo_link", "in_biorepository")
