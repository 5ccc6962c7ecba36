"""The jobs as queries: each runs twice over whole tables into one new folder, and returns what is there afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import collection_pages, specimen_manifest
from taxaflow.streaming.windows import shared_folder


def job1_collection_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "collection-pages")
    pages = f"{sf_dir}/[p]ages.parquet"  # a pattern, as the table can be one file, which is no folder to watch
    for _ in range(2):
        found = collection_pages.run(spark, pages, f"{folder}/out", f"{folder}/checkpoint")
    return found


def job2_specimen_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "specimen-manifest")
    for _ in range(2):
        found = specimen_manifest.run(spark, sf_dir, folder)
    return found.withColumn("year", F.col("year").cast("long")).select(
        "individualID", "siteID", "plotID", "bestTaxonID", "bestScientificName", "idSource", "nlcdClass", "decimalLatitude",
        "biorepo_collection", "biorepo_catalogNumber", "biorepo_n_images", "in_biorepository", "year",
    )


QUERIES = {"job1_collection_pages": job1_collection_pages, "job2_specimen_manifest": job2_specimen_manifest}
ORACLE_SQL = {
    "job1_collection_pages": r"""
        WITH t AS (
            SELECT page_id, url, nullif(trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(
                       regexp_replace(regexp_replace(html, '<li[^>]*>', ' - ', 'g'), '<[^>]+>', ' ', 'g'),
                       '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&copy;', '©'), '&middot;', '·'),
                       '&amp;?', '&', 'g'), '\s+', ' ', 'g')), '') AS text,
                   regexp_replace(split_part(split_part(url, '?', 1), '#', 1), '^.*/', '') AS file FROM pages WHERE page_id IS NOT NULL),
        r AS (
            SELECT page_id, url, nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]+)', 1), '') AS host,
                   nullif(regexp_replace(regexp_replace(file, '(.)\.[^.]*$', '\1'), '_(lg|tn)$', ''), '') AS stem, text,
                   CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, ' ')) END::INTEGER AS n_words, sha256(text) AS digest FROM t),
        d AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY page_id, digest ORDER BY url NULLS LAST) = 1),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
        SELECT page_id, url, host, stem, text, n_words, digest, CASE WHEN digest IS NOT NULL AND page_id <> first THEN first END AS duplicate_of,
               NULL::BIGINT AS previous_batch, 0::BIGINT AS batch, coalesce(CAST('0x' || left(digest, 7) AS BIGINT) % 8, 0)::INTEGER AS bucket FROM f""",
    "job2_specimen_manifest": """
        WITH p AS (
            SELECT 'I' || o_custkey AS individualID, 'S' || o_custkey % 25 AS siteID, 'P' || o_custkey % 25 AS plotID, o_orderpriority AS taxonID, o_orderstatus AS name, o_orderdate AS d
            FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
        e AS (
            SELECT 'I' || c_custkey AS individualID, CASE WHEN c_custkey % 2 = 0 THEN 'T' || c_custkey END AS taxonID, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS name
            FROM customer WHERE c_custkey % 3 = 0),
        r AS (
            SELECT 'I' || l_partkey % 5000 AS individualID, CASE l_returnflag WHEN 'R' THEN 'CARC-PV' WHEN 'A' THEN 'DCTC' ELSE 'CARC-TS' END AS collection,
                   'C' || l_orderkey || '-' || l_linenumber AS number, l_quantity::BIGINT % 4 AS n_images
            FROM lineitem WHERE l_linenumber <= 3
            QUALIFY row_number() OVER (PARTITION BY l_partkey % 5000 ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, l_quantity::BIGINT % 4 DESC, l_orderkey, l_linenumber) = 1)
        SELECT individualID AS "individualID", siteID AS "siteID", plotID AS "plotID", CASE WHEN e.name IS NOT NULL THEN e.taxonID ELSE p.taxonID END AS "bestTaxonID",
               CASE WHEN e.name IS NOT NULL THEN e.name ELSE p.name END AS "bestScientificName", CASE WHEN e.name IS NOT NULL THEN 'expert' ELSE 'parataxonomist' END AS "idSource",
               n_name AS "nlcdClass", n_regionkey::DOUBLE AS "decimalLatitude", collection AS biorepo_collection, number AS "biorepo_catalogNumber",
               coalesce(n_images, 0) AS biorepo_n_images, number IS NOT NULL AS in_biorepository, year(d)::BIGINT AS year
        FROM p LEFT JOIN e USING (individualID) LEFT JOIN nation ON 'P' || n_nationkey = plotID LEFT JOIN r USING (individualID)""",
}
