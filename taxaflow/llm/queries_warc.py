"""op4: the contract's digest of archived pages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import shared_path, table
from taxaflow.llm.warc import read_archive, write_archive


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path, least_bytes=100)
    found = read_archive(spark, path)
    return found.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


QUERIES = {"op4_warc_archive": op4_warc_archive}
ORACLE_SQL = {
    "op4_warc_archive": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
                   FROM pages),
             f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
}
