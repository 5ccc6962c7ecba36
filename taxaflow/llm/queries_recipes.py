"""op9: the contract's digest of exact deduplication."""

from pyspark.sql import DataFrame, SparkSession

from taxaflow.llm.common import table
from taxaflow.llm.recipes import exact_groups


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


QUERIES = {"op9_exact_dedup": op9_exact_dedup}
ORACLE_SQL = {
    "op9_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
}
