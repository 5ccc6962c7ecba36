"""op1: the contract's digest of near-duplicate groups."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import table
from taxaflow.llm.simhash import near_groups


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents"), "doc_id", "text", size=3)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("group_id").alias("component_id"),
    )


QUERIES = {"op1_simhash_near_dedup": op1_simhash_near_dedup}
ORACLE_SQL: dict[str, str] = {}
