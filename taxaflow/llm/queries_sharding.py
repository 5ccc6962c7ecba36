"""op10: the contract's digest of sharding, under the law "bytes"."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import table
from taxaflow.llm.sharding import byte_shards


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_shards(table(spark, sf_dir, "documents"), 16, "doc_id", "text")
    return found.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op10_byte_shards": op10_byte_shards}
ORACLE_SQL: dict[str, str] = {}
