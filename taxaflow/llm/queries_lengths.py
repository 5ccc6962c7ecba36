"""op5: the exact histogram of encoded lengths and its sums."""

from pyspark.sql import DataFrame, SparkSession

from taxaflow.llm.common import table
from taxaflow.llm.lengths import length_histogram


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(table(spark, sf_dir, "documents"), "text")


QUERIES = {"op5_token_counts": op5_token_counts}
ORACLE_SQL: dict[str, str] = {}
