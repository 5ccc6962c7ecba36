"""op6: benchmark items found in documents."""

from pyspark.sql import DataFrame, SparkSession

from taxaflow.llm.common import table
from taxaflow.llm.decontaminate import contamination


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_decontamination": op6_decontamination}
ORACLE_SQL: dict[str, str] = {}
