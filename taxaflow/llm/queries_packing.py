"""op2: the contract's digest of packed sequences."""

from pyspark.sql import DataFrame, SparkSession

from taxaflow.llm.common import table
from taxaflow.llm.packing import pack


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), "doc_id", "text", size=2048, open_windows=32, end_id=1)


QUERIES = {"op2_packing": op2_packing}
ORACLE_SQL: dict[str, str] = {}
