"""op3: the contract's digest of extracted main texts."""

from pyspark.sql import DataFrame, SparkSession

from taxaflow.llm.common import table
from taxaflow.llm.wrapper import extract


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op3_html_extraction": op3_html_extraction}
ORACLE_SQL: dict[str, str] = {}
