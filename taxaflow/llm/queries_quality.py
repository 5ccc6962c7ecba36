"""op7: the contract's digest of quality scores."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import table
from taxaflow.llm.quality import fit, score

KEEP = 0.7


def held_out() -> F.Column:
    """By the id's CRC-32; a row without an id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", "quality"))
    found = score(docs, net).drop("text")
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))


QUERIES = {"op7_quality_classifier": op7_quality_classifier}
ORACLE_SQL: dict[str, str] = {}
