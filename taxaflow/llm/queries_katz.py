"""op8: the contract's digest of language-model scores."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import table
from taxaflow.llm.katz import fit, score


def held_out() -> F.Column:
    """By the id's CRC-32; rows without an id are learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))


def op8_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs.filter(~held_out()))
    found = score(docs, model).withColumnRenamed("id", "doc_id")
    total = F.lit(model.constants.total).cast("long")
    return found.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", total.alias("train_tokens"), "base_score", "score")


QUERIES = {"op8_katz_backoff": op8_katz_backoff}
ORACLE_SQL: dict[str, str] = {}
