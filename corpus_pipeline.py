"""The corpus pipeline: five stages, each over all that its predecessor kept.

Quality classifier, exact dedup, SimHash near-dedup, benchmark decontamination, packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm import decontaminate, packing, quality, recipes, similar
from taxaflow.llm.common import bounded, materialise, named, table, unused_name, without

#: Documents with a lower score are rejected.
LEAST_QUALITY = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network finds likelier good than bad stay; it learns from all labels of the corpus.

    A null text is judged as an empty one, very long ones whole, repeated rows alike. Where labels of only one class
    are known, they decide nothing and all stay. Columns of any name are kept; an empty table stays empty.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    net = quality.fit(docs.select("doc_id", "text"), labels)
    if isinstance(net, float):
        return docs
    score = unused_name(docs, "score")
    return quality.score(docs, net, score_col=score).filter(F.col(score) >= LEAST_QUALITY).select(*map(named, docs.columns))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest doc_id.

    Null and empty texts are equal. Rows without an id stay, and so do rows that repeat the id that stays. Texts of any
    length are compared whole, columns of any name are kept, and an empty table stays empty.
    """
    bounded(spark)
    lost = recipes.exact_groups(docs.filter("doc_id IS NOT NULL")).filter("NOT kept").select(F.col("id").alias("doc_id"))
    return without(docs, lost, "doc_id")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id, an integer.

    Rows without an id, and texts that are null or without words, stay; rows that repeat an id are one document.
    Texts of any length are compared whole, columns of any name are kept, and an empty table stays empty.
    """
    bounded(spark)
    lost = similar.similar_groups(docs, size=5, least=0.8).filter("id <> group_id").select(F.col("id").alias("doc_id"))
    return without(docs, lost, "doc_id")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Rows without an id and null or empty texts stay; rows that repeat the id of a document that goes do too. Texts of
    any length are searched whole, columns of any name are kept. Empty documents, or an empty benchmark, drop nothing.
    """
    found = decontaminate.contamination(docs.filter("doc_id IS NOT NULL"), table(spark, sf_dir, "benchmark"))
    return without(docs, found, "doc_id")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, as pieces of sequences of 2048 tokens.

    A null text is an empty one and gives its end mark alone; rows without an id and repeated rows are packed too, long
    texts are cut into pieces. Of the columns only doc_id and text are read; an empty table gives no rows.
    """
    bounded(spark)
    return packing.pack(docs, size=2048, open_windows=32, end_id=1)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each result written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
