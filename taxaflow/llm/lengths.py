"""Exact token totals from the histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.llm.common import materialise
from taxaflow.llm.tokens import encoder, tokenizer_path

#: Lengths whose suffix sums one task computes.
SPAN = 4096


def encoded_lengths(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(n_tokens, docs): how many texts of each batch have each encoded length; a null text has length 0."""
    path = tokenizer or tokenizer_path()

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).id_bytes
        for batch in batches:
            lengths = np.fromiter((len(encode(t.as_py())) // 4 for t in batch.column(0)), np.int64, batch.num_rows)
            values, n = np.unique(lengths, return_counts=True)
            yield pa.record_batch([pa.array(values), pa.array(n.astype(np.int64))], names=["n_tokens", "docs"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(counted, "n_tokens long, docs long")


def with_suffix_sums(lengths: DataFrame) -> DataFrame:
    """(n_tokens, docs) rows as an exact histogram with sums, one row for each length that occurs.

    docs_upto and tokens_upto: documents and tokens of documents up to this length. docs_over and tokens_over: of
    longer ones. truncated_total: tokens that stay if every document is cut to this many, which is tokens_upto +
    n_tokens * docs_over. total_docs and total_tokens stand on each row. Sums run within spans of lengths, and
    over the totals of spans, so that no task reads all lengths.
    """
    hist = materialise(lengths.groupBy("n_tokens").agg(F.sum("docs").alias("docs")), "lengths")
    hist = hist.withColumns({"span": F.floor(F.col("n_tokens") / SPAN), "tokens": F.col("n_tokens") * F.col("docs")})
    spans = hist.groupBy("span").agg(F.sum("docs").alias("span_docs"), F.sum("tokens").alias("span_tokens"))
    later = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    # one row for each SPAN lengths up to the longest document
    spans = spans.select(
        "span",
        F.coalesce(F.sum("span_docs").over(later), zero).alias("later_docs"),
        F.coalesce(F.sum("span_tokens").over(later), zero).alias("later_tokens"),
        F.sum("span_docs").over(every).alias("total_docs"),
        F.sum("span_tokens").over(every).alias("total_tokens"),
    )
    longer = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    found = hist.join(spans, "span").withColumns(
        {
            "docs_over": F.coalesce(F.sum("docs").over(longer), zero) + F.col("later_docs"),
            "tokens_over": F.coalesce(F.sum("tokens").over(longer), zero) + F.col("later_tokens"),
        }
    )
    upto = F.col("total_tokens") - F.col("tokens_over")
    return found.select(
        "n_tokens", "docs", "tokens", (F.col("total_docs") - F.col("docs_over")).alias("docs_upto"), upto.alias("tokens_upto"),
        "docs_over", "tokens_over", (upto + F.col("n_tokens") * F.col("docs_over")).alias("truncated_total"),
        "total_docs", "total_tokens",
    )


def length_histogram(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """The histogram of encoded lengths of all rows of docs, with its sums; an empty table gives no rows."""
    return with_suffix_sums(encoded_lengths(docs, text_col, tokenizer))


def truncated_total(hist: DataFrame, limit: int) -> DataFrame:
    """One row (tokens): what stays of all documents if each is cut to limit tokens, for any limit."""
    kept = F.least("n_tokens", F.lit(limit)) * F.col("docs")
    return hist.agg(F.coalesce(F.sum(kept), F.lit(0)).alias("tokens"))


def quantile(hist: DataFrame, share: float) -> DataFrame:
    """One row (n_tokens): the smallest length that at least this share of documents does not exceed."""
    return hist.filter(F.col("docs_upto") >= share * F.col("total_docs")).agg(F.min("n_tokens").alias("n_tokens"))
