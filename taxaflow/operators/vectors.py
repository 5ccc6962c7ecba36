"""Similarity of embedding vectors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Candidates of a block and vectors of a group, about: at 512 dimensions a task holds 16 MB of one and 80 MB of the other.
BLOCK, GROUP = 4096, 20_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(a: Column) -> Column:
    """The vector at length one; a zero vector stays."""
    norm = F.sqrt(dot(a, a))
    return F.transform(a, lambda x: x.cast("double") / F.when(norm > 0, norm).otherwise(1.0))


def centroids(df: DataFrame, group: str, vector: str, dims: int) -> DataFrame:
    """Unit vectors of the mean of each group's vectors, by dims partial sums."""
    means = df.groupBy(group).agg(F.array(*[F.avg(F.col(vector)[i].cast("double")) for i in range(dims)]).alias("_mean"))
    return means.select(group, unit(F.col("_mean")).alias("centroid"))


def _matrix(column: pa.ChunkedArray, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a column of lists, and which rows have one: of dims numbers, or of as many as the first has."""
    lists = column.combine_chunks()
    good = np.array([v is not None and (dims is None or len(v) == dims) and None not in v for v in lists.to_pylist()], dtype=bool) if lists.null_count or lists.flatten().null_count else None
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False) if len(lists) else np.zeros(0)
    if dims is None:
        dims = int(lengths[0]) if len(lists) and lengths[0] == lengths[0] else 0
    good = (lengths == dims) if good is None else good & (lengths == dims)
    taken = lists.filter(pa.array(good)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    norms = np.sqrt((taken * taken).sum(axis=1, keepdims=True))
    return taken / np.where(norms > 0, norms, 1.0), good


def _block_scores(vectors: pa.Table, candidates: pa.Table, scale: float, everything: bool) -> dict[str, pa.Array]:
    """Each vector's best candidate of a block, its cosine and the sum of exp(scale * (cosine - best)).

    With everything, a row for each vector and candidate instead. The product of a few thousand vectors with the block
    is held at a time.
    """
    candidates = candidates.sort_by("label")
    matrix, there = _matrix(candidates["vector"])
    labels = candidates["label"].combine_chunks().filter(pa.array(there))
    # equal vectors are one, with the smallest label, so that a tie does not hang on a product's last bit
    rows, first, which, copies = np.unique(matrix, axis=0, return_index=True, return_inverse=True, return_counts=True) if len(matrix) else (matrix, np.zeros(0, int), np.zeros(0, int), np.zeros(0, int))
    order = np.argsort(first)
    rows, first, copies = rows[order], first[order], copies[order]
    place = np.empty(len(order), int)
    place[order] = np.arange(len(order))
    asked, good = _matrix(vectors["vector"], matrix.shape[1])
    keys = vectors["key"].combine_chunks()
    best, value, total, each = [], [], [], []
    step = max(1, (1 << 22) // max(1, len(rows)))
    for at in range(0, len(asked), step):
        scores = asked[at : at + step] @ rows.T
        if everything:
            each.append(scores[:, place[which.reshape(-1)]].reshape(-1))
            continue
        top = scores.argmax(axis=1) if len(rows) else np.zeros(0, int)
        m = scores[np.arange(len(top)), top]
        best.append(first[top])
        value.append(m)
        total.append((np.exp(scale * (scores - m[:, None])) * copies).sum(axis=1))
    if everything:
        n = len(labels)
        known = pa.array(np.repeat(np.flatnonzero(good), n)), pa.array(np.tile(np.arange(n), len(asked)))
        return {"key": keys.take(known[0]), "label": labels.take(known[1]), "score": pa.array(np.concatenate(each) if each else np.zeros(0))}
    if not len(rows):
        good, best, value, total = np.zeros(len(keys), bool), [], [], []
    at_row = np.full(len(keys), -1)
    at_row[good] = np.arange(good.sum())
    where = pa.array(at_row, mask=at_row < 0)
    joined = lambda parts, kind: pa.array(np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)).take(where)
    return {"key": keys, "label": labels.take(joined(best, np.int64)), "score": joined(value, np.float64), "total": joined(total, np.float64)}


def _scored(df: DataFrame, candidates: DataFrame, on: Sequence[str], key: str, vector: str, label: str, candidate: str, scale: float, everything: bool) -> DataFrame:
    """Scores of vectors with the candidates of the same `on`, by blocks: (key, label, score[, total]), a row a block.

    Candidates are dealt to blocks of about BLOCK, and vectors to groups of about GROUP; each group meets each block once.
    """
    of = F.struct(*[F.col(c).alias(c) for c in on]) if on else F.struct(F.lit(0).alias("_all"))
    asks = df.select(of.alias("_of"), F.col(key).alias("key"), F.col(vector).alias("vector"))
    offers = candidates.select(of.alias("_of"), F.col(label).alias("label"), F.col(candidate).alias("vector")).filter("vector IS NOT NULL")
    count = lambda rows, per, name: rows.groupBy("_of").agg(F.ceil(F.count("*") / per).cast("int").alias(name))
    sizes = count(offers, BLOCK, "_blocks").join(count(asks, GROUP, "_groups"), "_of")
    found = lambda rows: rows.join(sizes if on else F.broadcast(sizes), "_of")  # noqa: E731  without on, sizes is one row
    group, block = F.pmod(F.xxhash64("key"), F.col("_groups")), F.pmod(F.xxhash64("label"), F.col("_blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    asked = found(asks).select("_of", "key", "vector", group.cast("long").alias("_group"), every("_blocks").alias("_block"))
    offered = found(offers).select("_of", "label", "vector", block.cast("long").alias("_block"), every("_groups").alias("_group"))
    kinds = {"key": df.schema[key].dataType, "label": candidates.schema[label].dataType, "score": T.DoubleType()} | ({} if everything else {"total": T.DoubleType()})
    schema = T.StructType([T.StructField(n, k) for n, k in kinds.items()])
    wanted = to_arrow_schema(schema)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_pydict(_block_scores(left, right, scale, everything)).cast(wanted)

    keys = ("_of", "_block", "_group")
    return asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(meet, schema)


def softmax_top1(df: DataFrame, candidates: DataFrame, key: str, vector: str, label: str, candidate: str, scale: float = 100.0, on: Sequence[str] = ()) -> DataFrame:
    """(key, label, score, probability): the best candidate of each vector by cosine, and its softmax share.

    With on, a vector is compared with the candidates that agree with it in these columns. Candidates of any number meet
    in blocks, as products of matrices; a vector's blocks are put together by their largest scores and sums. Ties go to
    the smaller label; a zero vector has the score 0 with all. A vector that is null, has nulls or another length than
    the candidates keeps nulls; one without candidates is absent. Keys are unique; candidates without a vector do not count.
    """
    parts = _scored(df, candidates, on, key, vector, label, candidate, scale, False)
    best = F.array_min("_parts")
    top = -best["rank"]
    total = F.aggregate("_parts", F.lit(0.0), lambda t, x: t + x["total"] * F.exp(scale * (-x["rank"] - top)))
    each = F.collect_list(F.when(F.col("score").isNotNull(), F.struct((-F.col("score")).alias("rank"), "label", "total")))  # as many as there are blocks
    return parts.groupBy("key").agg(each.alias("_parts")).select(F.col("key").alias(key), best["label"].alias(label), top.alias("score"), F.try_divide(F.lit(1.0), total).alias("probability"))


def softmax_all(df: DataFrame, candidates: DataFrame, key: str, vector: str, label: str, candidate: str, scale: float = 100.0, on: Sequence[str] = ()) -> DataFrame:
    """(key, label, score, probability) of each vector with each of its candidates: see softmax_top1.

    The result has a row for each pair, so it is for lists of candidates by `on`, such as the species of a site. Vectors
    that have no scores are absent.
    """
    parts = _scored(df, candidates, on, key, vector, label, candidate, scale, True)
    per = Window.partitionBy("key")
    power = F.exp(scale * (F.col("score") - F.max("score").over(per)))
    shares = parts.withColumn("_power", power).withColumn("probability", F.col("_power") / F.sum("_power").over(per))
    return shares.select(F.col("key").alias(key), F.col("label").alias(label), "score", "probability")


def mean_probability(df: DataFrame, group: str, label: str, probability: str) -> DataFrame:
    """(group, label, probability): the label with the largest mean probability over a group's members."""
    means = df.groupBy(group, label).agg(F.avg(probability).alias("probability"))
    nth = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("probability"), label))
    return means.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")
