"""SimHash fingerprints and near-duplicate groups by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import drop_table, materialise
from taxaflow.llm.graph import connected_components

#: Words of a text are hashed in blocks of so many, which bounds memory for texts of any length.
BLOCK = 1 << 15
#: Distinct fingerprints of one segment value that are compared one by one; larger groups go the other way.
CROWD = 64


def lowered_words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of size words, in order; a shorter text is one run, an empty one has none."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    runs = zip(*(words[i:] for i in range(size)), strict=False) if size > 1 else zip(words, strict=True)
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(seed)), np.uint64, n - size + 1)


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for start in range(0, len(hashes), BLOCK):
        part = np.ascontiguousarray(hashes[start : start + BLOCK], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def simhash64(text: str | None, size: int = 3) -> int:
    """Fingerprint of a text; zero for a text without words."""
    words = lowered_words(text)
    if len(words) <= BLOCK:
        return majority_bits(shingle_hashes(words, size))
    steps = range(0, len(words) - size + 1, BLOCK)
    return majority_bits(np.concatenate([shingle_hashes(words[i : i + BLOCK + size - 1], size) for i in steps]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp long) of every row of docs, repeated rows included; a null text is an empty one.

    Only the two columns named are read, so others may carry any name.
    """
    kind = docs.schema[id_col].dataType

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((simhash64(t.as_py(), size) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(hashed, f"id {kind.simpleString()}, fp long")


def _segments(fps: DataFrame) -> DataFrame:
    """Two rows a fingerprint: key is the segment's number above its 32 bits."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32).bitwiseOR(F.lit(1 << 32))
    return fps.select("fp", F.explode(F.array(low, high)).alias("key"))


def _upward_ball(key: F.Column) -> F.Column:
    """The key, and it with any one zero bit of its 32 set: of two keys one bit apart, one reaches the other."""
    flips = F.array(*[F.lit(1 << i).cast("long") for i in range(32)])
    raised = F.transform(F.filter(flips, lambda m: key.bitwiseAND(m) == 0), lambda m: key.bitwiseOR(m))
    return F.concat(F.array(key), raised)


def near_edges(fps: DataFrame) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints (fp) at 2 or fewer differing bits, directly or in a chain.

    Two fingerprints at distance 2 or less agree in one of their two 32-bit segments but for one bit at most.
    Each fingerprint looks up the small Hamming ball around its segments in the segment tables, and the full
    distance of each match is verified. A segment value that over CROWD distinct fingerprints hold is not
    compared one by one: all fingerprints that hold it or reach it meet at the 65 numbers within one bit of
    them. Fingerprints that share such a number are within 2 bits of each other, at most 65 share one, and
    any two within 2 bits share one, so this loses no link and needs work in proportion to their count.
    """
    held = materialise(_segments(fps), "segments")
    crowds = materialise(held.groupBy("key").count().filter(F.col("count") > CROWD).select("key"), "crowds")
    reach = held.select(F.col("fp").alias("a"), F.explode(_upward_ball(F.col("key"))).alias("key"))
    crowded = not crowds.isEmpty()
    sparse = held.join(crowds, "key", "left_anti") if crowded else held
    direct = (
        reach.join(sparse.select(F.col("fp").alias("b"), "key"), "key")
        .filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    if not crowded:
        return direct
    met = reach.join(crowds, "key", "left_semi").select(F.col("a").alias("fp")).distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(v - (1 << 64) if v >> 63 else v) for v in (1 << i for i in range(64))])
    points = met.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    shared = points.groupBy("point").agg(F.collect_set("fp").alias("near")).filter(F.size("near") > 1)
    chained = shared.select(F.array_min("near").alias("a"), F.explode("near").alias("b")).filter("a <> b")
    return direct.unionByName(chained)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp long, group_id) of every row: group_id is the smallest id reachable over links of 2 bits or fewer.

    A row with a null id has a group too; only a group without any other id has a null group_id. Texts without
    words have fingerprint 0 and are linked like others. Empty tables give no rows.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = materialise(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "classes")
    edges = materialise(near_edges(classes.select("fp")).distinct(), "links")
    roots = connected_components(edges).withColumnRenamed("node", "fp")
    joined = classes.select("fp", "least").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("group_id"))
    labelled = materialise(joined.join(smallest, "root").select("fp", "group_id"), "labels")
    drop_table(edges)
    return rows.join(labelled, "fp").select("id", "fp", "group_id")
