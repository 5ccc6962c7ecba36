"""Near copies by word shingles: texts meet by SimHash fingerprints, then by rare shingles; their sets' Jaccard similarity decides."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.llm.common import drop_table, input_bytes, materialise, release_memory
from taxaflow.llm.graph import connected_components
from taxaflow.llm.simhash import lowered_words, majority_bits, near_edges, shingle_hashes

#: Texts that hold one shingle and all meet at once; in a larger crowd the members meet one of them first, and then
#: all those that are not yet in one group.
CROWD = 8
#: By how many of its most crowded shingles a text meets one text each at first.
HUBS = 4
#: Groups meet by one text each in rounds, until only FEW pairs for each text and shingle are left to compare, or a round
#: leaves more than LITTLE of them. All that is left then is compared.
FEW, LITTLE = 4, 0.9
#: Of the keys before one in a text's order, so many last and so many drawn ones tell whether a pair shared one of them.
BEFORE = 4
#: One of SAMPLE texts counts for which shingles are common: those met SEEN times, MOST_COMMON at most. They only order.
SAMPLE, SEEN, MOST_COMMON = 8, 3, 100_000
#: A set's sketch has so many numbers of 64 bits: each bit is the parity of the shingles that fall on it. Its wide
#: sketch has two bits a shingle or more, a power of two.
SKETCH = 8
#: Ids go to all tasks if their files have so many bytes at most; beyond, texts are joined to them by a shuffle.
MOST_BROADCAST = 8 << 20


def _set_of(text: str | None, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(lowered_words(text), size))


def parity_sketch(shingles: np.ndarray, bits: int = 64 * SKETCH) -> np.ndarray:
    """A power of two of bits, as bytes. Two sets differ in as many shingles at least as their sketches in bits."""
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def wide_sketch(shingles: np.ndarray) -> bytes:
    return parity_sketch(shingles, max(64, 1 << (2 * len(shingles) - 1).bit_length())).tobytes()


def sketches_differ(x: bytes, y: bytes) -> int:
    """Bits in which two wide sketches differ, the longer one folded to the length of the other."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def prefix(shingles: np.ndarray, least: float, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of an ascending set in the order of all sets: two sets at least similar share one of them.

    A set of n shares least * n or more with such a partner, so it has too few others to fill this prefix. Common
    shingles (ascending, with their ranks from 1) come last.
    """
    take = len(shingles) - math.ceil(least * len(shingles) - 1e-9) + 1
    if len(common) and len(shingles):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        late = np.where(common[at] == shingles, rank[at], 0)
        if late.any():
            shingles = shingles[np.lexsort((shingles, late))]
    return shingles[:take]


def _keyed(size: int, least: float, common: np.ndarray, rank: np.ndarray):  # noqa: ANN202
    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = [np.empty(0, np.uint64)], []
            for text in batch.column(1):
                found = _set_of(text.as_py(), size)
                counts.append(len(found))
                keys.append(prefix(found, least, common, rank))
            spans = [len(k) for k in keys[1:]]
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), spans)
            places = np.concatenate([np.arange(n, dtype=np.int32) for n in [0, *spans]])
            yield pa.record_batch([pa.array(np.concatenate(keys).view(np.int64)), pa.array(ids, pa.int64()), pa.array(np.repeat(np.array(counts, np.int64), spans)), pa.array(places)], names=["key", "id", "n", "i"])
        release_memory()

    return keyed


def _each_shingle(size: int):  # noqa: ANN202
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_set_of(t.as_py(), size) for t in batch.column(1)]
            yield pa.record_batch([pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64))], names=["key"])

    return each


def _sketched(size: int):  # noqa: ANN202
    def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                runs = shingle_hashes(lowered_words(text.as_py()), size)
                found = np.unique(runs)
                rows.append((len(found), majority_bits(runs), parity_sketch(found).view(np.int64), wide_sketch(found)))
            n, fp, bits, wide = zip(*rows, strict=True) if rows else ([], [], [], [])
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(list(bits), pa.list_(pa.int64())), pa.array(wide, pa.binary())]
            yield pa.record_batch(columns, names=["id", "n", "fp", "bits", "wide"])
        release_memory()

    return sketched


def _shingled(size: int):  # noqa: ANN202
    def shingled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_set_of(t.as_py(), size) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "shingles"])
        release_memory()

    return shingled


def _maybe_similar(least: float):  # noqa: ANN202
    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "widea", "wideb")), strict=True)
            near = pa.array([sketches_differ(x, y) <= (n + m) * (1 - least) / (1 + least) + 1e-6 for n, m, x, y in rows], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    return kept


def _common(given: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles of a sample of the texts, ascending, and their ranks by how often they are met, from 1."""
    sampled = given.select("id", "text").filter(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0)
    counted = sampled.mapInArrow(_each_shingle(size), "key long").groupBy("key").agg(F.count("*").alias("k")).filter(F.col("k") >= SEEN)
    keys = counted.orderBy(F.desc("k"), "key").limit(MOST_COMMON).select("key").toArrow()["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], len(keys) - order


def _sizes_fit(x: str, y: str, least: float) -> F.Column:
    return F.least(x, y) >= least * F.greatest(x, y) - 1e-9


def _largest(n: str, i: str, least: float) -> F.Column:
    """The most shingles of a similar set, of a set of n whose first shingle in common with it is at place i of its order."""
    return (F.col(n) - F.col(i)) * ((1 + least) / least) - F.col(n) + 1e-6


def _places_fit(least: float) -> F.Column:
    """Whether sets (na, nb) can be similar if the shingle at their places (ia, ib) is the first in common.

    What comes before it is in one of them alone. Similar sets pass at their first shingle in common; at a later one they
    need not, and other sets fail there the more, the more rare shingles they have.
    """
    return (F.col("nb") <= _largest("na", "ia", least)) & (F.col("na") <= _largest("nb", "ib", least))


def _bits_fit(x: str, y: str, n: F.Column, least: float) -> F.Column:
    """Whether the sketches leave it possible that sets of n shingles together are similar."""
    differ = sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(SKETCH)), F.lit(0))
    return differ <= n * ((1 - least) / (1 + least)) + 1e-6


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _of(given: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts whose ids are met."""
    met = materialise(ids.distinct(), "met")
    return given.join(F.broadcast(met) if input_bytes(met) <= MOST_BROADCAST else met, "id", "left_semi")


def _links(given: DataFrame, sketches: DataFrame, pairs: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs whose texts' sets of shingles are similar. Only sets that the sketches do not tell apart are moved."""
    pairs = materialise(_ordered(pairs), "candidates")
    sides = [sketches.select(F.col("id").alias(i), F.col("n").alias(f"n{i}"), F.col("bits").alias(f"bits{i}"), F.col("wide").alias(f"wide{i}")) for i in "ab"]
    near = pairs.join(sides[0], "a").join(sides[1], "b").filter(_sizes_fit("na", "nb", least) & _bits_fit("bitsa", "bitsb", F.col("na") + F.col("nb"), least))
    near = materialise(near.select("a", "b", "na", "nb", "widea", "wideb").mapInArrow(_maybe_similar(least), "a long, b long"), "near")
    ends = near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id")))
    sets = materialise(_of(given, ends).mapInArrow(_shingled(size), "id long, shingles array<long>"), "shingles")
    both = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    linked = materialise(both.filter(shared >= least * (F.size("x") + F.size("y") - shared)).select("a", "b").distinct(), "links")
    for done in (pairs, near, sets):
        drop_table(done)
    return linked


def _fingerprint_pairs(sketches: DataFrame) -> DataFrame:
    """Texts whose SimHash fingerprints are equal or met by multi-index hashing, each fingerprint by its smallest id."""
    classes = materialise(sketches.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    same = sketches.join(classes, "fp").select(F.col("id").alias("a"), F.col("least").alias("b"))
    ends = [classes.select(F.col("fp").alias(i), F.col("least").alias(f"id{i}")) for i in "ab"]
    met = near_edges(classes.select("fp")).join(ends[0], "a").join(ends[1], "b")
    return same.unionByName(met.select(F.col("ida").alias("a"), F.col("idb").alias("b")))


def _open(crowd: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (key, id, n, i) with the root of the group that their id is in so far, of keys whose texts are not all in one group."""
    rooted = crowd.select("key", "id", "n", "i").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r <> s").select("key")
    return rooted.join(mixed, "key", "left_semi")


def _first_meetings(crowd: DataFrame, least: float) -> DataFrame:
    """Pairs of a text and one of each of its HUBS most crowded keys."""
    most = Window.partitionBy("id").orderBy(F.desc("k"), "key", "n")
    first = materialise(crowd.withColumn("of", F.row_number().over(most)).filter(F.col("of") <= HUBS).select("key", "id", "n"), "crowds")
    hubs = first.groupBy("key").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id", "n")).alias("hub"))
    return first.join(hubs, "key").filter(_sizes_fit("n", "hub.n", least)).select(F.col("id").alias("a"), F.col("hub.id").alias("b"))


def _group_meetings(left: DataFrame, seed: int, least: float) -> DataFrame:
    """Pairs of one text of each group that has a key, and one of the largest such group and of another, drawn by seed."""
    h = F.xxhash64("id", "key", F.lit(seed))
    groups = left.groupBy("key", "root").agg(F.min(F.struct(h.alias("h"), "id", "n")).alias("x"), F.count("*").alias("members"))
    groups = materialise(groups.select("key", "root", "members", "x.*"), "groups")
    one = F.struct("members", "h", "id", "n", "root")
    hubs = groups.groupBy("key").agg(F.max(one).alias("most"), F.min(F.struct("h", "id", "n", "root")).alias("any"))
    met = groups.join(hubs, "key")
    sides = [met.filter((F.col("root") != F.col(f"{hub}.root")) & _sizes_fit("n", f"{hub}.n", least)).select(F.col("id").alias("a"), F.col(f"{hub}.id").alias("b")) for hub in ("most", "any")]
    return sides[0].unionByName(sides[1])


def _left_over(left: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """All pairs of texts of different groups that share a key, but for those that the key's places or sketches exclude.

    A pair is left out at a key if some of the keys that come BEFORE it are seen to be shared: it is not the first then.
    """
    text = Window.partitionBy("id", "n")
    before = text.orderBy("i", "key").rowsBetween(Window.unboundedPreceding, -1)
    last = F.collect_list("key").over(text.orderBy("i", "key").rowsBetween(-BEFORE, -1))
    drawn = [F.min_by("key", F.xxhash64("key", F.lit(s))).over(before) for s in range(BEFORE)]
    ordered = left.select("*", F.concat(last, F.array_compact(F.array(*drawn))).alias("before"))
    # where texts that repeat an id have sets of one size, their keys are not told apart
    texts = sketches.select("id", "n", "bits", F.count("*").over(text).alias("texts"))
    sketched = ordered.join(texts, ["id", "n"]).withColumn("before", F.when(F.col("texts") == 1, F.col("before")).otherwise(F.array().cast("array<long>")))
    x, y = (sketched.select("key", *(F.col(c).alias(f"{c}{i}") for c in ("id", "n", "i", "root", "bits", "before"))) for i in "ab")
    may = _places_fit(least) & _bits_fit("bitsa", "bitsb", F.col("na") + F.col("nb"), least) & ~F.arrays_overlap("beforea", "beforeb")
    return x.join(y, "key").filter(F.col("roota") < F.col("rootb")).filter(may).select(F.col("ida").alias("a"), F.col("idb").alias("b"))


def links(given: DataFrame, size: int, least: float) -> DataFrame:
    """Similar pairs (a, b) of given (id, text): what they connect is what all similar pairs connect.

    Texts meet by SimHash fingerprints first, and by the shingles of their prefixes, which miss no similar pair. A text
    leaves a shingle at which its place and all others' exclude that it is the first in common with a similar one.
    Where more than CROWD share a shingle, members meet one of them, then groups that links have joined meet by
    one text each, as long as such rounds join many groups. At last all pairs of different groups are compared.
    Pairs inside a group join nothing and are left out.
    """
    keyed = given.mapInArrow(_keyed(size, least, *_common(given, size)), "key long, id long, n long, i int")
    all_of, largest = Window.partitionBy("key"), _largest("n", "i", least)
    met = keyed.select("*", F.count("*").over(all_of).alias("k"), F.min("n").over(all_of).alias("low"), F.max(largest).over(all_of).alias("high"))
    shared = materialise(met.filter((F.col("k") > 1) & (F.col("low") <= largest) & (F.col("n") <= F.col("high"))).drop("low", "high"), "prefixes")
    sketches = materialise(_of(given, shared.select("id")).mapInArrow(_sketched(size), "id long, n long, fp long, bits array<long>, wide binary"), "sketches")
    sparse, crowd = shared.filter(F.col("k") <= CROWD), shared.filter(F.col("k") > CROWD)
    x, y = (sparse.select("key", F.col("id").alias(i), F.col("n").alias(f"n{i}"), F.col("i").alias(f"i{i}")) for i in "ab")
    pairs = x.join(y, "key").filter("a < b").filter(_places_fit(least)).select("a", "b")
    pairs = pairs.unionByName(_fingerprint_pairs(sketches)).unionByName(_first_meetings(crowd, least))
    found = _links(given, sketches, pairs, size, least)
    before = math.inf
    for seed in itertools.count():
        left = materialise(_open(crowd, materialise(connected_components(found), "roots")), "open")
        sizes = left.groupBy("key", "root").agg(F.count("*").alias("m")).groupBy("key").agg(F.sum("m").alias("s"), F.sum(F.col("m") * F.col("m")).alias("q"))
        rows, apart = sizes.agg(F.sum("s"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()
        if not rows:
            return found
        if apart <= FEW * rows or apart > LITTLE * before:
            return found.unionByName(_links(given, sketches, _left_over(left, sketches, least), size, least))
        before = apart
        found = found.unionByName(_links(given, sketches, _group_meetings(left, seed, least), size, least))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, least: float = 0.8) -> DataFrame:
    """(id, group_id) of every id that has a near copy: the smallest id reachable over links.

    A link joins two texts whose sets of size-word shingles have a Jaccard similarity of least or more, computed
    from the sets. No link that would join two groups is missed.
    Ids without a near copy, rows with a null id and texts without words are in no group; a null text has no
    words. Rows that repeat an id count as one document. An empty table gives no rows.
    """
    given = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return connected_components(links(given, size, least)).select(F.col("node").alias("id"), F.col("root").alias("group_id"))
