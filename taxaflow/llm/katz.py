"""Katz backoff bigram model: partitioned tables of packed columns, scored per document."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import bucket_count, drop_table, materialise, release_memory
from taxaflow.llm.simhash import lowered_words

#: Counts above K are not discounted.
K = 5
#: Words and bigrams that are this part of all tokens or more: at most so many of each, whatever the input's size. Their
#: counts and values go to all tasks, so that no bucket gathers a common word's histories or a common history's words.
HOTTEST = 1 << 16
#: A task's documents are handled in chunks of about so many tokens, and at most so many documents.
CHUNK_TOKENS, CHUNK_DOCS = 400_000, 60_000
#: Buckets of histories are modelled, and documents scored, in so many turns, each in one of them: what one turn sends is
#: on disk at a time.
TURNS = 3
#: A partition of bigrams is made of about so many training tokens, as they were counted; a table has so many partitions
#: at most. So what a task sorts does not grow with the input where the setting of shuffle partitions stays.
IN_PARTITION, MOST_PARTITIONS = 1_000_000, 1 << 15
#: The model's tables are kept with this codec: it needs no buffers outside the heap, and less disk.
CODEC = "zstd"
#: White space is in no word, so these two are no words.
START, END = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b" start", b" end"))
U8, U4 = np.dtype("<u8"), np.dtype("<u4")


class WordHashes(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def pair_key(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    mixed = history * U8.type(0x9E3779B97F4A7C15) + (word ^ (word >> U8.type(29))) * U8.type(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> U8.type(32)
    return mixed * U8.type(0x94D049BB133111EB)


def word_buckets(buckets: int) -> int:
    """Words are fewer than bigrams, and need fewer buckets."""
    return max(1, buckets // 3)


def _by_bucket(rows: DataFrame, tokens: int, *keys: str) -> DataFrame:
    """rows with all of a bucket in one partition; never fewer partitions than the session's setting."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, min(MOST_PARTITIONS, -(-tokens // IN_PARTITION))), *keys)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of keys, so that a sorted array falls into slices."""
    return (((keys >> U8.type(32)) * U8.type(buckets)) >> U8.type(32)).astype(np.int64)


def planes(numbers: np.ndarray) -> bytes:
    """The eight bytes of each number apart: those of small numbers are zeros, which shuffles and tables compress."""
    return np.ascontiguousarray(numbers.astype(U8).view(np.uint8).reshape(-1, 8).T).tobytes()


def of_planes(blob: bytes) -> np.ndarray:
    bytes_of = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(bytes_of.T).view(U8)[:, 0] if bytes_of.size else np.empty(0, U8)


def packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers as planes of their differences."""
    return planes(np.diff(numbers, prepend=U8.type(0)))


def unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(of_planes(blob), dtype=U8)


def slices(sorted_keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    of = bucket_of(sorted_keys, buckets)
    cuts = np.flatnonzero(np.diff(of)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(of)], strict=True):
        if b > a:
            yield int(of[a]), slice(a, b)


@dataclass
class Chunk:
    """Token hashes of some documents: each begins with START and finishes with END."""

    tokens: np.ndarray
    doc: np.ndarray  # number in the chunk of each token's document
    ids: list
    lengths: list[int]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """History, word and document of each predicted token."""
        inner = self.tokens[1:] != START
        return self.tokens[:-1][inner], self.tokens[1:][inner], self.doc[1:][inner]


def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[Chunk]:
    hashes, held, ids, lengths, size = WordHashes(), [], [], [], 0
    start, end = int(START), int(END)

    def done() -> Chunk:
        doc = np.repeat(np.arange(len(lengths), dtype=U4), np.array(lengths, np.int64) + 1)
        return Chunk(np.concatenate(held), doc, ids, lengths)

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            words = lowered_words(text.as_py())
            held.append(np.fromiter([start, *map(hashes.__getitem__, words), end], U8, len(words) + 2))
            ids.append(doc_id.as_py())
            lengths.append(len(words) + 1)
            size += len(words) + 1
            if size >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCS:
                yield done()
                held, ids, lengths, size = [], [], [], 0
                if len(hashes) > 100_000:
                    hashes.clear()
    if ids:
        yield done()


def _summed(order: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal neighbours of sorted columns as one, with the sum of their counts."""
    if not len(counts):
        return order, counts
    new = np.append(True, np.logical_or.reduce([np.diff(c) != 0 for c in order]))
    firsts = np.flatnonzero(new)
    return [c[firsts] for c in order], np.add.reduceat(counts, firsts)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


COUNTS = pa.schema([("bucket", pa.int64()), ("h", pa.binary()), ("w", pa.binary()), ("n", pa.binary())])
COUNTS_DDL = "bucket long, h binary, w binary, n binary"
MERGED = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("h", pa.binary()), ("w", pa.binary()), ("n", pa.binary()), ("c", pa.binary()), ("sums", pa.list_(pa.int64()))])
MERGED_DDL = "kind int, bucket long, h binary, w binary, n binary, c binary, sums array<long>"
MODEL = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("keys", pa.binary()), ("value", pa.binary()), ("c", pa.binary())])
MODEL_DDL = "kind int, bucket long, keys binary, value binary, c binary"
ASKED = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("uses", pa.binary()), ("doc", pa.binary()), ("n", pa.binary())])
ASKED_DDL = "kind int, bucket long, chunk long, keys binary, uses binary, doc binary, n binary"
PAIR, WORD, OTHER, HOT = 0, 1, 2, 3


def _buffers(table: pa.Table, name: str) -> list:
    """The rows of a binary column without a copy; null is empty."""
    return [x.as_buffer() or b"" if x.is_valid else b"" for x in table[name]]


def _unpacked(table: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([np.empty(0, U8), *map(unpacked, _buffers(table, name))])


def _planed(table: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([np.empty(0, U8), *map(of_planes, _buffers(table, name))])


def _joined(table: pa.Table, name: str, kind: np.dtype) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *(np.frombuffer(x, kind) for x in _buffers(table, name))])


def _is_in(keys: np.ndarray, ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in an ascending array, and whether they are in it."""
    if not len(ascending):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(ascending, keys), len(ascending) - 1)
    return at, ascending[at] == keys


def _dealt(keys: np.ndarray, pairs: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """The buckets of bigrams by their word or history; those of the hot ones by the whole bigram."""
    of = bucket_of(keys, buckets)
    many = _is_in(keys, hot)[1]
    of[many] = bucket_of(pairs[many], buckets)
    return of


def _runs(of: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The slices of an ascending array with one value each."""
    cuts = np.flatnonzero(np.diff(of)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(of)], strict=True):
        if b > a:
            yield int(of[a]), slice(a, b)


def _words_counted(buckets: int):  # noqa: ANN202
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            w, n = np.unique(chunk.tokens[chunk.tokens != START], return_counts=True)
            n = n.astype(U8)
            yield _batch([(b, None, packed(w[s]), planes(n[s])) for b, s in slices(w, buckets)], COUNTS)
            release_memory()

    return counted


def _merge_words(key: tuple, rows: pa.Table) -> pa.Table:
    """All counts of a bucket of words."""
    w, n = _unpacked(rows, "w"), _planed(rows, "n")
    order = np.argsort(w, kind="stable")
    (w,), n = _summed([w[order]], n[order])
    out = [(WORD, key[0].as_py(), None, packed(w), None, planes(n), None), (OTHER, -1, None, None, None, None, [int(n.sum()), len(w), *_classes(n)])]
    return pa.Table.from_batches([_batch(out, MERGED)])


def _common_words(total: int):  # noqa: ANN202
    def common(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, c = _unpacked(batch, "w"), _planed(batch, "c")
            many = c * U8.type(HOTTEST) >= U8.type(total)
            yield pa.record_batch([pa.array(w[many].view(np.int64)), pa.array(c[many].astype(np.int64))], names=["w", "c"])

    return common


def _pairs_counted(buckets: int, hot: np.ndarray):  # noqa: ANN202
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            h, w, _ = chunk.pairs()
            order = np.lexsort((h, w))
            (w, h), n = _summed([w[order], h[order]], np.ones(len(h), U8))
            of = _dealt(w, pair_key(h, w), hot, buckets)
            order = np.argsort(of, kind="stable")
            h, w, n, of = h[order], w[order], n[order].astype(U8), of[order]
            yield _batch([(b, h[s].tobytes(), packed(w[s]), planes(n[s])) for b, s in _runs(of)], COUNTS)
            del h, w, n, order, of
            release_memory()

    return counted


def _classes(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, K + 2).astype(np.int64), minlength=K + 3)[1 : K + 2].tolist()


def _merge_pairs(buckets: int, k: Constants, hot: np.ndarray, hot_counts: np.ndarray):  # noqa: ANN202
    """All counts of a bucket of bigrams, with those of their words: they go on by the bucket of the history.

    For hot histories, whose bigrams are in many buckets, also what their backoff weights are made of: how many
    bigrams have each count up to K, the sum of higher counts, and the sum of the words' own probabilities.
    """
    common = np.sort(np.append(hot, START))

    def merged(key: tuple, rows: pa.Table) -> pa.Table:
        h, n, w = _joined(rows, "h", U8), _planed(rows, "n"), _unpacked(rows, "w")
        order = np.lexsort((h, w))
        (w, h), n = _summed([w[order], h[order]], n[order])
        words, total = _summed([w], n)
        c = np.repeat(total, np.diff(np.append(np.searchsorted(w, words[0]), len(w))))
        at, many = _is_in(w, hot)
        c[many] = hot_counts[at[many]]
        out = [(OTHER, -1, None, None, None, None, _classes(n))]
        at, many = _is_in(h, common)
        if many.any():
            at, seen = at[many], n[many]
            parts = np.zeros((len(common), K + 1), np.int64)
            np.add.at(parts, (at, np.where(seen > K, K, seen - 1).astype(np.int64)), np.where(seen > K, seen, 1).astype(np.int64))
            lower = np.bincount(at, k.word_probability(c[many]), len(common))
            some = np.flatnonzero(parts.any(1))
            out.append((HOT, -1, common[some].tobytes(), parts[some].tobytes(), lower[some].astype("<f8").tobytes(), None, None))
        of = _dealt(h, pair_key(h, w), common, buckets)
        order = np.lexsort((w, h, of))
        h, w, n, c, of = h[order], w[order], n[order], c[order], of[order]
        out += [(PAIR, b, packed(h[s]), w[s].tobytes(), planes(n[s]), planes(c[s]), None) for b, s in _runs(of)]
        release_memory()
        return pa.Table.from_batches([_batch(out, MERGED)])

    return merged


def _history_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, parts, lower = _joined(batch, "h", U8), _joined(batch, "w", np.dtype("<i8")).reshape(-1, K + 1), _joined(batch, "n", np.dtype("<f8"))
        yield pa.record_batch([pa.array(h.view(np.int64)), *(pa.array(np.ascontiguousarray(x)) for x in parts.T), pa.array(lower)], names=["h", *(f"r{i}" for i in range(K + 1)), "lower"])


def discounts(classes: list[int]) -> np.ndarray:
    """Factor of each count from 0 to K by Katz's use of Good-Turing; classes: how many have counts 1 to K + 1.

    The counts of counts are smoothed by a line through their logarithms, as in simple Good-Turing. Where the line
    falls more steeply than 1 / r, all factors are between 0 and 1; else, as for a few texts or for less than two
    counts that are met, Good-Turing has no estimate and counts are discounted by a half.
    """
    r = np.arange(1, K + 2)
    n = np.array(classes[: K + 1], float)
    met = n > 0
    slope = np.polyfit(np.log(r[met]), np.log(n[met]), 1)[0] if met.sum() > 1 else 0.0
    r = r[:K]
    if slope >= -1:
        return np.append(1.0, (r - 0.5) / r)
    rest = (K + 1.0) ** (slope + 1)
    return np.append(1.0, ((1 + 1 / r) ** (slope + 1) - rest) / (1 - rest))


@dataclass
class Constants:
    """What all tasks need of the training counts: totals, discounts and the share of unknown words."""

    total: int
    words: int
    word_factors: np.ndarray
    pair_factors: np.ndarray
    unknown: float
    scale: float
    docs: int

    @staticmethod
    def of(sums: list[int], docs: int) -> Constants:
        total, words = sums[:2]
        single, pair = sums[2 : K + 3], sums[K + 3 :]
        factors = discounts(single)
        kept = 1 - sum((1 - factors[r]) * r * single[r - 1] for r in range(1, K + 1)) / total if total else 0.0
        if total and kept > 1 - 1e-12:  # no word is rare: all words give up one part in total + 1
            return Constants(total, words, factors, discounts(pair), 1 / (total + 1), total / (total + 1), docs)
        return Constants(total, words, factors, discounts(pair), 1 - kept, 1.0, docs)

    def word_probability(self, count: np.ndarray) -> np.ndarray:
        return self.scale * self.word_factors[(count * (count <= K)).astype(np.int64)] * count / max(self.total, 1)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.total + 0.5 * (self.words + 1)))


@dataclass
class Histories:
    """Histories, ascending, with how often they are met, what their bigrams' shares are scaled by and their backoff weights."""

    keys: np.ndarray
    times: np.ndarray
    scale: np.ndarray
    alpha: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, times: np.ndarray, high: np.ndarray, lower: np.ndarray) -> Histories:
        """high: sums of the bigrams' discounted shares; where all is taken, one part in times + 1 is given up."""
        scale = np.where(1 - high < 1e-12, times / (times + 1), 1.0)
        return Histories(keys, times, scale, (1 - high * scale) / (1 - lower))


def _modelled(k: Constants, buckets: int, hot: Histories):  # noqa: ANN202
    """A bucket of histories: discounted bigrams, and the backoff weight that makes each history sum to one."""

    def modelled(key: tuple, rows: pa.Table) -> pa.Table:
        kinds = rows["kind"].to_numpy()
        pairs, singles = rows.filter(pa.array(kinds == PAIR)), rows.filter(pa.array(kinds == WORD))
        h, w = _unpacked(pairs, "h"), _joined(pairs, "w", U8)
        n, c = _planed(pairs, "n"), _planed(pairs, "c")
        words, counts = _unpacked(singles, "w"), _planed(singles, "c")
        order = np.lexsort((w, h))
        h, w, n, c = h[order], w[order], n[order], c[order]
        found, rows_out = None, []
        if len(h):
            firsts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            spans = np.diff(np.append(firsts, len(h)))
            lower = k.word_probability(c)
            share = k.pair_factors[(n * (n <= K)).astype(np.int64)] * n
            at, known = _is_in(h[firsts], words)
            times = np.where(known, counts[at] if len(words) else 1, 1).astype(float)
            high = np.minimum(np.add.reduceat(share, firsts) / times, 1.0)
            found = Histories.of(h[firsts], times, high, np.minimum(np.add.reduceat(lower, firsts), 1 - 1e-15))
            at, many = _is_in(found.keys, hot.keys)  # of these, this bucket has a part alone
            for mine, whole in ((found.times, hot.times), (found.scale, hot.scale), (found.alpha, hot.alpha)):
                mine[many] = whole[at[many]]
            high = share * np.repeat(found.scale / found.times, spans)
            value = (np.log10(high) - np.log10(lower) - np.log10(np.repeat(found.alpha, spans))).astype("<f8")
            keys = pair_key(h, w)
            order = np.argsort(keys, kind="stable")
            keys, value, n = keys[order], value[order], n[order]
            rows_out += [(PAIR, b, packed(keys[s]), value[s].tobytes(), None) for b, s in slices(keys, buckets)]
            if (many := n * U8.type(HOTTEST) >= U8.type(k.total)).any():
                rows_out.append((HOT, -1, packed(keys[many]), value[many].tobytes(), None))
        if len(words):
            value = np.log10(k.word_probability(counts))
            for known in (found, hot):
                if known is not None and len(known.keys):
                    at, met = _is_in(words, known.keys)
                    alone = met if known is hot else met & ~_is_in(words, hot.keys)[1]
                    value[alone] += np.log10(known.alpha[at[alone]])
            rows_out += [(WORD, b, packed(words[s]), value[s].astype("<f8").tobytes(), counts[s].tobytes()) for b, s in slices(words, word_buckets(buckets))]
        release_memory()
        return pa.Table.from_batches([_batch(rows_out, MODEL)])

    return modelled


@dataclass
class Known:
    """Keys, ascending, their values, and the counts of words."""

    keys: np.ndarray
    value: np.ndarray
    counts: np.ndarray


@dataclass
class KatzModel:
    """A trained model. tables: packed columns partitioned by the bucket of their keys.

    kind 0: keys of bigrams, and the log10 of how much likelier they are than by backing off. kind 1: hashes of
    words, the log10 of their probability times their own backoff weight as a history, and their counts. The hottest
    of both, HOTTEST at most, also stand in pairs and words.
    """

    tables: DataFrame
    constants: Constants
    start: float
    buckets: int
    pairs: Known
    words: Known


def _total(rows: DataFrame, width: int) -> list[int]:
    """Sums over the lists of numbers in the rows of kind OTHER."""
    sums = rows.filter(F.col("kind") == OTHER).select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s"))
    found = {r["pos"]: r["s"] for r in sums.collect()}  # width rows at most
    return [found.get(i, 0) for i in range(width)]


def fit(docs: DataFrame, text_col: str = "text", buckets: int | None = None) -> KatzModel:
    """Learn from all rows of docs, whole texts, a null text as an empty one; rows that repeat are learned as often.

    Tasks count their documents' words, hashed, by the bucket of the word; these totals say which words are hot. Then
    they count bigrams and send them by the bucket of the word, where their counts are complete, and on by the bucket
    of the history, where each history's backoff weight is (1 - its discounted bigrams) / (1 - the same words' unigram
    probabilities). A hot word's or history's bigrams are dealt by the whole bigram, and sums of their parts give
    the weight. So a bucket's memory follows the distinct bigrams in it, and the number of buckets follows the input.
    An empty table gives a model in which every text has the score 0.
    """
    given = docs.select(F.lit(0).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    buckets = buckets or bucket_count(docs, 2.5)
    sent = given.mapInArrow(_words_counted(buckets), COUNTS_DDL)
    words = materialise(sent.groupBy("bucket").applyInArrow(_merge_words, MERGED_DDL), "words", CODEC)
    singles = _total(words, K + 3)
    n_docs, total = docs.count(), singles[0]
    k = Constants.of([*singles, *[0] * (K + 1)], n_docs)
    of_words = words.filter(F.col("kind") == WORD)
    common = of_words.select("w", "c").mapInArrow(_common_words(total), "w long, c long").toArrow()  # HOTTEST rows at most
    hot, counts = common["w"].to_numpy().view(U8), common["c"].to_numpy().astype(U8)
    order = np.argsort(hot)
    hot, counts = hot[order], counts[order]

    sent = _by_bucket(given.mapInArrow(_pairs_counted(buckets, hot), COUNTS_DDL), total, "bucket")
    merged = materialise(sent.groupBy("bucket").applyInArrow(_merge_pairs(buckets, k, hot, counts), MERGED_DDL), "ngrams", CODEC)
    k = Constants.of([*singles, *_total(merged, K + 1)], n_docs)
    ddl = f"h long, {', '.join(f'r{i} long' for i in range(K + 1))}, lower double"
    parts = merged.filter(F.col("kind") == HOT).mapInArrow(_history_parts, ddl).groupBy("h").agg(*(F.sum(c).alias(c) for c in [*(f"r{i}" for i in range(K + 1)), "lower"]))
    parts = parts.toArrow()  # a row for each hot word and the start
    keys = parts["h"].to_numpy().view(U8)
    order = np.argsort(keys)
    seen = np.array([parts[f"r{i}"].to_numpy() for i in range(K + 1)], float).reshape(K + 1, -1)[:, order]
    keys = keys[order]
    at, known = _is_in(keys, hot)
    times = np.where(known, counts[at] if len(hot) else 1, max(n_docs, 1)).astype(float)  # START stands before each document
    high = np.minimum((np.append(k.pair_factors[1:] * np.arange(1, K + 1), 1.0) @ seen) / times, 1.0)
    histories = Histories.of(keys, times, high, np.minimum(parts["lower"].to_numpy()[order], 1 - 1e-15))

    split = merged.filter(F.col("kind") == PAIR).unionByName(of_words).drop("sums")
    turns = (_by_bucket(split.filter(F.pmod("bucket", F.lit(TURNS)) == turn), total // TURNS, "bucket") for turn in range(TURNS))
    tables = reduce(DataFrame.unionByName, (materialise(t.groupBy("bucket").applyInArrow(_modelled(k, buckets, histories), MODEL_DDL), "katz", CODEC) for t in turns))
    drop_table(merged)
    drop_table(words)
    rows = tables.filter(F.col("kind") == HOT).select("keys", "value").toArrow()  # HOTTEST bigrams at most
    keys, value = _unpacked(rows, "keys"), _joined(rows, "value", np.dtype("<f8"))
    order = np.argsort(keys)
    pairs = Known(keys[order], value[order], np.empty(0, U8))
    value = np.log10(k.word_probability(counts)) if len(hot) else np.empty(0)
    at, known = _is_in(hot, histories.keys)
    value[known] += np.log10(histories.alpha[at[known]])
    at, begun = _is_in(np.array([START]), histories.keys)
    start = float(np.log10(histories.alpha[at[0]])) if begun[0] else 0.0
    return KatzModel(tables, k, start, buckets, pairs, Known(hot, value, counts))


def _grouped(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, how many documents use each, these documents, and how often each does. doc ascends."""
    order = np.argsort(keys, kind="stable")
    (keys, doc), n = _summed([keys[order], doc[order]], np.ones(len(keys), U4))
    (distinct,), uses = _summed([keys], np.ones(len(keys), U4))
    return distinct, uses, doc, n


def _asked(model_buckets: int, k: Constants, hot_pairs: Known, hot_words: Known):  # noqa: ANN202
    def asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in enumerate(chunks(batches)):
            name = (TaskContext.get().partitionId() << 24) | number
            h, w, doc = chunk.pairs()
            own = np.zeros((3, len(chunk.ids)))  # score, base and known words by what all tasks hold
            for kind, keys, hot in ((PAIR, pair_key(h, w), hot_pairs), (WORD, w, hot_words)):
                at, many = _is_in(keys, hot.keys)
                own[0] += np.bincount(doc[many], hot.value[at[many]], len(chunk.ids))
                if kind == WORD:
                    own[1] += np.bincount(doc[many], k.base(hot.counts[at[many]]), len(chunk.ids))
                    own[2] += np.bincount(doc[many], minlength=len(chunk.ids))
                distinct, uses, docs, n = _grouped(keys[~many], doc[~many])
                ends = np.append(0, np.cumsum(uses, dtype=np.int64))
                rows = []
                for b, s in slices(distinct, model_buckets if kind == PAIR else word_buckets(model_buckets)):
                    of = slice(ends[s.start], ends[s.stop])
                    rows.append((kind, b, name, packed(distinct[s]), uses[s].astype(U4).tobytes(), docs[of].astype("<u2").tobytes(), n[of].astype(U4).tobytes()))
                yield _batch(rows, ASKED)
                del distinct, uses, docs, n, ends, rows, at, many, keys
            del h, w, doc
            release_memory()
            known = np.array([i is not None for i in chunk.ids])
            ids = np.array([i or 0 for i in chunk.ids], "<i8")
            yield _batch([(OTHER, name, name, ids.tobytes(), known.tobytes(), own.astype("<f8").tobytes(), np.array(chunk.lengths, U4).tobytes())], ASKED)

    return asked


def _answered(k: Constants):  # noqa: ANN202
    def answered(asked: pa.Table, model: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.Table.from_batches([], schema=ASKED)
        kind = asked["kind"][0].as_py()
        if kind == OTHER:
            return asked.cast(ASKED)
        keys = _unpacked(model, "keys")
        value = _joined(model, "value", np.dtype("<f8"))
        counts = _joined(model, "c", U8) if kind == WORD else None
        order = np.argsort(keys, kind="stable")
        keys, value, counts = keys[order], value[order], counts[order] if counts is not None else None
        missing = 0.0 if kind == PAIR else np.log10(k.unknown) if k.unknown < 1 else 0.0
        out = []
        for chunk, wanted, uses, doc, n in zip(asked["chunk"].to_pylist(), *(_buffers(asked, c) for c in ("keys", "uses", "doc", "n")), strict=True):
            wanted, uses, doc, n = unpacked(wanted), np.frombuffer(uses, U4), np.frombuffer(doc, "<u2"), np.frombuffer(n, U4)
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            found = np.where(hit, value[at], missing) if len(keys) else np.full(len(wanted), missing)
            scores = np.bincount(doc, np.repeat(found, uses) * n)
            some = np.flatnonzero(np.bincount(doc))
            base = known = b""
            if kind == WORD:
                c = np.where(hit, counts[at], 0) if len(keys) else np.zeros(len(wanted))
                base = np.bincount(doc, np.repeat(k.base(c), uses) * n)[some].tobytes()
                known = np.bincount(doc, np.repeat(c > 0, uses) * n)[some].astype(U4).tobytes()
            out.append((kind, -1, chunk, scores[some].tobytes(), base, some.astype("<u2").tobytes(), known))
        release_memory()
        return pa.Table.from_batches([_batch(out, ASKED)])

    return answered


def _finished(k: Constants, start: float):  # noqa: ANN202
    names = ["id", "n_tokens", "n_known", "base_score", "score"]

    def finished(key: tuple, rows: pa.Table) -> pa.Table:
        parts = rows.to_pylist()
        head = next(r for r in parts if r["kind"] == OTHER)
        ids, known, lengths = np.frombuffer(head["keys"], "<i8"), np.frombuffer(head["uses"], bool), np.frombuffer(head["n"], U4)
        own = np.frombuffer(head["doc"], "<f8").reshape(3, -1)
        score, base, seen = own[0] + start, own[1].copy(), own[2].copy()
        for r in sorted(parts, key=lambda r: (r["kind"], r["doc"] or b"", r["keys"])):
            if r["kind"] != OTHER:
                doc = np.frombuffer(r["doc"], "<u2")
                score[doc] += np.frombuffer(r["keys"], "<f8")
                if r["kind"] == WORD:
                    base[doc] += np.frombuffer(r["uses"], "<f8")
                    seen[doc] += np.frombuffer(r["n"], U4)
        return pa.table(
            [pa.array(ids, mask=~known), pa.array(lengths.astype(np.int64)), pa.array(seen.astype(np.int64)), pa.array(base), pa.array(score)],
            names=names,
        )

    return finished


def score(docs: DataFrame, model: KatzModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every row of docs, whole texts; a null text is an empty one.

    P(word | history) is the bigram's discounted share, or else the history's backoff weight times P(word), and
    P(word) its discounted share, or the share of unknown words. A document's score is the sum of log10 P over
    its tokens and its end. Tasks send the distinct bigrams and words of a chunk of documents, with the
    documents that use them, to the buckets of the model, and get sums by document back; the hottest they know
    themselves. Repeated rows and rows
    with a null id are scored like others; an empty table gives no rows.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    tables = model.tables.filter(F.col("kind") < OTHER)
    ddl = "id long, n_tokens long, n_known long, base_score double, score double"
    found = []
    for turn in range(TURNS):
        now = given.filter(F.pmod(F.xxhash64("id", "text"), F.lit(TURNS)) == turn)
        asked = now.mapInArrow(_asked(model.buckets, model.constants, model.pairs, model.words), ASKED_DDL)
        asked, known = (_by_bucket(rows, model.constants.total // TURNS, "kind", "bucket") for rows in (asked, tables))
        cogrouped = asked.groupBy("kind", "bucket").cogroup(known.groupBy("kind", "bucket"))
        answers = cogrouped.applyInArrow(_answered(model.constants), ASKED_DDL)
        found.append(materialise(answers.groupBy("chunk").applyInArrow(_finished(model.constants, model.start), ddl), "scores"))
    return reduce(DataFrame.unionByName, found)
