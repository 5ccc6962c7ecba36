"""Benchmark decontamination by latent semantic retrieval, then subsequence and answer checks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import drop_table, input_bytes, materialise

#: Words of a block; a passage is two neighbouring blocks, so passages overlap by half.
BLOCK = 32
#: Terms of more than this share of blocks, and of more than so many, have no weight, as in a TF-IDF index with a
#: maximum document frequency.
MAX_DF, FEW = 0.005, 64
#: Latent dimensions, and the random ones beyond them.
RANK, OVERSAMPLED = 96, 8
#: Smallest cosine of a candidate, share of an item's words in order in it, and share of the item's rarest words.
COSINE, SEQUENCE, ANSWER = 0.5, 0.6, 0.5
#: How many of an item's rarest words are its answer; items with fewer words than SHORT must occur whole.
ANSWER_WORDS, SHORT = 8, 8
#: Items that are searched for at once; more are taken in turns over all documents.
ITEMS = 1000
#: Terms whose sums one task adds up.
SLICE = 256
#: Blocks of documents that are handled at once.
AT_ONCE = 1 << 14
#: Candidates go to all tasks if they have so many bytes at most; beyond, documents are joined to them by a shuffle.
MOST_BROADCAST = 8 << 20

FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def folded(text: str | None) -> list[bytes]:
    """Words of a text: ASCII letters lower-cased, ASCII punctuation and white space between words."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


@dataclass
class Items:
    """Benchmark items, their vocabulary, and what the corpus says of it."""

    ids: list
    words: list[list[bytes]]
    index: dict[bytes, int]
    weight: np.ndarray | None = None
    basis: np.ndarray | None = None  # terms by latent dimensions, times the terms' weights
    latent: np.ndarray | None = None  # unit vectors of items
    answers: list[set[bytes]] | None = None

    @property
    def kind(self) -> np.dtype:
        return np.dtype("<u2" if len(self.index) <= 1 << 16 else "<u4")

    @staticmethod
    def of(rows: list[tuple]) -> Items:
        words = [folded(t) for _, t in rows]
        return Items([i for i, _ in rows], words, {w: n for n, w in enumerate(sorted({w for ws in words for w in ws}))})

    def vectors(self) -> np.ndarray:
        """Unit TF-IDF vectors of items."""
        found = np.zeros((len(self.words), len(self.index)))
        for row, ws in zip(found, self.words, strict=True):
            np.add.at(row, [self.index[w] for w in ws], 1)
        found *= self.weight
        norm = np.linalg.norm(found, axis=1, keepdims=True)
        return found / np.where(norm > 0, norm, 1)


@dataclass
class Words:
    """Some documents' words that items have too: terms, and the block of each, numbered over the documents."""

    terms: np.ndarray
    block: np.ndarray
    n_blocks: int
    keys: list[int]
    first_block: np.ndarray


ENCODED_DDL = "key long, counts binary, terms binary"


def encoded(docs: DataFrame, items: Items) -> DataFrame:
    """(key, counts, terms) of each row of docs (key, text): how many words of each block items have too, and these.

    Words are split and looked up once; all later passes read this table, of two bytes for such a word.
    """
    index, kind = items.index, items.kind

    def looked_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, terms = [], []
            for text in batch.column(1):
                words = folded(text.as_py())
                found = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
                at = np.flatnonzero(found >= 0)
                counts.append(np.bincount(at // BLOCK, minlength=max(1, -(-len(words) // BLOCK))).astype(np.uint8).tobytes())
                terms.append(found[at].astype(kind).tobytes())
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.binary()), pa.array(terms, pa.binary())], names=["key", "counts", "terms"])

    return docs.mapInArrow(looked_up, ENCODED_DDL)


def blocks(batches: Iterable[pa.RecordBatch], items: Items) -> Iterator[Words]:
    """The rows of encoded(), some documents at a time; with weights known, only words with a weight."""

    def done() -> Words:
        counts = np.frombuffer(b"".join(held), np.uint8)
        found = np.frombuffer(b"".join(terms), items.kind).astype(np.int64)
        of = np.repeat(np.arange(len(counts)), counts)
        if items.weight is not None:
            hit = items.weight[found] > 0
            found, of = found[hit], of[hit]
        sizes = np.array([len(c) for c in held])
        return Words(found, of, len(counts), keys, np.cumsum(sizes) - sizes)

    held, terms, keys, size = [], [], [], 0
    for batch in batches:
        for key, counts, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(counts)
            terms.append(words)
            keys.append(key)
            size += len(counts)
            if size >= AT_ONCE:
                yield done()
                held, terms, keys, size = [], [], [], 0
    if keys:
        yield done()


def _frequencies(table: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """Blocks of the corpus that hold each term, and all blocks."""
    index = items.index

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(index) + 1, np.int64)
        for w in blocks(batches, items):
            held = np.unique(w.block * len(index) + w.terms)
            df[:-1] += np.bincount(held % len(index), minlength=len(index))
            df[-1] += w.n_blocks
        yield pa.record_batch([pa.array(np.arange(len(df))), pa.array(df)], names=["term", "df"])

    rows = table.mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()  # a row for each term
    df = np.zeros(len(index) + 1, np.int64)
    for r in rows:
        df[r["term"]] = r["df"]
    return df[:-1], int(df[-1])


def _sums(matrix: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Blocks that have terms with a weight, and the sums of these terms' rows of matrix."""
    if not len(w.terms):
        return np.empty(0, np.int64), np.empty((0, matrix.shape[1]), np.float32)
    firsts = np.flatnonzero(np.append(True, np.diff(w.block) != 0))
    return w.block[firsts], np.add.reduceat(matrix[w.terms], firsts)


def _gram_times(table: DataFrame, items: Items, right: np.ndarray) -> np.ndarray:
    """A'A right, where A has a TF-IDF row of unit length for each block of the corpus, and heavy rows for items."""
    n_terms, weight = len(items.index), items.weight.astype(np.float32)
    thick = (weight[:, None] * right).astype(np.float32)
    wide = right.shape[1]

    def multiplied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_terms, wide), np.float32)
        for w in blocks(batches, items):
            _, sums = _sums(thick, w)
            if not len(sums):
                continue
            row = np.cumsum(np.append(False, np.diff(w.block) != 0))
            pair = np.sort(row * n_terms + w.terms)
            firsts = np.flatnonzero(np.append(True, np.diff(pair) != 0))
            tf = np.diff(np.append(firsts, len(pair)))
            norms = np.bincount(pair[firsts] // n_terms, (tf * weight[pair[firsts] % n_terms]) ** 2)
            sums /= norms[:, None].astype(np.float32)
            order = np.argsort(w.terms, kind="stable")
            firsts = np.flatnonzero(np.append(True, np.diff(w.terms[order]) != 0))
            at = w.terms[order][firsts]
            total[at] += np.add.reduceat(sums[row[order]], firsts) * weight[at][:, None]
        starts = range(0, n_terms, SLICE)
        yield pa.record_batch([pa.array(starts, pa.int64()), pa.array([total[i : i + SLICE].tobytes() for i in starts], pa.binary())], names=["start", "sums"])

    def added(key: tuple, rows: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(b, np.float32).astype(np.float64) for b in sorted(rows["sums"].to_pylist()))
        return pa.table({"start": [key[0].as_py()], "sums": [whole.tobytes()]})

    ddl = "start long, sums binary"
    parts = table.mapInArrow(multiplied, ddl).groupBy("start").applyInArrow(added, ddl).collect()  # terms by wide numbers in all
    found = np.zeros((n_terms, wide))
    for r in parts:
        found[r["start"] : r["start"] + SLICE] = np.frombuffer(r["sums"], np.float64).reshape(-1, wide)
    rows = items.vectors()
    heavy = max(1.0, np.linalg.norm(found)) / max(1.0, len(rows))
    return found + heavy * (rows.T @ (rows @ right))


def learn(table: DataFrame, items: Items, seed: int = 11) -> None:
    """IDF weights, the latent basis and items' latent vectors from all documents, encoded, and the items.

    Randomised SVD: the range of A'A over random directions, then the leading eigenvectors within it, with a
    pass over all documents for each. Items count as rows of A too, heavy enough for their terms to be kept.
    """
    df, n = _frequencies(table, items)
    idf = np.log((1 + n) / (1 + df)) + 1e-3
    common = df > max(MAX_DF * n, FEW)
    for ws in items.words:
        own = [items.index[w] for w in ws]
        if own and common[own].all():
            common[own] = False
    items.weight = np.where(common, 0, idf)
    items.answers = [set(sorted(set(ws), key=lambda w: (df[items.index[w]], w))[:ANSWER_WORDS]) for ws in items.words]
    wide = min(RANK + OVERSAMPLED, len(items.index))
    if not wide:
        items.basis = items.latent = np.zeros((0, 1), np.float32)
        items.latent = np.zeros((len(items.ids), 1), np.float32)
        return
    directions = np.random.default_rng(seed).standard_normal((len(items.index), wide))
    q = np.linalg.qr(_gram_times(table, items, directions))[0]
    gram = q.T @ _gram_times(table, items, q)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    basis = q @ vectors[:, np.argsort(-values)[:RANK]]
    latent = items.vectors() @ basis
    norm = np.linalg.norm(latent, axis=1, keepdims=True)
    items.latent = (latent / np.where(norm > 0, norm, 1)).astype(np.float32)
    items.basis = (items.weight[:, None] * basis).astype(np.float32)


def common_subsequence(item: list[bytes], passage: list[bytes]) -> int:
    """Length of the longest common subsequence, by bits of a long integer."""
    places: dict[bytes, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    state = full
    for w in passage:
        met = state & places.get(w, 0)
        state = ((state + met) | (state - met)) & full
    return len(item) - state.bit_count()


def checked(item: list[bytes], answer: set[bytes], words: list[bytes]) -> tuple[float, float] | None:
    """Shares of the item's words in order and of its answer in words, if both are large enough."""
    held = len(answer.intersection(words)) / len(answer)
    if held < ANSWER:
        return None
    sequence = common_subsequence(item, words) / len(item)
    return (sequence, held) if sequence >= (SEQUENCE if len(item) >= SHORT else 1.0) else None


def _searched(items: Items):  # noqa: ANN202
    """(key, item, block) of passages whose latent vector is near an item's."""

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in blocks(batches, items):
            which, sums = _sums(items.basis, w)
            latent = np.zeros((w.n_blocks + 1, items.basis.shape[1]), np.float32)
            latent[which] = sums
            last = np.zeros(w.n_blocks, bool)
            last[np.append(w.first_block[1:], w.n_blocks) - 1] = True
            latent[:-1] += np.where(last[:, None], 0, latent[1:])  # a passage: a block and the next of its text
            norm = np.linalg.norm(latent[:-1], axis=1)
            some = np.flatnonzero(norm > 0)
            rows = []
            for start in range(0, len(some), 2048):
                part = some[start : start + 2048]
                near, item = np.nonzero((latent[part] / norm[part, None]) @ items.latent.T >= COSINE)
                doc = np.searchsorted(w.first_block, part[near], "right") - 1
                rows += zip([w.keys[d] for d in doc], item.tolist(), (part[near] - w.first_block[doc]).tolist(), strict=True)
            columns = zip(*rows, strict=True) if rows else [[], [], []]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["key", "item", "block"])

    return searched


def _verified(items: Items):  # noqa: ANN202
    """The candidates of each document whose words hold the item."""
    words, answers, ids = items.words, items.answers, items.ids

    def verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, near in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                held = folded(text.as_py())
                best: dict[int, tuple] = {}
                for i, block in ((r["item"], r["block"]) for r in near.as_py()):
                    at, reach = block * BLOCK, max(len(words[i]), BLOCK)
                    shares = checked(words[i], answers[i], held[max(0, at - reach) : at + 2 * BLOCK + reach])
                    if shares:
                        best[i] = max(best.get(i, (0, 0, 0)), (*shares, -at))
                rows += [(doc_id.as_py(), ids[i], -f[2], f[0], f[1]) for i, f in sorted(best.items())]
            columns = zip(*rows, strict=True) if rows else [[] for _ in range(5)]
            kinds = [pa.int64()] * 3 + [pa.float64()] * 2
            names = ["doc_id", "item_id", "at_word", "sequence", "answer"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return verified


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, at_word, sequence, answer): each row of docs and item of benchmark found in it.

    Documents are cut into overlapping passages over their whole texts. Passages whose latent vector has a
    cosine of COSINE or more with an item's are candidates. The item is found if SEQUENCE of its words occur
    around the passage in their order, and ANSWER of its ANSWER_WORDS rarest words at all. at_word is where the
    best passage begins. Items (item_id, text) come in turns of ITEMS, so that a task holds a bounded part of
    them; rows with a null or wordless text are found nowhere. Repeated rows of docs are each found, those with
    a null id too. Empty tables give no rows.
    """
    text = F.col(text_col).cast("string")
    given = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("key"))
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    ddl = "doc_id long, item_id long, at_word long, sequence double, answer double"
    found, held = None, []

    def searched(rows: list[tuple]) -> DataFrame:
        items = Items.of(rows)
        table = materialise(encoded(given.select("key", "text"), items), "encoded")
        learn(table, items)
        near = table.mapInArrow(_searched(items), "key long, item long, block long").distinct()
        near = materialise(near.groupBy("key").agg(F.collect_list(F.struct("item", "block")).alias("near")), "candidates")
        drop_table(table)
        small = input_bytes(near) <= MOST_BROADCAST
        asked = given.join(F.broadcast(near) if small else near, "key")
        return asked.select("id", "text", "near").mapInArrow(_verified(items), ddl)

    for row in wanted.distinct().orderBy("item_id", "text").toLocalIterator():
        if folded(row["text"]):
            held.append((row["item_id"], row["text"]))
        if len(held) == ITEMS:
            part, held = searched(held), []
            found = found.unionByName(part) if found else part
    if held:
        part = searched(held)
        found = found.unionByName(part) if found else part
    return found if found is not None else docs.sparkSession.createDataFrame([], ddl)
