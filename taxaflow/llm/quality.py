"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from taxaflow.llm.common import named

#: Bytes of a chunk, and from one chunk to the next. The last chunk of a text ends where the text does.
CHUNK, HOP = 512, 448
#: A filter sees two blocks of STEP bytes and moves by one block.
STEP, EMBED, FILTERS, HIDDEN = 4, 8, 32, 16
#: Chunks that are convolved at once.
AT_ONCE = 256


def chunk_starts(n_bytes: int) -> np.ndarray:
    """Starts of the overlapping chunks that together cover n_bytes; one chunk at least."""
    if n_bytes <= CHUNK:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n_bytes - CHUNK, HOP, dtype=np.int64)
    return np.append(starts, n_bytes - CHUNK)


def chunks_of(data: bytes) -> np.ndarray:
    """The chunks of a text as rows of bytes; a short one is filled up with zeros."""
    held = np.frombuffer(data.ljust(CHUNK, b"\0"), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(held, CHUNK)[chunk_starts(len(data))]


@dataclass
class Network:
    """Byte embedding, one convolution, the largest response of each filter in a chunk; then mean, maximum and
    minimum of these over the text's chunks and the text's length, one hidden layer, one probability."""

    embed: np.ndarray
    left: np.ndarray
    right: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def fresh(seed: int) -> Network:
        rng = np.random.default_rng(seed)

        def drawn(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        wide = STEP * EMBED
        return Network(
            drawn(256, EMBED, scale=0.5), drawn(wide, FILTERS, scale=(2 * wide) ** -0.5), drawn(wide, FILTERS, scale=(2 * wide) ** -0.5),
            np.zeros(FILTERS, np.float32), drawn(3 * FILTERS + 1, HIDDEN, scale=(3 * FILTERS) ** -0.5), np.zeros(HIDDEN, np.float32),
            drawn(HIDDEN, 1, scale=HIDDEN**-0.5), np.zeros(1, np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return list(vars(self).values())

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """Response of each filter at each block of each chunk."""
        blocks = self.embed[chunks].reshape(-1, STEP * EMBED)
        shape = (len(chunks), CHUNK // STEP, FILTERS)
        return (blocks @ self.left).reshape(shape)[:, :-1] + (blocks @ self.right).reshape(shape)[:, 1:] + self.bias

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        parts = [self.responses(chunks[i : i + AT_ONCE]).max(1) for i in range(0, len(chunks), AT_ONCE)]
        return np.concatenate(parts)

    def logits(self, pools: np.ndarray, firsts: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
        """Of texts whose chunks' pools begin at firsts."""
        return (np.tanh(_features(pools, firsts, n_bytes) @ self.hidden + self.hidden_bias) @ self.out + self.out_bias)[:, 0]


def _features(pools: np.ndarray, firsts: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    n = np.diff(np.append(firsts, len(pools)))[:, None].astype(np.float32)
    sums = [np.add.reduceat(pools, firsts) / n, np.maximum.reduceat(pools, firsts), np.minimum.reduceat(pools, firsts)]
    return np.concatenate([*sums, np.log1p(n_bytes)[:, None].astype(np.float32) / 10], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gradients(net: Network, chunks: np.ndarray, firsts: np.ndarray, n_bytes: np.ndarray, errors: np.ndarray) -> list[np.ndarray]:
    """Of the loss with regard to each of net.arrays(); errors is called with the logits and returns the loss's slope."""
    at, pools = np.empty((len(chunks), FILTERS), np.int64), np.empty((len(chunks), FILTERS), net.bias.dtype)
    for i in range(0, len(chunks), AT_ONCE):
        found = net.responses(chunks[i : i + AT_ONCE])
        at[i : i + AT_ONCE], pools[i : i + AT_ONCE] = found.argmax(1), found.max(1)
    feats = _features(pools, firsts, n_bytes)
    act = np.tanh(feats @ net.hidden + net.hidden_bias)
    slope = errors((act @ net.out + net.out_bias)[:, 0])[:, None]
    back = (slope @ net.out.T) * (1 - act**2)
    onto = back @ net.hidden.T
    n = np.diff(np.append(firsts, len(pools)))
    doc = np.repeat(np.arange(len(firsts)), n)
    mean, most, least = (onto[:, i * FILTERS : (i + 1) * FILTERS] for i in range(3))
    pool = (mean / n[:, None])[doc]
    for share, at_end in ((most, feats[doc, FILTERS : 2 * FILTERS]), (least, feats[doc, 2 * FILTERS : 3 * FILTERS])):
        ends = (pools == at_end).astype(pools.dtype)  # chunks that overlap can tie
        pool = pool + share[doc] * ends / np.add.reduceat(ends, firsts)[doc]
    wide = STEP * EMBED
    weights = np.concatenate([net.left, net.right])
    both, embed = np.zeros((2 * wide, FILTERS)), np.zeros((256, EMBED))
    for i in range(0, len(chunks), AT_ONCE):
        share = pool[i : i + AT_ONCE]
        row = np.arange(i, i + len(share))[:, None, None]
        seen = chunks[row, at[i : i + AT_ONCE, :, None] * STEP + np.arange(2 * STEP)]
        window = net.embed[seen].reshape(len(share), FILTERS, 2 * wide)
        both += np.einsum("nf,nfk->kf", share, window, optimize=True)
        spread = (share[:, :, None] * weights.T[None]).reshape(-1, EMBED)
        flat = seen.ravel()
        embed += np.stack([np.bincount(flat, spread[:, k], 256) for k in range(EMBED)], 1)
    return [embed, both[:wide], both[wide:], pool.sum(0), feats.T @ back, back.sum(0), act.T @ slope, slope.sum(0)]


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, steps: int = 600, seed: int = 7) -> Network:
    """Fit the network by Adam on weighted log loss over all chunks of the texts."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    sizes = np.array([len(t) for t in texts], np.float32)
    sums = [[np.zeros(a.shape), np.zeros(a.shape)] for a in net.arrays()]
    order: list[int] = []
    for step in range(1, steps + 1):
        if len(order) < 32:
            order += rng.permutation(len(texts)).tolist()
        picked, order = order[:32], order[32:]
        chunks = [chunks_of(texts[i]) for i in picked]
        firsts = np.append(0, np.cumsum([len(c) for c in chunks])[:-1])
        y, w = labels[picked], weights[picked]

        def errors(logits: np.ndarray, y: np.ndarray = y, w: np.ndarray = w) -> np.ndarray:
            return ((_sigmoid(logits) - y) * w / w.sum()).astype(np.float32)

        rate = 0.01 * min(1, step / 20) * (1 - step / (steps + 1)) + 1e-4
        grads = _gradients(net, np.concatenate(chunks), firsts, sizes[picked], errors)
        for a, g, s in zip(net.arrays(), grads, sums, strict=True):
            g = g + 1e-5 * a
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.99 * s[1] + 0.01 * g * g
            a -= (rate * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, most: int = 2400, steps: int = 600) -> Network | float:
    """The network, fitted on at most `most` labelled rows, all chunks of each.

    labels (doc_id, quality) are those to learn from; rows whose quality is not 0 or 1 and documents without a
    label do not count; a null text is an empty one, and a document that repeats counts as often. Half of the rows are taken from each class, in the order of a hash of their doc_id, and
    weighted to the classes' shares among all labels. With labels of one class only, the result is its value,
    and without any labels 0.5, which score() then gives to every text.
    """
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 0.5))
    half = most // 2
    ids = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half) for q in (0, 1)]
    sample = ids[0].unionByName(ids[1]).withColumnRenamed("doc_id", "id")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column("text")]
            yield pa.record_batch([batch.column("id"), batch.column("quality"), pa.array(data, pa.binary())], names=["id", "quality", "data"])

    # sample has `most` rows at most
    given = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string")).join(F.broadcast(sample), "id")
    ddl = StructType([StructField("id", given.schema["id"].dataType), StructField("quality", given.schema["quality"].dataType), StructField("data", BinaryType())])
    rows = given.mapInArrow(cut, ddl).collect()
    if len({r["quality"] for r in rows}) < 2:
        return float(max(shares, key=shares.get))
    rows.sort(key=lambda r: (r["id"], bytes(r["data"])))
    y = np.array([r["quality"] for r in rows], np.float32)
    share = np.array([np.mean(y == q) for q in (0, 1)])
    weight = np.array([shares[0], shares[1]]) / sum(shares.values()) / share
    return train([bytes(r["data"]) for r in rows], y, weight[y.astype(int)], steps)


def score(docs: DataFrame, net: Network | float, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with the column score_col, from 0 to 1: the network's probability of label 1 from the whole text.

    A null text scores as an empty one, a repeated row like the other. All columns of docs are kept, whatever their
    names and nulls; one named like score_col is replaced. An empty table gives no rows.
    """

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            found = np.full(batch.num_rows, net if isinstance(net, float) else 0, np.float64)
            if not isinstance(net, float):
                held, sizes, pending, first = [], [], 0, 0
                for i in range(batch.num_rows):
                    data = (texts[i].as_py() or "").encode("utf-8", "surrogatepass")
                    held.append(net.pooled(chunks_of(data)) if len(data) > 64 * CHUNK else chunks_of(data))
                    sizes.append(len(data))
                    pending += len(held[-1])
                    if pending > 4 * AT_ONCE or i + 1 == batch.num_rows:
                        found[first : i + 1] = _scores(net, held, sizes)
                        held, sizes, pending, first = [], [], 0, i + 1
            yield pa.record_batch([batch.column(1), pa.array(found)], names=["kept", "score"])

    kept = F.struct(*[named(c) for c in docs.columns if c.lower() != score_col.lower()])
    given = docs.select(named(text_col).cast("string").alias("text"), kept.alias("kept"))
    schema = StructType([StructField("kept", given.schema["kept"].dataType), StructField("score", DoubleType())])
    return given.mapInArrow(scored, schema).select("kept.*", F.col("score").alias(score_col))


def _scores(net: Network, held: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    n = np.array([len(h) for h in held])
    raw = [h for h in held if h.dtype == np.uint8]
    pools = np.empty((n.sum(), FILTERS), np.float32)
    firsts = np.append(0, np.cumsum(n)[:-1])
    is_raw = np.repeat([h.dtype == np.uint8 for h in held], n)
    if raw:
        pools[is_raw] = net.pooled(np.concatenate(raw))
    if len(raw) < len(held):
        pools[~is_raw] = np.concatenate([h for h in held if h.dtype != np.uint8])
    return _sigmoid(net.logits(pools, firsts, np.array(sizes, np.float32)).astype(np.float64))
