"""The registered queries, run as the driver runs them, against plain computations over the same small tables."""

import random
import zlib
from collections import Counter
from math import log10

import pytest
import xxhash

from taxaflow.llm.queries import QUERIES
from taxaflow.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(12)
    words = [f"Word{i}" if i % 4 else f"é{i}!" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    found = {i: prose(rng.randrange(3, 260)) for i in range(60)}
    for i in range(60, 75):
        near = found[i - 60].split()
        near[len(near) // 2] = "changed"
        found[i] = " ".join(near)
    return found | {75: None, 76: "", 77: found[5], 78: found[5].upper(), 79: prose(5000), 80: "<|endoftext|> a"}


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", "s", 0) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def answer(spark, folder):
    return lambda name: QUERIES[name](spark, folder).collect()


@pytest.fixture(scope="module")
def ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(i):
    return zlib.crc32(str(i).encode())


def words_of(text):
    return [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).split()]


def test_op1_is_what_all_pairs_give(answer, docs):
    def fingerprint(text):
        w = words_of(text)
        runs = [w[i : i + 3] for i in range(len(w) - 2)] or ([w] if w else [])
        h = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: fingerprint(t) for i, t in docs.items()}
    root = {i: i for i in docs}
    for _ in docs:
        for i in docs:
            root[i] = min(root[j] for j in docs if (prints[i] ^ prints[j]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in answer("op1_simhash_near_dedup")}
    assert got == {i: (f"{prints[i]:016x}", root[i]) for i in docs}


def test_op2_pieces_tile_documents_and_sequences(answer, docs, ids):
    pieces, sequences = {}, {}
    for r in answer("op2_packing"):
        whole = [*ids(docs[r.doc_id]), 1]
        assert r.doc_tokens == len(whole)
        part = b"".join(x.to_bytes(4, "little") for x in whole[r.start : r.start + r.length])
        assert zlib.crc32(part) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans, full in [(v, len(ids(docs[i])) + 1) for i, v in pieces.items()] + [(v, None) for v in sequences.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == full if full else at <= 2048 and at & (at - 1) == 0
    assert pieces.keys() == docs.keys()


def test_op5_sums_answer_every_limit(answer, docs, ids):
    lengths = Counter(len(ids(t)) for t in docs.values())
    got = {r.n_tokens: r for r in answer("op5_token_counts")}
    assert {n: r.docs for n, r in got.items()} == lengths
    for n, r in got.items():
        assert r.truncated_total == sum(min(n, k) * c for k, c in lengths.items()) and r.docs_upto == sum(c for k, c in lengths.items() if k <= n)


def test_op7_marks_what_is_held_out_and_scores_all(answer, docs):
    got = {r.doc_id: r for r in answer("op7_quality_classifier")}
    assert got.keys() == docs.keys()
    assert all(r.held_out == (crc(i) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for i, r in got.items())


def test_op8_counts_and_base_are_those_of_the_training_tokens(answer, docs):
    seqs = {i: [*words_of(t), None] for i, t in docs.items()}
    c = Counter(w for i, s in seqs.items() if crc(i) % 5 != 1 for w in s)
    n, v = sum(c.values()), len(c)
    for r in answer("op8_katz_backoff"):
        s = seqs[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(r.doc_id) % 5 == 1, len(s), sum(w in c for w in s), n)
        assert r.base_score == pytest.approx(sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in s)) and r.score < 0


def test_op10_shards_are_even_and_whole(answer, docs):
    got = answer("op10_byte_shards")
    size = {i: len((t or "").encode()) + 1 for i, t in docs.items()}
    assert {r.doc_id: (r.size, r.text_crc32, r.law, r.grown_shard) for r in got} == {i: (size[i], zlib.crc32((t or "").encode()), "bytes", None) for i, t in docs.items()}
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and slots.keys() <= set(range(16))
    loads = [sum(r.size for r in got if r.shard == k) for k in slots]
    assert max(loads) <= sum(size.values()) / 16 + max(size.values())
