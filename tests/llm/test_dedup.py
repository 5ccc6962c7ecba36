"""Near-duplicate, exact-duplicate and sharding operators against brute force, with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from taxaflow.llm import recipes, sharding, similar, simhash
from taxaflow.llm.graph import connected_components

DDL = "doc_id long, text string, fp long, size string, digest int, shard string"


def awkward(seed=0, n=60):
    """Documents with near copies, copies, nulls, empty and long texts, repeated ids and clashing columns."""
    rng = random.Random(seed)
    words = ["The", "of", "été", "naïve", "x", *[f"word{i}" for i in range(300)]]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 90))) for _ in range(n)]
    for i in range(0, n, 4):
        w = texts[i].split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
        texts.append(texts[i].replace(" ", " \t\n"))
    texts += ["", None, " \n\t", "x", "x y", " ".join(["again"] * 40_000), "one. " * 3000, "ab" * 6000]
    rows = [(i, t, i, "s", 1, "z") for i, t in enumerate(texts)]
    return [*rows, (3, "another text under a used id", 0, "s", 1, "z"), (None, texts[0], 0, "s", 1, "z"), (None, None, 0, "s", 1, "z"), (5, texts[5], 9, "t", 2, "q")]


def groups_of(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {"chain": [(i, i + 1) for i in range(40)], "star": [(99, i) for i in range(30)], "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)], "none": []}[shape]
    df = spark.createDataFrame([*edges, (None, 1), (2, None)] if edges else [], "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == groups_of(edges, {x for e in edges for x in e})


def plain_fingerprint(text, size=3):
    import xxhash

    w = re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode().lower()).strip().split(b" ")
    w = [x for x in w if x]
    runs = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("crowd", [64, 1])
def test_near_groups_equal_all_pairs(spark, monkeypatch, crowd):
    """Also where each segment value counts as a crowd."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rows = awkward()
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    root = groups_of(links, range(len(rows)))
    least = defaultdict(list)
    for i, r in root.items():
        if rows[i][0] is not None:
            least[r].append(rows[i][0])
    expected = sorted((str(rows[i][0]), fps[i], min(least[r], default=None)) for i, r in root.items())
    df = spark.createDataFrame(rows, DDL).repartition(3)
    got = [(str(r.id), r.fp % (1 << 64), r.group_id) for r in simhash.near_groups(df).collect()]
    assert sorted(got) == expected
    assert simhash.near_groups(df.limit(0)).count() == 0


def test_crowded_fingerprints_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 3)
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for b in base for _ in range(25)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.near_edges(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    expected = groups_of([(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2], signed)
    assert groups_of([(e.a, e.b) for e in edges], signed) == expected
    assert all(((e.a ^ e.b) % (1 << 64)).bit_count() <= 2 for e in edges)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = " ".join(str(i % 977) for i in range(2000))
    whole = simhash.simhash64(text)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.simhash64(text) == whole == plain_fingerprint(text)


def test_exact_groups_equal_normalised_texts(spark):
    rows = awkward()
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t, *_ in rows]
    members = defaultdict(list)
    for (i, *_), t in zip(rows, norm, strict=True):
        members[t].append(i)
    expected = []
    for (i, *_), t in zip(rows, norm, strict=True):
        keep = min((m for m in members[t] if m is not None), default=None)
        expected.append((i, keep, len(members[t]), keep is None or i == keep, hashlib.sha256(t.encode()).hexdigest()))
    df = spark.createDataFrame(rows, DDL).repartition(3)
    assert sorted(map(tuple, recipes.exact_groups(df).collect()), key=repr) == sorted(expected, key=repr)
    assert recipes.exact_groups(df.limit(0)).count() == 0


def test_chunks_concatenate_to_the_text_and_are_stored_once(spark):
    df = spark.createDataFrame(awkward(), DDL)
    found = recipes.with_chunks(df).collect()
    assert all("".join(r.chunks) == r.text and all(len(c) <= recipes.MOST for c in r.chunks) for r in found)
    store = {r.chunk: r.uses for r in recipes.chunk_store(df).collect()}
    assert sum(store.values()) == sum(len(r.chunks) for r in found) and set(store) == {c for r in found for c in r.chunks}


def test_shared_chunks_survive_an_insertion(spark):
    body = " ".join(f"Sentence number {i} of the text." for i in range(400))
    df = spark.createDataFrame([(1, body), (2, "An inserted beginning. " + body)], "doc_id long, text string")
    a, b = (set(map(bytes, r.recipe)) for r in recipes.recipes(df).orderBy("id").collect())
    assert len(a & b) >= len(a) - 2


@pytest.mark.parametrize("seed", [0, 1])
def test_shards_are_contiguous_and_balanced(spark, seed):
    rows = [r for r in awkward(seed, 400) if r[1] is None or len(r[1]) < 2000]
    df = spark.createDataFrame(rows, DDL).repartition(5)
    got = sharding.byte_shards(df, 8).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((str(r.id), r.size, r.text_crc32) for r in got) == sorted((str(r[0]), size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    target = sum(size(r[1]) for r in rows) / 8
    for s in range(8):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - target) <= 1100
    assert sharding.byte_shards(df.limit(0)).count() == 0


def test_a_group_larger_than_a_shard_is_cut(spark):
    df = spark.createDataFrame([(i, "the same text") for i in range(200)] + [(None, "other")], "doc_id long, text string")
    counts = [r["count"] for r in sharding.byte_shards(df, 4).groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 2


def test_similar_groups_by_five_word_shingles(spark):
    rng = random.Random(2)
    vocabulary = [f"vocabulary{i}" for i in range(4000)]
    base = [[rng.choice(vocabulary) for _ in range(220)] for _ in range(12)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i, w in enumerate(base):
        near, far = list(w), list(w)
        near[7] = near[150] = "edited"
        for j in range(0, 220, 20):
            far[j] = f"edited{j}"
        rows += [(100 + i, " ".join(near).upper()), (200 + i, " ".join(far))]
    rows += [(None, rows[0][1]), (300, None), (301, ""), (302, " "), (303, "one two"), (304, "one two"), (100, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.id, r.group_id) for r in similar.similar_groups(df).collect()}
    assert got == {(i, i) for i in range(12)} | {(100 + i, i) for i in range(12)} | {(303, 303), (304, 303)}
    assert similar.similar_groups(df.limit(0)).count() == 0


def test_crowds_of_similar_texts(spark, monkeypatch):
    monkeypatch.setattr(similar, "CROWD", 4)
    rng = random.Random(3)
    base = [f"vocabulary{rng.randrange(5000)}" for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        w[rng.randrange(300)] = f"edit{i}"
        rows.append((i, " ".join(w)))
    got = {r.group_id for r in similar.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0}


def groups_by_all_pairs(rows, size=5, least=0.8):
    """(id, group_id) over every pair of texts whose sets of shingles are similar."""
    sets = {i: {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} for i, t in rows if (w := t.lower().split())}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])]
    root = groups_of(links, sets)
    return {(i, root[i]) for link in links for i in link}


def test_no_link_inside_a_crowd_is_missed(spark, monkeypatch):
    """Families of near copies that share a long passage and, in another order, all their long words."""
    monkeypatch.setattr(similar, "CROWD", 4)
    rng = random.Random(5)
    passage, own = ([f"vocabulary{rng.randrange(9000)}" for _ in range(n)] for n in (150, 70))
    texts = []
    for _ in range(40):
        rng.shuffle(own)
        for _ in range(3):
            w = passage + own
            for _ in range(2):
                w.insert(rng.randrange(len(w)), f"w{rng.randrange(99)}")
            texts.append(" ".join(w))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    expected = groups_by_all_pairs(rows)
    assert len({g for _, g in expected}) > 20
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {(r.id, r.group_id) for r in similar.similar_groups(df).collect()} == expected


@pytest.mark.parametrize("kind", ["appended", "cut", "edited"])
def test_copies_just_similar_enough_are_all_found(spark, kind):
    """Pairs at a similarity of 0.8 to 0.85 of texts of 20 to 2,000 words."""
    rng = random.Random(kind)
    word = lambda: f"vocabulary{rng.randrange(90000)}"
    rows = []
    for n in (20, 40, 80, 200, 500, 2000):
        for _ in range(20):
            w = [word() for _ in range(n)]
            other = w + [word() for _ in range(n // 5 - 1)] if kind == "appended" else w[: n - n // 5 + 1] if kind == "cut" else list(w)
            for _ in range(n // 50 if kind == "edited" else 0):
                other[rng.randrange(n)] = word()
            rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(other))]
    expected = groups_by_all_pairs(rows)
    assert len(expected) > 150
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {(r.id, r.group_id) for r in similar.similar_groups(df).collect()} == expected


def test_exact_groups_keep_no_table_of_chunks(spark, monkeypatch):
    kept = []
    real = recipes.materialise
    monkeypatch.setattr(recipes, "materialise", lambda df, label, codec=None: kept.append(label) or real(df, label, codec))
    df = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, None)], "doc_id long, text string")
    assert sorted((r.id, r.keep_id) for r in recipes.exact_groups(df).collect()) == [(1, 1), (2, 1), (3, 3)]
    assert "chunks" not in kept


def test_colliding_chunk_identifiers_stop_exact_groups(spark, monkeypatch):
    monkeypatch.setattr(recipes, "chunk_id", lambda chunk: F.unhex(F.lit("00")))
    df = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    with pytest.raises(Exception, match="collide"):
        recipes.exact_groups(df).collect()


def left_over(spark, places, keys, repeated=False):
    """Pairs, as often as they are met, of texts of 100 shingles that share keys (at the places of each), in groups of their own."""
    left = spark.createDataFrame([(k, i, 100, at + k, i) for i, at in enumerate(places) for k in range(keys)], "key long, id long, n long, i int, root long")
    sketches = spark.createDataFrame([(i, 100, [0] * similar.SKETCH) for i in range(len(places)) for _ in range(1 + repeated)], "id long, n long, bits array<long>")
    return sorted((r.a, r.b) for r in similar._left_over(left, sketches, 0.8).collect())


def test_a_pair_that_shares_many_keys_of_a_crowd_is_met_once(spark):
    pairs = [(a, b) for b in range(12) for a in range(b)]
    assert left_over(spark, [0] * 12, 11) == sorted(pairs)


def test_texts_with_many_rare_shingles_before_a_crowd_are_not_compared_in_it(spark):
    """Of two sets of 100, at a similarity of 0.8 or more, 89 are shared, so at most 11 come before the first of them."""
    assert left_over(spark, [0, 11, 12, 19], 1) == [(0, 1)]


def test_keys_of_repeated_ids_exclude_no_pair(spark):
    assert set(left_over(spark, [0, 0], 3, repeated=True)) == {(0, 1)}
    assert len(left_over(spark, [0, 0], 3, repeated=True)) >= 3
