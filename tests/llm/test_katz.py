"""Katz backoff against a plain dictionary model."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from taxaflow.llm import katz
from taxaflow.llm.katz import K, Constants, discounts, fit, score

DDL = "doc_id long, text string"


def tokens(text):
    return [*(text or "").encode().lower().split(), b" end"]


def plain_model(texts):
    """P(word) and P(word | history) of the model, from dictionaries."""
    words, pairs, times = Counter(), Counter(), Counter()
    for text in texts:
        seq = [b" start", *tokens(text)]
        words.update(seq[1:])
        pairs.update(zip(seq, seq[1:], strict=False))
        times.update(seq[:-1])
    n = sum(words.values())
    single = [sum(c == r for c in words.values()) for r in range(1, K + 2)]
    double = [sum(c == r for c in pairs.values()) for r in range(1, K + 2)]
    k = Constants.of([n, len(words), *single, *double], len(texts))
    d = discounts(double)

    def low(w):
        c = words.get(w, 0)
        return float(k.word_probability(np.array([c]))[0]) if c else k.unknown

    follow = defaultdict(dict)
    for (h, w), c in pairs.items():
        follow[h][w] = (d[c] if c <= K else 1) * c / times[h]
    alpha = {}
    for h, f in follow.items():
        if 1 - sum(f.values()) < 1e-12:
            follow[h] = f = {w: p * times[h] / (times[h] + 1) for w, p in f.items()}
        alpha[h] = (1 - sum(f.values())) / (1 - sum(map(low, f)))

    def p(w, h):
        return follow[h][w] if w in follow.get(h, ()) else alpha.get(h, 1) * low(w)

    return words, low, p, k


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" if i % 3 else f"w{i}é" for i in range(60)]
    rows = [(i, " ".join(vocabulary[min(59, int(rng.expovariate(0.1)))] for _ in range(rng.randrange(0, 40)))) for i in range(n)]
    return [*rows, (n, None), (n + 1, "\t \n"), (None, "w0é W1"), (3, "W1  w3é\nW1"), (n + 2, "never seen words here"), (n + 3, "W1 " * 9000)]


@pytest.mark.parametrize("n,hottest", [(5, 1 << 16), (120, 1 << 16), (120, 40), (120, 1)])
def test_scores_equal_a_dictionary_model(spark, monkeypatch, n, hottest):
    """All words hot, some, and none."""
    monkeypatch.setattr(katz, "HOTTEST", hottest)
    rows = corpus(1, n)
    learned = [t for i, t in rows if i is None or i % 5 != 1]
    df = spark.createDataFrame(rows, DDL).repartition(3)
    model = fit(df.filter("coalesce(doc_id % 5, 0) <> 1"), buckets=5)
    words, low, p, k = plain_model(learned)
    assert (model.constants.total, model.constants.words, model.constants.unknown) == (k.total, k.words, k.unknown)
    expected = defaultdict(list)
    for i, t in rows:
        seq = tokens(t)
        base = sum(math.log10((words.get(w, 0) + 0.5) / (k.total + 0.5 * (k.words + 1))) for w in seq)
        total = sum(math.log10(p(w, h)) for h, w in zip([b" start", *seq], seq, strict=False))
        expected[i].append((len(seq), sum(w in words for w in seq), base, total))
    got = defaultdict(list)
    for r in score(df, model).collect():
        got[r.id].append((r.n_tokens, r.n_known, r.base_score, r.score))
    assert got.keys() == expected.keys()
    for i in expected:
        for a, b in zip(sorted(got[i]), sorted(expected[i]), strict=True):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9) and a[3] == pytest.approx(b[3], rel=1e-9)


def test_every_history_sums_to_one():
    words, low, p, k = plain_model([t for _, t in corpus(2, 80)])
    assert sum(map(low, words)) + k.unknown == pytest.approx(1)
    for h in [b" start", *words]:
        assert sum(p(w, h) for w in words) + p(b"unknown word", h) == pytest.approx(1)


def test_empty_training_and_empty_input(spark):
    df = spark.createDataFrame([(1, "a b"), (None, None)], DDL)
    none = df.limit(0)
    model = fit(none)
    assert {(r.n_tokens, r.n_known, r.base_score, r.score) for r in score(df, model).collect()} == {(3, 0, 0, 0), (1, 0, 0, 0)}
    assert score(none, fit(df)).count() == 0


def test_a_bigram_met_once_is_known(spark):
    model = fit(spark.createDataFrame([(1, "q r"), (2, "s t")], DDL), buckets=2)
    got = {r.id: r.score for r in score(spark.createDataFrame([(1, "q r"), (2, "r q")], DDL), model).collect()}
    assert got[1] > got[2] + 0.1


def test_uneven_counts_of_counts_keep_good_turing():
    """Nearly as many have count 5 as count 4, so that plain Good-Turing would raise the fourth."""
    found = discounts([1000, 300, 120, 60, 55, 30])[1:]
    assert (np.diff(found) > 0).all() and 0 < found[0] and found[-1] < 1
    assert abs(found[0] - 0.5) > 0.05
    assert np.abs(discounts([1000, 300, 120, 60, 54, 30])[1:] - found).max() < 0.01


@pytest.mark.parametrize("classes", [[1000, 300, 120, 60, 55, 30], [90, 20, 9, 5, 3, 2, 7]])
def test_discounts_are_those_of_good_turing_by_the_textbook(classes):
    """r* = (r + 1) n[r + 1] / n[r] of the smoothed counts of counts, less what counts above K keep."""
    logs = [(math.log(r), math.log(n)) for r, n in enumerate(classes[: K + 1], 1)]
    mx, my = (sum(v) / len(logs) for v in zip(*logs, strict=True))
    slope = sum((x - mx) * (y - my) for x, y in logs) / sum((x - mx) ** 2 for x, _ in logs)
    smooth = {r: math.exp(my + slope * (math.log(r) - mx)) for r in range(1, K + 2)}
    above = (K + 1) * smooth[K + 1] / smooth[1]
    for r in range(1, K + 1):
        star = (r + 1) * smooth[r + 1] / smooth[r]
        assert discounts(classes)[r] == pytest.approx((star / r - above) / (1 - above))
