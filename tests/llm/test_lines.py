"""Line dedup against a plain computation, with nulls, repeats, long texts and clashing names."""

import hashlib
import random

import pytest

from taxaflow.llm.lines import drop_shared_lines
from taxaflow.llm.queries import QUERIES

BLANKS = " \t\n\x0b\x0c\r"


def plain(rows, least_chars=10, least_docs=2):
    """(id, text, n_lines, n_dropped) of each row; rows without an id are one document after all others."""
    key = lambda line: "".join(c.lower() if c < "\x80" else c for c in line.strip(BLANKS))
    order = lambda i: (i is None, i or 0)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key(x)) < least_chars or len(holders[key(x)]) < least_docs or i == min(holders[key(x)], key=order)]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, drop_shared_lines(df, **how).collect()), key=repr)


CASES = [
    (3, "Copyright 2020 All\nmine alone here\n\nshort"),
    (1, "  COPYRIGHT 2020 all \t\nother lines of one\n"),
    (2, "copyright 2020 all"),
    (5, "ÉCLAIR AND MORE\n\x0b\x0céclair and more"),
    (6, "Éclair and more\n copyright 2020 all"),
    (7, None), (8, ""), (9, "\n\n"), (None, "copyright 2020 all\nnobody has this"), (None, "nobody has this\nfor none but it"),
    (4, "twice the same\ntwice the same\ntwice the same"), (10, "twice the same\nlast line of ten"), (10, "a text of the same id\nlast line of ten"), (10, "a text of the same id\nlast line of ten"),
    (-1, "123456789\n1234567890"), (11, "123456789\n1234567890"), (12, "ääääääääää"), (13, "ääääääääää"), (14, "for none but it\r"),
]


def test_cases(spark):
    assert found(spark, CASES) == plain(CASES)
    assert found(spark, CASES, least_docs=3) == plain(CASES, least_docs=3)
    assert found(spark, CASES, least_chars=0) == plain(CASES, least_chars=0)


def test_many_texts(spark):
    rng = random.Random(4)
    pool = [f"Line {i} of the pool {'é' * (i % 5)}" for i in range(60)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.4 else f"own {i} {rng.random()}" for _ in range(rng.randrange(40)))) for i in range(300)]
    assert found(spark, rows) == plain(rows)


def test_a_very_long_text_and_a_line_of_most_documents(spark):
    rows = [(0, "\n".join(f"line number {i}" for i in range(60_000)))]
    rows += [(i, f"the line of all documents\nline number {i}\nx") for i in range(1, 2000)]
    assert found(spark, rows) == plain(rows)


def test_other_columns_and_names(spark):
    df = spark.createDataFrame([(1, "the same line\nb", "h", 1), (2, "The same line", "i", 2)], "`my.id` long, `text``s` string, hash string, version int")
    assert sorted(map(tuple, drop_shared_lines(df, "my.id", "text`s").collect())) == [(1, "the same line\nb", 2, 0), (2, "", 1, 1)]


def test_empty_table(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("clash", ["hash", "lines", "first"])
def test_the_query(spark, tmp_path, clash):
    spark.createDataFrame([(i, t, "x") for i, t in CASES if i not in (None, 10)], f"doc_id long, text string, `{clash}` string").write.parquet(f"{tmp_path}/documents.parquet")
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in plain([(i, t) for i, t in CASES if i not in (None, 10)])]
    assert sorted(map(tuple, QUERIES["op11_line_dedup"](spark, str(tmp_path)).collect())) == sorted(want)
