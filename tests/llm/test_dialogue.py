"""Repair of conversations against a search over all edits, with nulls, ties, repeats and long conversations."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from taxaflow.llm import dialogue
from taxaflow.llm.dialogue import cheapest, repair, transcript_digests
from taxaflow.llm.queries import QUERIES

BLANKS = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile("(s?(ua)+)?")


def audited(rows):
    """rows: (role, text) in order. Faults, cost, audit, lines and illegal neighbours by search over (row, roles so far)."""
    seen, faults = set(), []
    for role, text in rows:
        last = text.rstrip(BLANKS)[-1:]
        faults.append("b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else "")
        seen.add((role, text))

    def could_go_on(r):
        return any(GRAMMAR.fullmatch(r + more) for more in ("", "a", "ua"))

    @lru_cache(None)
    def best(i, r):
        """Least (cost, audit, lines) from row i on, when the roles so far end like r."""
        found = [(0, "", ())] if i == len(rows) and GRAMMAR.fullmatch(r) else []
        steps = [(5, "I", i, role, "") for role in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            steps.append((2, "D", i + 1, None, None))
            if faults[i] not in ("b", "d"):
                more = 5 * (faults[i] == "t")
                steps += [(more, "K", i + 1, role, text)] + [(more + 1, "R", i + 1, x, text) for x in ("user", "assistant")]
        for cost, letter, to, role, text in steps:
            after = r if role is None else r + (role[:1] or "?")
            if len(after) > most or not could_go_on(after):
                continue
            c, a, lines = best(to, after)
            found.append((c + cost, letter + a, lines if role is None else (f"{role}:{text}", *lines)))
        return min(found, default=(10**9, "", ()))

    most = len(rows) + 2 * len(rows) // 5 + 4  # to delete all rows costs 2 each, an insertion 5
    cost, audit, lines = best(0, "")
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(rows))
    return [faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()]


def report(spark, rows, schema="conv_id long, turn long, role string, text string", **names):
    found, turns = repair(spark.createDataFrame(rows, schema), **names)
    joined = found.join(transcript_digests(turns), "key", "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: [r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["sha256"] or empty] for r in joined}


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "unit", "User"]
    weights = [6, 6, 2, 1, 1, 1, 1]
    texts = ["Yes.", "No!", "cut off", " ", "", "Why? \n", "é", "Well. "]
    return [(rng.choices(roles, weights)[0], rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}{rng.choice(['.', ''])}") for _ in range(n)]


def test_cheapest_repairs_of_all_short_code_lists():
    text = {dialogue.PLAIN: "x.", dialogue.TRUNCATED: "x", dialogue.BLANK: ""}
    roles = ("system", "user", "assistant", "tool")
    for n in range(4):
        for codes in itertools.product([4 * f + r for f in text for r in range(4)], repeat=n):
            rows = [(roles[c % 4], text[c // 4] and f"{i}{text[c // 4]}") for i, c in enumerate(codes)]
            cost, audit, marks = cheapest(bytes(codes))
            want = audited(rows)
            assert [cost, audit] == want[4:6], (rows, audit, want)
            lines = [f"{ {'K': rows[i][0], 'u': 'user', 'a': 'assistant', 'U': 'user', 'A': 'assistant'}[m]}:{'' if m in 'UA' else rows[i][1]}" for i, ms in enumerate(marks) for m in ms if m != "D"]
            assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == want[6]


def test_repair_is_what_a_search_finds(spark):
    rng = random.Random(3)
    convs = {i: random_rows(rng, rng.randrange(1, 12)) for i in range(150)}
    rows = [(i, 10 * t, role, text) for i, turns in convs.items() for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    found = report(spark, rows)
    for i, turns in convs.items():
        assert found[i] == [10 * len(turns) - 10 + 1 - len(turns), *audited(turns)], turns
    assert len(found) == len(convs)


def test_nulls_gaps_and_ties(spark):
    rows = [
        (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."),
        (1, None, "user", "Hi."), (1, 4, "assistant", None), (1, 7, None, "Ho."), (1, 9, "assistant", "So."),
        (2, None, "user", "a"), (2, None, "assistant", "a"),
        (3, 5, "user", "Hi."), (3, 5, "user", "Hi."), (3, 5, "user", "Hi."), (3, 6, "assistant", "Oh."),
        (4, -3, "system", "Be."), (4, 2**40, "user", "Far."),
    ]
    found = report(spark, rows)
    assert found[None] == [0, *audited([("user", "Hi."), ("assistant", "Ho.")])]
    assert found[1] == [9 - 4 + 1 - 3, *audited([("user", "Hi."), ("assistant", " "), (" ", "Ho."), ("assistant", "So.")])]
    assert found[2][:5] == [0, 0, 0, 2, 0] or found[2][:5] == [0, 0, 0, 2, 1]
    assert found[3] == [0, *audited([("user", "Hi.")] * 3 + [("assistant", "Oh.")])]
    assert found[4] == [2**40 + 3 + 1 - 2, *audited([("system", "Be."), ("user", "Far.")])]


def test_a_long_conversation_has_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(dialogue, "BLOCK_BITS", 4)
    rng = random.Random(8)
    turns = random_rows(rng, 180)
    rows = [(1, t // 2 * 3, role, f"{text[:-1]}{t}{text[-1:]}") for t, (role, text) in enumerate(turns)]
    by_turn = sorted(rows, key=lambda r: (r[1], hashlib.sha256(f"=1:{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    got = report(spark, [*rows, *[(2, t, "user", "Same.") for t in range(500)]])
    want = audited([(r[2], r[3]) for r in by_turn])
    assert got[1] == [89 * 3 + 1 - 90, *want]
    assert got[2][:6] == [0, 0, 499, 0, 499, 499 * 2 + 2]


def test_very_long_texts_and_conversations(spark):
    rows = [(1, 0, "user", "x" * 3_000_000 + "?"), (1, 1, "assistant", "y" * 3_000_000)]
    rows += [(2, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(20_000)]
    found = report(spark, rows)
    assert found[1] == [0, *audited([(r[2], r[3]) for r in rows[:2]])]
    whole = "\n".join(f"{r[2]}:{r[3]}" for r in rows[2:]).encode()
    assert found[2] == [0, 0, 0, 0, 0, 0, "K" * 20_000, hashlib.sha256(whole).hexdigest()]


def test_other_columns_and_names(spark):
    rows = [(1, 1, "user", "Hi.", "at"), (1, 2, "assistant", "Ho.", "key")]
    found = report(spark, rows, "`c.id` long, `no` int, `who` string, `the``text` string, `key` string", conv_col="c.id", turn_col="no", role_col="who", text_col="the`text")
    assert found[1] == [0, *audited([("user", "Hi."), ("assistant", "Ho.")])]


def test_empty_table(spark):
    assert report(spark, []) == {}


@pytest.mark.parametrize("clash", ["kind", "copy", "at"])
def test_the_query(spark, tmp_path, clash):
    rng = random.Random(5)
    convs = {i: random_rows(rng, rng.randrange(1, 9)) for i in range(60)}
    rows = [(i, t, role, text, "x") for i, turns in convs.items() for t, (role, text) in enumerate(turns)]
    rows += [(None, 3, "user", "Hi.", "x"), (60, None, None, None, "x"), (61, None, "user", None, "x")]
    spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, `{clash}` string").write.parquet(f"{tmp_path}/conversations.parquet")
    want = {}
    for i, t, role, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        kept = want.setdefault(i, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    got = {r["conv_id"]: r for r in QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    for i, kept in want.items():
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        r = got[i]
        assert [r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")] == [gaps, *audited([(a, b) for _, a, b in kept])], i
