"""Repair of the turn structure of conversations at least cost."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaflow.llm.common import bounded, join_groups, materialise, named
from taxaflow.llm.lines import BLANKS

#: Rows of a conversation whose codes one aggregation brings together are 2 ** BLOCK_BITS at most.
BLOCK_BITS = 12
#: Roles by their initial; faults of a row, the first that holds.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
PLAIN, TRUNCATED, BLANK, DUPLICATE = range(4)
#: Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, STAYS_TRUNCATED = 0, 1, 2, 5, 5
#: States of the grammar (s?(ua)+)? and where a role leads from them.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
GO = {(START, SYSTEM): AFTER_SYSTEM, (START, USER): AFTER_USER, (AFTER_SYSTEM, USER): AFTER_USER, (AFTER_USER, ASSISTANT): AFTER_ASSISTANT, (AFTER_ASSISTANT, USER): AFTER_USER}
ENDS = (START, AFTER_ASSISTANT)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: A relative cost that stands for "not reachable"; real ones stay below it, as two insertions lead to any later state.
FAR = 255


class Arc(NamedTuple):
    """An edit from a state: its letter, its cost, the state it leads to and its mark.

    Marks: K keeps, D deletes, u and a give the row this role, U and A insert an empty text of this role.
    """

    letter: str
    cost: int
    to: int
    mark: str


def _row_arcs(code: int, state: int) -> list[Arc]:
    fault, role = divmod(code, 4)
    arcs = [Arc("D", DELETE, state, "D")]
    if fault in (BLANK, DUPLICATE):
        return arcs
    more = STAYS_TRUNCATED * (fault == TRUNCATED)
    if (state, role) in GO:
        arcs.append(Arc("K", KEEP + more, GO[state, role], "K"))
    return arcs + [Arc("R", REROLE + more, GO[state, to], mark) for to, mark in ((USER, "u"), (ASSISTANT, "a")) if (state, to) in GO]


ROW_ARCS = {(code, state): _row_arcs(code, state) for code in range(16) for state in range(4)}
INSERTIONS = {state: Arc("I", INSERT, GO[state, to], mark) for to, mark in ((USER, "U"), (ASSISTANT, "A")) for state in range(4) if (state, to) in GO}


class Costs:
    """Least costs of the four states at each layer: a base, and four bytes above it."""

    def __init__(self, layers: int):
        self.base, self.above = array("q", bytes(8 * layers)), bytearray(4 * layers)

    def put(self, layer: int, costs: list[float]) -> None:
        self.base[layer] = least = int(min(costs))
        self.above[4 * layer : 4 * layer + 4] = bytes(FAR if c - least >= FAR else int(c - least) for c in costs)

    def at(self, layer: int, state: int) -> float:
        above = self.above[4 * layer + state]
        return float("inf") if above == FAR else self.base[layer] + above


def _forward(codes: bytes) -> Costs:
    """Least cost from the start to each state, before each row and after the last."""
    found, now = Costs(len(codes) + 1), [0.0, float("inf"), float("inf"), float("inf")]
    for i in range(len(codes) + 1):
        for _ in range(2):  # two insertions reach all that insertions reach at least cost
            for state, arc in INSERTIONS.items():
                now[arc.to] = min(now[arc.to], now[state] + arc.cost)
        found.put(i, now)
        if i < len(codes):
            after = [float("inf")] * 4
            for state in range(4):
                for arc in ROW_ARCS[codes[i], state]:
                    after[arc.to] = min(after[arc.to], now[state] + arc.cost)
            now = after
    return found


def _backward(codes: bytes) -> Costs:
    """Least cost from each state to an end of the grammar, before each row and after the last."""
    found, now = Costs(len(codes) + 1), [0.0 if s in ENDS else float("inf") for s in range(4)]
    for i in range(len(codes), -1, -1):
        if i < len(codes):
            now = [min(arc.cost + now[arc.to] for arc in ROW_ARCS[codes[i], state]) for state in range(4)]
        for _ in range(2):
            for state, arc in INSERTIONS.items():
                now[state] = min(now[state], arc.cost + now[arc.to])
        found.put(i, now)
    return found


def cheapest(codes: bytes) -> tuple[int, str, list[str]]:
    """Cost, audit and each row's marks (those of insertions before it first; after the last row, those behind it too).

    The arcs of all cheapest repairs are those tight between both directions: forward cost, own cost and backward cost
    add up to the total. From the set of states reached so far, the least letter among their tight arcs is taken, by
    all states that have it, until an end is reached.
    """
    forward, backward = _forward(codes), _backward(codes)
    total = backward.at(0, START)
    audit, marks, before = bytearray(), [], ""
    frontier, i = {START}, 0
    while not (i == len(codes) and any(s in ENDS and forward.at(i, s) == total for s in frontier)):
        tight = [a for s in frontier for a in (INSERTIONS[s],) if forward.at(i, s) + a.cost + backward.at(i, a.to) == total]
        if i < len(codes):
            tight += [a for s in frontier for a in ROW_ARCS[codes[i], s] if forward.at(i, s) + a.cost + backward.at(i + 1, a.to) == total]
        letter = min(a.letter for a in tight)
        taken = [a for a in tight if a.letter == letter]
        frontier = {a.to for a in taken}
        audit += letter.encode()
        before += taken[0].mark  # states are reached by letters in one way only, so all have the same mark
        if letter != "I":
            marks.append(before)
            before, i = "", i + 1
    if before:
        marks[-1] += before
    return int(total), audit.decode(), marks


def _coded(faults: int, role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    return F.lit(4 * faults) + F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)


REPORT = T.StructType([*[T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")], T.StructField("audit", T.StringType()), T.StructField("marks", T.ArrayType(T.StringType()))])


@F.pandas_udf(REPORT)
def _repairs(blocks: pd.Series) -> pd.DataFrame:
    """The report of each conversation, from the codes of its blocks in order; marks: each block's rows, by spaces."""
    out = []
    for parts in blocks:
        codes = bytes(c - 65 for c in "".join(parts).encode())
        faults = [c >> 2 for c in codes]
        illegal = sum((a & 3, b & 3) not in LEGAL for a, b in zip(codes, codes[1:], strict=False))
        cost, audit, marks = cheapest(codes)
        done, of_blocks = 0, []
        for p in parts:
            of_blocks.append(" ".join(marks[done : done + len(p)]))
            done += len(p)
        out.append((faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal, cost, audit, of_blocks))
    return pd.DataFrame(out, columns=REPORT.names)


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(key, conv_id, turn, role, text, pair, fault, at): the rows in order of conversation and turn, nulls first, kept.

    at grows in this order. Rows of one turn are ordered by pair, a digest of conversation, role and text. Nulls in role
    and text are one space. Ranges of the order are dealt out, so a conversation of any length has many tasks.
    """
    given = turns.select(
        F.coalesce(F.concat(F.lit("="), named(conv_col).cast("string")), F.lit("")).alias("key"), named(conv_col).alias("conv_id"), named(turn_col).alias("turn"),
        *[F.coalesce(named(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))],
    )
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), PLAIN).otherwise(TRUNCATED)
    said = F.concat("key", F.lit(":"), F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    marked = given.withColumns({"fault": fault, "pair": F.unhex(F.substring(F.sha2(said, 256), 1, 32))})
    order = ["key", "turn", "pair"]
    return materialise(marked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "turns", "zstd")


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The report of each conversation, and its repaired turns.

    Report: (key, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit). Turns: (key, conv_id, at, part, edit,
    role, text), ordered by at and part within a conversation; edit is the mark (see Arc).

    A row's fault is the first of blank (no character but white space), duplicate (role and text as in an earlier row)
    and truncated (the last such character does not end a sentence). Edits are the cheapest that give roles of the
    grammar (s?(ua)+)?, and of these the least letters, by forward and backward least costs and their tight arcs.

    Rows with a null conversation are one conversation; null turns come first and count in no gap; nulls in role and
    text are one space, so such a text is blank. Of repeated rows all but the first are duplicates. Rows of one turn are
    ordered by a digest of role and text. Texts of any length move, but only codes of rows meet: a conversation of any
    length has its codes put together in blocks, and 24 bytes a row where its repair is found. Other columns are not
    read, and columns of any name can be the four; an empty table gives no rows.
    """
    bounded(turns.sparkSession)
    rows = ordered_turns(turns, conv_col, turn_col, role_col, text_col)
    light = rows.select("key", "conv_id", "turn", "role", "pair", "fault", "at")
    firsts = materialise(light.groupBy("pair").agg(F.min("at").alias("first"), F.count("*").alias("copies")).filter("copies > 1"), "repeated-turns")
    known = join_groups(light, firsts, "pair", "copies", light.count())
    repeated = F.col("at") > F.col("first")
    code = F.when(F.col("fault") == BLANK, _coded(BLANK, F.col("role"))).when(repeated, _coded(DUPLICATE, F.col("role"))).when(F.col("fault") == TRUNCATED, _coded(TRUNCATED, F.col("role"))).otherwise(_coded(PLAIN, F.col("role")))
    coded = known.select("key", "conv_id", "turn", "at", F.chr(F.lit(65) + code).alias("code"), F.shiftright("at", BLOCK_BITS).alias("block"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda x: x["code"])
    blocks = coded.groupBy("key", "block").agg(
        F.min("at").alias("start"), F.array_join(in_order, "").alias("codes"), F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.size(F.collect_set("turn")).alias("turns"), F.any_value("conv_id").alias("conv_id"),
    )
    whole = blocks.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("block", "start", "codes", "low", "high", "turns"))).alias("blocks"), F.any_value("conv_id").alias("conv_id"))
    # a turn whose rows end one block and begin the next is counted in both
    met = F.aggregate(
        "blocks", F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast(turns.schema[turn_col].dataType).alias("high")),
        lambda s, b: F.struct((s["n"] + b["turns"] - F.coalesce((s["high"] == b["low"]).cast("int"), F.lit(0))).alias("n"), F.coalesce(b["high"], s["high"]).alias("high")),
    )["n"]
    gaps = F.coalesce(F.array_max(F.col("blocks.high")) - F.array_min(F.col("blocks.low")) + 1 - met, F.lit(0)).cast("long")
    report = materialise(whole.withColumn("gaps", gaps).withColumn("found", _repairs(F.col("blocks.codes"))).select("key", "conv_id", "gaps", "found.*", F.col("blocks.start").alias("starts")), "repairs")
    marks = report.select(F.explode(F.arrays_zip("starts", "marks")).alias("b")).select("b.starts", F.posexplode(F.split("b.marks", " ")).alias("pos", "edits")).select((F.col("starts") + F.col("pos")).alias("at"), "edits")
    edited = rows.select("key", "conv_id", "at", "role", "text").join(marks.filter("edits <> 'D'"), "at")
    each = edited.select("key", "conv_id", "at", "role", "text", F.posexplode(F.split("edits", "")).alias("part", "edit")).filter("edit <> 'D'")
    mark = F.col("edit")
    role = F.when(mark == "K", F.col("role")).when(F.lower(mark) == "u", "user").otherwise("assistant")
    repaired = each.select("key", "conv_id", "at", "part", "edit", role.alias("role"), F.when(mark.isin("U", "A"), "").otherwise(F.col("text")).alias("text"))
    return report.drop("marks", "starts"), repaired


def transcript_digests(turns: DataFrame) -> DataFrame:
    """(key, sha256) of each conversation's lines "role:text", joined by newlines; turns as repair() gives them.

    A digest of a whole is sequential by nature: a conversation's lines pass one task in order, a batch at a time, and
    none is held.
    """

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            for k, line in zip(batch["key"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if k == key:
                    digest.update(b"\n")
                else:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                digest.update(line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done, strict=True)], ["key", "sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "sha256"])

    lines = turns.select("key", "at", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("key").sortWithinPartitions("key", "at", "part").select("key", "line").mapInArrow(hashed, "key string, sha256 string")
