"""Bounded-space online packing of token ids into sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import materialise, release_memory
from taxaflow.llm.tokens import encoder, tokenizer_path

#: Leftover windows that one task merges.
MERGED = 256
#: A sequence's number: the level of merging, then the partition or group, then the count within it.
LEVEL, PLACE = 58, 34

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
    ]
)
PIECE_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


@dataclass
class Piece:
    doc_id: int | None
    start: int
    doc_tokens: int
    ids: bytes  # four to a token

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first n tokens, and the rest."""
        rest = Piece(self.doc_id, self.start + n, self.doc_tokens, self.ids[4 * n :])
        return Piece(self.doc_id, self.start, self.doc_tokens, self.ids[: 4 * n]), rest

    def __len__(self) -> int:
        return len(self.ids) // 4


@dataclass
class Window:
    room: int
    pieces: list[Piece] = field(default_factory=list)

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.room -= len(piece)


class Packer:
    """Keeps `most` windows open. A document's last part goes to the open window that it leaves least room in.

    Where it fits none, the fullest window takes what it can of it and is emitted, and the rest opens a window.
    """

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open = size, most, []

    def place(self, piece: Piece) -> Iterator[Window]:
        while len(piece) >= self.size:
            head, piece = piece.cut(self.size)
            full = Window(self.size)
            full.put(head)
            yield full
        if not len(piece):
            return
        best = min((w for w in self.open if w.room >= len(piece)), key=lambda w: w.room, default=None)
        if best is None:
            if len(self.open) == self.most:
                fullest = min(self.open, key=lambda w: w.room)
                head, piece = piece.cut(fullest.room)
                fullest.put(head)
                self.open.remove(fullest)
                yield fullest
            best = Window(self.size)
            self.open.append(best)
        best.put(piece)
        if best.room == 0:
            self.open.remove(best)
            yield best

    def merge(self) -> Iterator[Window]:
        """The open windows, poured together; the last one can have room left."""
        now = Window(self.size)
        for window in sorted(self.open, key=lambda w: w.room):
            for piece in window.pieces:
                if len(piece) >= now.room:
                    head, piece = piece.cut(now.room)
                    now.put(head)
                    yield now
                    now = Window(self.size)
                if len(piece):
                    now.put(piece)
        self.open = []
        if now.pieces:
            yield now


def powers(window: Window) -> Iterator[Window]:
    """A window as windows whose lengths are powers of two, the longest first; they need no padding."""
    left = sum(map(len, window.pieces))
    pieces = list(window.pieces)
    while left:
        now = Window(1 << (left.bit_length() - 1))
        left -= now.room
        while now.room:
            head, rest = pieces[0].cut(min(now.room, len(pieces[0])))
            now.put(head)
            pieces[0:1] = [rest] if len(rest) else []
        yield now


class Rows:
    """Pieces as record batches; only windows that are still to be merged keep their ids."""

    def __init__(self, first: int):
        self.next, self.rows = first, []

    def add(self, window: Window, keep_ids: bool) -> None:
        offset = 0
        for p in window.pieces:
            self.rows.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, self.next, offset, p.ids if keep_ids else None))
            offset += len(p)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in PIECE]
        self.rows = []
        return pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, PIECE, strict=True)], schema=PIECE)


def _sequence_space(level: int, place: int) -> int:
    return (level << LEVEL) | (place << PLACE)


def _windows(left: DataFrame) -> int:
    return left.select(F.countDistinct("sequence_id")).first()[0]


def _merge_level(left: DataFrame, level: int, size: int) -> DataFrame:
    """Leftover windows in groups of about MERGED, each poured together; a group leaves one window at most."""
    place = F.shiftright(F.col("sequence_id").bitwiseAND(F.lit((1 << LEVEL) - 1)), PLACE)

    def merged(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        packer, windows = Packer(size, 0), {}
        for r in rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            window = windows.setdefault(r["sequence_id"], Window(size))
            window.put(Piece(r["doc_id"], r["start"], r["doc_tokens"], r["ids"]))
        packer.open = list(windows.values())
        out = Rows(_sequence_space(level, key[0].as_py()))
        for window in packer.merge():
            out.add(window, keep_ids=window.room > 0)
        return pa.Table.from_batches([out.batch()])

    grouped = left.withColumn("into", F.floor(place / MERGED).cast("long"))
    return grouped.groupBy("into").applyInArrow(merged, PIECE_DDL)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, open_windows: int = 32,
    end_id: int = 1, tokenizer: str | None = None,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every document.

    A document is its text's token ids, then end_id; a null or empty text is end_id alone. Each partition packs
    its rows online with open_windows windows and at its end pours the open ones together, which leaves one
    window at most. These are merged, MERGED in a task, until one is left, and that one is cut into sequences
    whose lengths are powers of two. So no sequence needs padding. Repeated rows and rows with a null id are
    packed like others, a text of any length is cut where sequences end, and an empty table gives no rows.
    """
    path = tokenizer or tokenizer_path()
    end = end_id.to_bytes(4, "little")

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(path).id_bytes, Packer(size, open_windows)
        out = Rows(_sequence_space(0, TaskContext.get().partitionId()))
        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                ids = encode(text.as_py()) + end
                for window in packer.place(Piece(doc_id.as_py(), 0, len(ids) // 4, ids)):
                    out.add(window, keep_ids=False)
                if len(out.rows) > 20_000:
                    yield out.batch()
        for window in packer.merge():
            out.add(window, keep_ids=window.room > 0)
        yield out.batch()
        release_memory()

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    done = materialise(given.mapInArrow(packed, PIECE_DDL), "packed")
    parts, level = [done.filter("ids IS NULL")], 1
    left = done.filter("ids IS NOT NULL")
    while _windows(left) > 1:
        merged = materialise(_merge_level(left, level, size), f"merged-{level}")
        parts.append(merged.filter("ids IS NULL"))
        left, level = merged.filter("ids IS NOT NULL"), level + 1

    def last(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        whole = Window(size)
        for r in rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            whole.put(Piece(r["doc_id"], r["start"], r["doc_tokens"], r["ids"]))
        out = Rows(_sequence_space(level, 0))
        for window in powers(whole):
            out.add(window, keep_ids=False)
        return pa.Table.from_batches([out.batch()])

    # one window is left, of fewer than `size` tokens
    parts.append(left.groupBy(F.lit(0).alias("all")).applyInArrow(last, PIECE_DDL))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.drop("ids")
