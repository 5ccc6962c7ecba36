"""Algebra of run-length coded masks on their sorted intervals, without decoding: and, or, minus, windows, overlaps."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from taxaflow.functions.rasters import encode_runs, rle_runs


class Window(NamedTuple):
    """Where a mask's array lies in its image."""

    x: int
    y: int
    height: int
    width: int

    @property
    def size(self) -> int:
        return self.height * self.width


class Intervals(NamedTuple):
    """Sorted disjoint intervals of column-major places that are set."""

    start: np.ndarray
    stop: np.ndarray

    @property
    def pixels(self) -> int:
        return int((self.stop - self.start).sum())


def intervals(code: str) -> Intervals:
    return of_lengths(np.array(rle_runs(code), np.int64))


def of_lengths(lengths: np.ndarray) -> Intervals:
    """The set places of runs, zeros first."""
    places = np.cumsum(lengths)
    stop = places[1::2]
    start = places[0::2][: len(stop)]
    full = stop > start
    return Intervals(start[full], stop[full])


def coded(a: Intervals, size: int) -> str:
    """The code of intervals in an array of so many pixels; intervals that touch become one run."""
    if not size:
        return ""
    gap = np.concatenate([[True], a.start[1:] > a.stop[:-1]]) if len(a.start) else np.zeros(0, bool)
    start, stop = a.start[gap], a.stop[np.concatenate([gap[1:], [True]])] if len(gap) else a.stop
    places = np.stack([start, stop], 1).ravel()
    runs = np.diff(np.concatenate([[0], places, [size]])).tolist()
    return encode_runs(runs if runs[-1] or len(runs) == 1 else runs[:-1])


def both(a: Intervals, b: Intervals) -> Intervals:
    """Places of both, by one search of each interval's neighbours in the other list."""
    low, high = np.searchsorted(b.stop, a.start, "right"), np.searchsorted(b.start, a.stop, "left")
    n = np.maximum(high - low, 0)
    of_a = np.repeat(np.arange(len(n)), n)
    of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(n) - n, n) + low[of_a]
    return Intervals(np.maximum(a.start[of_a], b.start[of_b]), np.minimum(a.stop[of_a], b.stop[of_b]))


def outside(a: Intervals, size: int) -> Intervals:
    start, stop = np.concatenate([[0], a.stop]), np.concatenate([a.start, [size]])
    full = stop > start
    return Intervals(start[full], stop[full])


def minus(a: Intervals, b: Intervals, size: int) -> Intervals:
    return both(a, outside(b, size))


def either(a: Intervals, b: Intervals, size: int) -> Intervals:
    return outside(both(outside(a, size), outside(b, size)), size)


def moved(a: Intervals, own: Window, to: Window) -> Intervals:
    """The intervals of a mask in another window of the same image; what lies outside that is cut off.

    Intervals are cut at the ends of columns, so that each part is a column with two rows.
    """
    if not len(a.start) or not own.height:
        return Intervals(*np.zeros((2, 0), np.int64))
    first, last = a.start // own.height, (a.stop - 1) // own.height
    n = last - first + 1
    of = np.repeat(np.arange(len(n)), n)
    column = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + first[of]
    top = np.where(column == first[of], a.start[of] % own.height, 0)
    bottom = np.where(column == last[of], (a.stop[of] - 1) % own.height + 1, own.height)
    x, y = column + own.x - to.x, own.y - to.y
    top, bottom = np.clip(top + y, 0, to.height), np.clip(bottom + y, 0, to.height)
    there = (x >= 0) & (x < to.width) & (bottom > top)
    return Intervals((x * to.height + top)[there], (x * to.height + bottom)[there])


def overlap(a: str, own: Window, b: str, other: Window) -> int:
    """Pixels of the image that two masks share."""
    return both(intervals(a), moved(intervals(b), other, own)).pixels


def restricted(part: str, own: Window, mask: str, other: Window) -> str:
    """The pixels of a part's mask that lie in another mask, in the part's window."""
    return coded(both(intervals(part), moved(intervals(mask), other, own)), own.size)


def extent(code: str, height: int) -> tuple[int, int, int, int] | None:
    """First and last column and row (x1, y1, x2, y2) of a mask; None if it has no pixels."""
    a = intervals(code)
    if not len(a.start):
        return None
    spans = moved(a, Window(0, 0, height, 1 << 40), Window(0, 0, height, 1 << 40))
    return int(a.start[0] // height), int((spans.start % height).min()), int((a.stop[-1] - 1) // height), int(((spans.stop - 1) % height).max())


def border_coverage(code: str, height: int, width: int) -> float:
    """Part of an array's outline that a mask covers; corners count for both their sides."""
    a = intervals(code)
    left, right = (np.clip(a.stop, x, x + height) - np.clip(a.start, x, x + height) for x in (0, (width - 1) * height))
    top, bottom = -(-a.stop // height) + -a.start // height, a.stop // height - a.start // height
    return int(sum(side.sum() for side in (left, right, top, bottom))) / (2 * (height + width))
