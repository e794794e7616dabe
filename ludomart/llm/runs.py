"""Periodic runs of words by string synchronising sets, and texts collapsed by them.

A run is a stretch of words with smallest period q, at least 2q words and ``least`` words long,
that no neighbouring word extends. Words are compared as they are (by 64-bit hashes).

Periods of up to ``SMALL`` words are found by comparing each word with that q words on: these
are the highly periodic regions, which the synchronising sets of larger scales leave out.
At the scale t = 4, 8, 16, ... a position i belongs to the synchronising set if the least hash
among the windows of t words that begin at i, ..., i + t is that of the first or last of them;
windows whose period is at most t / 3 take no part. That hangs on the words i, ..., i + 2t - 1
only, so equal contexts are selected alike, and every t places in a row hold a position unless
the words there have such a short period. Two positions with equal contexts of 2t words propose
their distance as a period, if it lies in 3t - 1, ..., 6t - 2, the periods of this scale. As no
context of 2t words has a period below t / 3, a position has at most 18 partners in reach, and
all of them are taken. A proposal is extended to both sides by comparing hashes of dyadic length.

A run of period q that is shorter than 2q + p can consist of two copies of a text of period
p <= (q + 1) / 9 throughout, in which no position is selected. Then two regions of the period p
touch within it. For each two such regions the lengths that fit their phases are proposed, too.

Texts are worked on in blocks, one after the other with a mark between them that occurs once,
the longest first, so that a scale works on the texts that can hold its periods. A text of n
words takes O(n log n) time and memory, and is never cut.

Defined results: a null or empty text, or one without words, has no runs and collapses to an
empty text; runs are listed by start, then period; repeated rows each get their runs; an empty
table gives an empty table; other columns pass through, and one that is named as a new column
is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ludomart.llm.common import with_columns
from ludomart.llm.words import SPACE, bytes_of, mix, powers

LEAST = 12
# Periods that are found by direct comparison; the first scale of 4 begins at 3 * 4 - 1.
SMALL = 10
FIRST_SCALE = 4

RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])

_C = np.uint64(0xD1342543DE82EF95)
_MARK = np.uint64(0xA24BAED4963EE407)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def split(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, size, hash, first): the bytes of all texts, where each word begins in
    them, its bytes, its hash, and where the words of each row begin (one more at the end)."""
    raw, at = bytes_of(column)
    inside = SPACE[raw] if len(raw) else np.empty(0, bool)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = at[:-1][np.diff(at) > 0]
    starts[heads] = inside[heads]
    begin = np.flatnonzero(starts)
    first = np.searchsorted(begin, at).astype(np.int64)
    if not len(begin):
        none = np.empty(0, np.int64)
        return raw, none, none, np.empty(0, np.uint64), first
    packed = raw[inside].astype(np.uint64) + np.uint64(1)
    offset = np.flatnonzero(starts[inside])
    size = np.diff(np.append(offset, len(packed)))
    place = np.arange(len(packed)) - np.repeat(offset, size)
    h = np.add.reduceat(packed * powers(int(size.max()))[place], offset)
    return raw, begin, size, mix(h + size.astype(np.uint64) * _C), first


class _Dyadic:
    """Hashes of all windows of 2^k words, over the texts that are long enough."""

    def __init__(self, words: np.ndarray, reach: np.ndarray, sizes: np.ndarray):
        """``reach``: where each text, longest first, ends with its mark; ``sizes``: words."""
        self.levels = [words]
        self.ends = reach
        self.sizes = sizes

    def prefix(self, least: int) -> int:
        """Words of the texts that have ``least`` words or more, marks included."""
        n = int(np.searchsorted(-self.sizes, -least, side="right"))
        return int(self.ends[n - 1]) if n else 0

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            half = 1 << (len(self.levels) - 1)
            below = self.levels[-1]
            n = max(min(self.prefix(2 * half), len(below)) - half, 0)
            self.levels.append(mix(below[:n] * _C + below[half : half + n]))
        return self.levels[k]

    def equal(self, k: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the windows of 2^k words at i and j > i are equal. A window that reaches
        beyond its text holds the mark, which no other has."""
        hashes = self.level(k)
        ok = (i >= 0) & (j < len(hashes))
        ok[ok] = hashes[i[ok]] == hashes[j[ok]]
        return ok

    def extend(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far the words before i and j, and those from i and j on, are equal."""
        top = int(self.sizes[0]).bit_length() - 1
        ahead, back = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        for k in range(top, -1, -1):
            ahead += self.equal(k, i + ahead, j + ahead).astype(np.int64) << k
            low = 1 << k
            back += self.equal(k, i - back - low, j - back - low).astype(np.int64) << k
        return back, ahead


def _runs(d: _Dyadic, i: np.ndarray, q: np.ndarray) -> np.ndarray:
    """(start, end, period) of the runs that proposals of period q at i turn out to be."""
    back, ahead = d.extend(i, i + q)
    rows = np.stack([i - back, i + q + ahead, q], axis=1)
    return _least_period(rows[rows[:, 1] - rows[:, 0] >= 2 * q])


def _least_period(rows: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its smallest period, by start and end."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


def _small(words: np.ndarray) -> np.ndarray:
    found = [np.empty((0, 3), np.int64)]
    for q in range(1, min(SMALL, len(words) - 1) + 1):
        same = np.zeros(len(words) - q + 2, np.int8)
        same[1:-1] = words[:-q] == words[q:]
        turn = np.diff(same)
        start, stop = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        long = stop - start >= q
        start, stop = start[long], stop[long]
        found.append(np.stack([start, stop + q, np.full(len(start), q)], axis=1))
    return _least_period(np.concatenate(found))


def _proposals(d: _Dyadic, t: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the pairs of equal contexts at the scale t."""
    k = t.bit_length() - 1
    n = d.prefix(2 * (3 * t - 1))
    windows = d.level(k)[: n - t + 1].copy()
    # Windows with a period of at most t / 3 lie in a run of that period.
    short = known[(known[:, 2] * 3 <= t) & (known[:, 1] - known[:, 0] >= t) & (known[:, 1] <= n)]
    cover = np.zeros(len(windows) + 1, np.int32)
    np.add.at(cover, short[:, 0], 1)
    np.add.at(cover, short[:, 1] - t + 1, -1)
    windows[np.cumsum(cover)[:-1] > 0] = _NONE
    least, step = windows, 1
    while step < t:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:-1], least[1:])
    m = len(least)
    chosen = (least != _NONE) & ((windows[:m] == least) | (windows[t : t + m] == least))
    place = np.flatnonzero(chosen)
    context = d.level(k + 1)
    place = place[place < len(context)]
    context = context[place]
    order = np.argsort(context, kind="stable")
    context, place = context[order], place[order]
    at = np.arange(len(place))
    lo, far, step = [], [], 1
    while len(at := at[at + step < len(place)]):
        apart = place[at + step] - place[at]
        near = (context[at + step] == context[at]) & (apart <= 6 * t - 2)
        at, apart = at[near], apart[near]
        fits = apart >= 3 * t - 1
        lo.append(place[at[fits]])
        far.append(apart[fits])
        step += 1
    none = [np.empty(0, np.int64)]
    return np.concatenate(none + lo), np.concatenate(none + far)


def _touching(d: _Dyadic, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances proposed by two highly periodic regions that touch."""
    p = known[:, 2]
    rows = known[(p > 1) & (known[:, 1] - known[:, 0] >= 9 * p - 1)]
    rows = rows[np.lexsort((rows[:, 0], rows[:, 2]))]
    a, b = rows[:-1], rows[1:]
    both = (a[:, 2] == b[:, 2]) & (b[:, 0] <= a[:, 1])
    a, b = a[both], b[both]
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # The phase: where, in the last two periods of the left region, the right one's words
    # from the left one's end on occur.
    p = a[:, 2]
    pair = np.repeat(np.arange(len(a)), p)
    back = np.arange(len(pair)) - np.repeat(np.cumsum(p) - p, p) + p[pair]
    end, period = a[pair, 1], p[pair]
    same = np.zeros(len(pair), bool)
    level = np.array([int(x).bit_length() - 1 for x in period], np.int64)
    for k in np.unique(level).tolist():
        at = np.flatnonzero(level == k)
        rest = period[at] - (1 << k)
        x, y = end[at] - back[at], end[at]
        same[at] = d.equal(k, x, y) & d.equal(k, x + rest, y + rest)
    pair, back = pair[same], back[same]
    p = p[pair]
    most = np.minimum(a[pair, 1] - a[pair, 0], b[pair, 1] - b[pair, 0])
    first = np.maximum(9 * p - 1, SMALL + 1)
    first = first + (back - first) % p
    count = np.maximum((most - first) // p + 1, 0)
    each = np.repeat(np.arange(len(pair)), count)
    turn = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
    q = first[each] + turn * p[each]
    return a[pair[each], 1] - q, q


def find(h: np.ndarray, first: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(row, start, length, period) of every run, in that order. ``h`` holds the words of all
    rows, ``first`` where those of each row begin (one more entry at the end)."""
    sizes = np.diff(first)
    rows = np.argsort(-sizes, kind="stable")
    rows = rows[sizes[rows] >= 2]
    none = np.empty((0, 4), np.int64)
    if not len(rows):
        return none
    sizes = sizes[rows]
    ends = np.cumsum(sizes + 1)
    begin = ends - sizes - 1
    words = np.empty(int(ends[-1]), np.uint64)
    inside = np.ones(len(words), bool)
    inside[ends - 1] = False
    words[inside] = h[np.arange(int(sizes.sum())) + np.repeat(first[rows] - (np.cumsum(sizes) - sizes), sizes)]
    words[ends - 1] = mix(np.arange(1, len(ends) + 1).astype(np.uint64) * _MARK)
    d = _Dyadic(words, ends, sizes)
    known = _small(words)
    t = FIRST_SCALE
    while d.prefix(2 * (3 * t - 1)):
        i, q = _proposals(d, t, known)
        if len(i):
            known = _least_period(np.concatenate([known, _runs(d, i, q)]))
        t *= 2
    i, q = _touching(d, known)
    if len(i):
        known = _least_period(np.concatenate([known, _runs(d, i, q)]))
    known = known[known[:, 1] - known[:, 0] >= least]
    text = np.searchsorted(ends, known[:, 0], side="right")
    out = np.stack([rows[text], known[:, 0] - begin[text], known[:, 1] - known[:, 0], known[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _collapsed(raw, begin, size, first, found) -> pa.Array:
    """Texts of the words that no run holds after its first period, joined by one space."""
    n = len(first) - 1
    cover = np.zeros(len(begin) + 1, np.int64)
    at = first[found[:, 0]] + found[:, 1]
    np.add.at(cover, at + found[:, 3], 1)
    np.add.at(cover, at + found[:, 2], -1)
    kept = np.cumsum(cover)[:-1] == 0
    row = np.repeat(np.arange(n), np.diff(first))[kept]
    begin, size = begin[kept], size[kept]
    gap = np.zeros(len(row), np.int64)
    gap[:-1] = row[1:] == row[:-1]
    stop = np.cumsum(size + gap)
    total = int(stop[-1]) if len(stop) else 0
    out = np.full(total, 0x20, np.uint8)
    start = stop - size - gap
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[inner + np.repeat(start, size)] = raw[inner + np.repeat(begin, size)]
    offsets = np.concatenate([[0], stop])[np.searchsorted(row, np.arange(n + 1))].astype(np.int64)
    made = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes()))
    return made.cast(pa.string())


def detect(
    df: DataFrame,
    text: str = "text",
    runs: str = "runs",
    collapsed: str = "collapsed",
    keep: list[str] | None = None,
    least: int = LEAST,
) -> DataFrame:
    """``df`` with its ``runs`` (array of start, length, period, in words from 0) and the text
    ``collapsed`` to the first period of each run."""

    def make():
        def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
            raw, begin, size, h, first = split(part.column(text))
            found = find(h, first, least)
            offsets = np.searchsorted(found[:, 0], np.arange(len(first))).astype(np.int32)
            cells = [pa.array(found[:, c]) for c in (1, 2, 3)]
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(cells, names=RUN.names))
            return {runs: listed, collapsed: _collapsed(raw, begin, size, first, found)}

        return work

    fields = [StructField(runs, ArrayType(RUN)), StructField(collapsed, StringType())]
    return with_columns(df, text, fields, make, keep)
