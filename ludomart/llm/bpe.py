"""Byte-level BPE by replaying merges over the pieces of a block of texts.

The texts are cut into pieces by the tokenizer's pattern. A task takes its texts in blocks and
sets the pieces it has not met before one after the other as a single row of byte tokens. An
inverted index maps each merge, by its rank, to the positions of the token pairs that it joins;
the merges are replayed over the whole block in order of rank, each at the positions of its own
list, from left to right. A merge changes two neighbour pairs, which enter the lists of their
ranks; a list may hold positions that an earlier merge has changed, which are skipped. Long lists
are merged as arrays, where no two of their pairs overlap and no merge of an earlier rank becomes
possible; else position by position. No piece is ever scanned again. A piece's ids are kept for the next blocks of the task, up to
``KEPT_BYTES`` of pieces, after which the task starts anew: that costs time and changes no id.

Pieces are independent, so any order of blocks gives the same ids, and no shuffle is needed.
The pattern and the ranks are parameters; the ranks are read on the driver and broadcast (their
size is that of the vocabulary file, whatever the texts).

Defined results: a null text is empty and has no ids; decoding a null list gives no bytes;
texts of any length are taken whole; repeated rows each get their ids; an empty table gives an
empty table; other columns pass through and one that is named as a new column is replaced.
Special tokens have no meaning: their text is encoded as any other.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from ludomart.llm.common import with_columns
from ludomart.llm.words import bytes_of

# Bytes of text whose pieces are replayed at once, and of known pieces that a task keeps.
BLOCK_BYTES = 4 << 20
KEPT_BYTES = 48 << 20
# What a known piece takes besides its bytes, about, and the token ids decoded at once.
PIECE_BYTES = 64
DECODED_IDS = 1 << 20
# Positions of a merge from which on they are merged as arrays.
LONG_LIST = 48
_TOKEN = (1 << 32) - 1


class Ranks:
    """A vocabulary as plain arrays: the bytes of all tokens and the pairs that join to one."""

    def __init__(self, tokens: dict[bytes, int]):
        by_id = sorted(tokens.items(), key=lambda item: item[1])
        self.ids = np.array([i for _, i in by_id], np.int64)
        self.offsets = np.cumsum([0, *(len(b) for b, _ in by_id)], dtype=np.int64)
        self.data = np.frombuffer(b"".join(b for b, _ in by_id), np.uint8)
        # The id of each single byte; -1 where the vocabulary has none.
        self.bytes = np.array([tokens.get(bytes([b]), -1) for b in range(256)], np.int64)
        # Any two tokens whose bytes together are a token may merge to it, at its rank.
        pairs = {}
        for whole, rank in tokens.items():
            for cut in range(1, len(whole)):
                a, b = tokens.get(whole[:cut]), tokens.get(whole[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.pairs = keys
        self.merged = np.array([pairs[k] for k in keys.tolist()], np.int64)
        # The same with the right token first, and the pairs in order of rank.
        turned = (keys & _TOKEN) << 32 | keys >> 32
        order = np.argsort(turned)
        self.turned, self.turned_merged = turned[order], self.merged[order]
        order = np.argsort(self.merged, kind="stable")
        self.ranked, self.ranks = keys[order], self.merged[order]

    def plain(self) -> dict[str, np.ndarray]:
        return dict(self.__dict__)


def read_ranks(path: str) -> Ranks:
    """Ranks from a file of lines ``base64-token rank``."""
    with open(path, "rb") as lines:
        return Ranks({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())})


def _ranks_beside(token: int, others: np.ndarray, keys: np.ndarray, merged: np.ndarray) -> np.ndarray:
    """Rank of the pair of ``token`` and each of ``others`` in sorted ``keys``; -1 where there is none."""
    lo, hi = np.searchsorted(keys, (token << 32, (token + 1) << 32))
    if lo == hi:
        return np.full(len(others), -1)
    near = keys[lo:hi] & _TOKEN
    at = np.minimum(np.searchsorted(near, others), hi - lo - 1)
    return np.where(near[at] == others, merged[lo:hi][at], -1)


def _merge_all(now: int, places: list[int], token: np.ndarray, right: np.ndarray, left: np.ndarray, v: dict[str, np.ndarray]):
    """Merge the pairs of rank ``now`` at ``places`` at once: (ranks, positions) of the pairs that
    come of it; None, and nothing merged, where their order counts."""
    i = np.unique(np.array(places, np.int64))
    i = i[(token[i] >= 0) & (right[i] >= 0)]
    key = token[i] << 32 | token[right[i]]
    lo, hi = np.searchsorted(v["ranks"], (now, now + 1))
    fits = np.zeros(len(i), bool)
    for known in v["ranked"][lo:hi].tolist():
        fits |= key == known
    i = i[fits]
    j = right[i]
    if (i[1:] == j[:-1]).any():  # overlapping pairs, as in a run of one token
        return None
    k, h = right[j], left[i]
    after = np.where(k >= 0, token[k], -1)
    before = np.where(h >= 0, token[h], -1)
    follow = _ranks_beside(now, after, v["pairs"], v["merged"])
    lead = _ranks_beside(now, before, v["turned"], v["turned_merged"])
    twice = int(_ranks_beside(now, np.array([now]), v["pairs"], v["merged"])[0])
    if any(((r >= 0) & (r < now)).any() for r in (follow, lead, np.array([twice]))):
        return None
    token[i], token[j], right[i] = now, -1, k
    left[k[k >= 0]] = i[k >= 0]
    # Where two merged pairs touch, the new pair is that of both, listed with the first.
    touch = i[1:] == k[:-1]
    follow[:-1][touch] = twice
    lead[1:][touch] = -1
    return np.concatenate([follow[follow >= 0], lead[lead >= 0]]), np.concatenate([i[follow >= 0], h[lead >= 0]])


def replay(pieces: list[bytes], v: dict[str, np.ndarray], pair_ranks: dict[int, int]) -> list[list[int]]:
    """The ids of each piece."""
    import heapq

    raw = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    tokens = v["bytes"][raw]
    if (tokens < 0).any():
        raise ValueError("the vocabulary lacks a single byte")
    n = len(tokens)
    # Positions as a linked list; a piece's last token points to itself.
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    after[ends - 1] = -1
    before[np.concatenate([[0], ends[:-1]])] = -1

    # The inverted index: positions of the left token by rank of the merge.
    key = tokens[:-1] << 32 | tokens[1:]
    at = np.minimum(np.searchsorted(v["pairs"], key), max(len(v["pairs"]) - 1, 0))
    known = (v["pairs"][at] == key) & (after[:-1] >= 0) if len(v["pairs"]) else np.zeros(n - 1, bool)
    where = np.flatnonzero(known)
    rank = v["merged"][at[where]] if len(where) else np.empty(0, np.int64)
    order = np.argsort(rank, kind="stable")
    where, rank = where[order], rank[order]
    first = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(rank) else np.empty(0, np.int64)
    index = {
        r: p.tolist() for r, p in zip(rank[first].tolist(), np.split(where, first[1:]), strict=True)
    } if len(rank) else {}
    queue = list(index)
    heapq.heapify(queue)

    # One memory each, for single positions and for arrays of them.
    token, right, left = (array("q", x.astype(np.int64).tobytes()) for x in (tokens, after, before))
    views = [np.frombuffer(x, np.int64) for x in (token, right, left)]
    find = pair_ranks.get
    while queue:
        now = heapq.heappop(queue)
        places = index.pop(now)
        made = _merge_all(now, places, *views, v) if len(places) >= LONG_LIST else None
        if made is not None:
            ranks, where = made
            order = np.argsort(ranks, kind="stable")
            ranks, where = ranks[order], where[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            firsts = ranks[np.append(0, cuts)].tolist() if len(ranks) else []
            for r, p in zip(firsts, np.split(where, cuts), strict=False):
                if r in index:
                    index[r].extend(p.tolist())
                else:
                    index[r] = p.tolist()
                    heapq.heappush(queue, r)
            continue
        places.sort()
        for done, i in enumerate(places):
            j = right[i]
            # A position that a merge has changed since it was listed no longer fits.
            if j < 0 or token[i] < 0 or find(token[i] << 32 | token[j]) != now:
                continue
            token[i], token[j] = now, -1
            k = right[i] = right[j]
            lower = False
            if k >= 0:
                left[k] = i
                r = find(now << 32 | token[k])
                if r is not None:
                    if r in index:
                        index[r].append(i)
                    else:
                        index[r] = [i]
                        heapq.heappush(queue, r)
                    lower = r < now
            h = left[i]
            if h >= 0:
                r = find(token[h] << 32 | now)
                if r is not None:
                    if r in index:
                        index[r].append(h)
                    else:
                        index[r] = [h]
                        heapq.heappush(queue, r)
                    lower = lower or r < now
            if lower:  # a merge of an earlier rank has become possible: it comes first
                rest = places[done + 1 :]
                if rest:
                    index[now] = rest
                    heapq.heappush(queue, now)
                break

    ids = views[0]
    live = np.concatenate([[0], np.cumsum(ids >= 0)])
    kept = ids[ids >= 0].tolist()
    cuts = live[ends].tolist()
    return [kept[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]


def _encoder(shared, pattern: str, kept_bytes: int) -> Callable[[pa.RecordBatch, str], pa.Array]:
    import regex

    v = shared.value
    data, at = v["data"].tobytes(), v["offsets"].tolist()
    whole = {data[a:b]: i for a, b, i in zip(at, at[1:], v["ids"].tolist(), strict=False)}
    pair_ranks = dict(zip(v["pairs"].tolist(), v["merged"].tolist(), strict=True))
    cut = regex.compile(pattern)
    # Known pieces by number; the ids of all of them in a row, and where each one's begin.
    known: dict[str, int] = {}
    flat, begin = array("i"), array("q", [0])
    size = 0

    def learn(piece: str, ids: list[int]):
        known[piece] = len(begin) - 1
        flat.extend(ids)
        begin.append(len(flat))

    def encode(column: pa.Array) -> pa.Array:
        nonlocal size
        texts = [cut.findall(t) if t else [] for t in column.to_pylist()]
        new = set().union(*texts).difference(known)
        if new and size > kept_bytes:
            known.clear()
            del flat[:], begin[1:]
            size = 0
            new = set().union(*texts)
        raw = {p: p.encode() for p in new}
        size += sum(map(len, raw.values())) + PIECE_BYTES * len(raw)
        # A piece that is a token itself needs no merge.
        parts = []
        for p, b in raw.items():
            if b in whole:
                learn(p, [whole[b]])
            else:
                parts.append(p)
        if parts:
            for p, ids in zip(parts, replay([raw[p] for p in parts], v, pair_ranks), strict=True):
                learn(p, ids)
        pieces = np.array([len(t) for t in texts], np.int64)
        number = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), np.int64, pieces.sum())
        del texts
        at = np.array(begin)
        first, count = at[number], np.diff(at)[number]
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = np.array(flat)[np.arange(ends[-1]) + np.repeat(first - ends[:-1], count)]
        offsets = ends[np.concatenate([[0], np.cumsum(pieces)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))

    return encode


def encode(
    df: DataFrame,
    ranks: Ranks,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
    kept_bytes: int = KEPT_BYTES,
) -> DataFrame:
    """``df`` with the column ``ids`` (array of int): the token ids of the whole text."""
    shared = df.sparkSession.sparkContext.broadcast(ranks.plain())

    def make():
        work = _encoder(shared, pattern, kept_bytes)
        return lambda part: {ids: work(part.column(text))}

    return with_columns(df, text, [StructField(ids, ArrayType(IntegerType()))], make, keep, block_bytes)


def _decoder(shared) -> Callable[[pa.Array], pa.Array]:
    v = shared.value
    place = np.full(int(v["ids"].max(initial=-1)) + 1, -1, np.int64)
    place[v["ids"]] = np.arange(len(v["ids"]))
    start, length = v["offsets"][:-1], np.diff(v["offsets"])

    def work(lists: pa.Array) -> pa.Array:
        ids = lists.flatten()
        if ids.null_count:
            raise ValueError("a null among token ids")
        flat = ids.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(flat) and (flat.min() < 0 or flat.max() >= len(place) or (place[flat] < 0).any()):
            raise ValueError("an id that is no token")
        at = place[flat]
        size = length[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        # The bytes of all tokens, gathered at once.
        out = v["data"][np.arange(ends[-1]) + np.repeat(start[at] - ends[:-1], size)]
        count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = ends[np.concatenate([[0], np.cumsum(count)])].astype(np.int64)
        made = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lists), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())]
        )
        return made.cast(pa.binary())

    return work


def decode(
    df: DataFrame, ranks: Ranks, ids: str = "ids", decoded: str = "decoded", keep: list[str] | None = None
) -> DataFrame:
    """``df`` with the column ``decoded`` (binary): the bytes of its token ids. An id that the
    vocabulary does not hold stops the job."""
    shared = df.sparkSession.sparkContext.broadcast(ranks.plain())
    kept = [c for c in (df.columns if keep is None else keep) if c != decoded]
    inputs = list(dict.fromkeys([*kept, ids]))
    out = StructType([*(df.schema[c] for c in kept), StructField(decoded, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            work = work or _decoder(shared)
            lists = batch.column(ids)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            lo = 0
            while lo < batch.num_rows:
                limit = (ends[lo - 1] if lo else 0) + DECODED_IDS
                hi = max(lo + 1, int(np.searchsorted(ends, limit, side="right")))
                part = batch.slice(lo, hi - lo)
                made = work(part.column(ids))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), made], names=[*kept, decoded])
                lo = hi

    return df.select(*[F.col(f"`{c}`") for c in inputs]).mapInArrow(run, out)
