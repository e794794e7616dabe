"""Near-duplicate join by Jaccard similarity of word shingles, exact.

The universe of shingles is cut into segments by hash. Two sets that link differ in at most H
shingles, so of more than H segments at least one is equal in both: sets that link share the
signature of a segment. H and the number of segments hang on a band of set sizes, a third wide,
so that a set has signatures for its own band and for the one below, where it is the larger
partner. A segment may instead allow for one difference: its signature and those of its subsets
with one shingle taken away are indexed, and it counts as two segments. How many segments do so
is chosen by cost for each band. Segments in which a set has nothing, or nothing but the shingle taken
away, are left out while they are fewer than the segments that a pair has equal, so that another
one of those is equal; sets with more have them indexed too. No signature is dropped for being frequent.

Signatures are packed by range of their value; a group of ranges is sorted in one task, whose
size the number of ranges bounds. Signatures of one set only end there. What is shared gives
candidates in two rounds:

1. Each set is paired with the one it shares most signatures with, of the sets it meets in
   groups of a few and of the leaders of its large groups; the leader is the set that shares
   most there. Pairs are checked exactly and give components: a text and its thousands of copies
   are connected by then, at a pair for each copy.
2. All other pairs from distinct components are checked exactly where they may link: those of
   small groups, each once for all its signatures, and those of large groups, where all
   sets of one leader are looked at together, in blocks. Sets that a sketch rules out with all
   others there end first; the rest meet again with their shingles, once for all their leaders
   (in clusters that the sketch connects) where that is less. A block gives no pairs
   but links, each of which connects what was not connected in it before: fewer than its sets.

A parity sketch (the odd sketch: bit i tells whether an odd number of shingles falls
into it, so differing bits never outnumber differing shingles) rules out the pairs whose
difference is too large.

Sets are told apart by their size and the 64-bit sum of their shingles' hashes: copies are one
set from the start. Shingles are compared by 64-bit hashes.

Defined results: null and empty texts have no shingles and link with nothing; repeated rows of
one id are one document (of the least id's component); ids of copies count, so a component's
name is the least id of all its documents; an empty table gives an empty table; other columns
of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain
from math import erfc, exp, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludomart.llm.common import components, free, in_filter, key_filter, split_by_keys, steps, stored
from ludomart.llm.words import SPACE, mix, shingles, words

SHINGLE = 5
# Similarity as a fraction; the bands below are laid out for it.
NUM, DEN = 3, 4
# Bytes of text of which a task holds the sets and signatures at a time; only these are filtered,
# as a batch holds thousands of texts.
SET_BYTES = 1 << 20
# Signatures that one task sorts.
RANGE_ROWS = 1_500_000
# Signatures that a task packs at a time.
PACK_ROWS = 1_000_000
# Sets of a range that are numbered in the bits beside a signature.
PACKED_SETS = 1 << 32
# Sets of a block in which pairs are checked.
PAIR_BLOCK = 256
# Members of a group that are compared in one block, and their shingles where these are needed.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
# Groups of up to so many sets give their pairs at once, each pair once for all its groups.
SMALL = 8
# Cost of a signature indexed, and of a pair looked at, for the choice of an allocation; share
# of shingles that unrelated texts have in common.
ROW_COST, PAIR_COST, COMMON = 1.0, 300.0, 0.1

SETS = "doc_id bigint, n_shingles bigint, fp bigint, sketch binary"


@cache
def bands(limit: int = 1 << 40) -> np.ndarray:
    """The least size of each band; partners of a set are in its band or the next one."""
    low = [1]
    while low[-1] < limit:
        low.append(low[-1] * DEN // NUM + 1)
    return np.array(low)


@cache
def allocation(band: int) -> tuple[int, int, int]:
    """(segments, segments that allow for one difference, segments that are equal in both sets of
    any pair that links) of a band: the cheapest layout that covers every difference two sets of
    the band can have."""
    low, high = int(bands()[band]), int(bands()[band + 1]) - 1
    most = high * (DEN - NUM) // NUM  # shingles that differ, for a smaller set of this band
    best = None
    for part in (0.0, 0.25, 0.5, 0.75, 1.0):
        n = max(1, int((most + 1) / (1 + part)))
        while n <= 3 * low or best is None:
            one = round(n * part)
            equal = _equal(n, one, most)
            if equal > 0:
                cost = _cost(low, n, one, equal)
                if best is None or cost < best[0]:
                    best = cost, n, one, equal
            n += max(1, n // 32)
    return best[1:]


def _cost(low: int, n: int, one: int, equal: int) -> float:
    """Signatures of a set of ``low`` shingles, and what it shares with unrelated sets."""
    mean = low / n
    none, nearly = exp(-mean), exp(-mean) * (1 + mean)
    rows = n * (1 - none) + one * mean * (1 - none)
    # Unrelated texts share a segment if all that it holds of either is common to both.
    own = mean * (1 - COMMON)
    chance = exp(-2 * own) * (1 - exp(-mean * COMMON)) * (n - one + one * (1 + own) ** 2)
    # Bare segments are indexed by sets that have as many of them as pairs have equal ones.
    bare = (n - one) * none + one * nearly
    spread = (n - one) * none * (1 - nearly) + one * nearly * (1 - nearly)
    many = erfc((equal - bare) / sqrt(2 * spread + 1e-9)) / 2
    chance += many**2 * ((n - one) * none**2 + one * nearly**2)
    return rows * ROW_COST + chance * PAIR_COST


def _equal(n: int, one: int, most: int) -> int:
    """Of ``n`` segments, ``one`` of which take two differences to spoil, those that ``most``
    differences leave."""
    plain = min(most, n - one)
    return n - plain - min(one, (most - plain) // 2)


class Sets:
    """Distinct shingles of the rows of a batch: ``s``, sorted within ``row``; rows without
    any do not appear. ``rows`` are those that do, ``begin`` and ``size`` their stretches."""

    def __init__(self, texts: pa.Array) -> None:
        h, first = words(texts, SPACE)
        row, s = shingles(h, first, SHINGLE)
        cut = np.searchsorted(row, np.arange(len(texts) + 1))
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if hi - lo > 1:
                s[lo:hi].sort()
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
        self.s, row = s[new], row[new]
        self.begin = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.empty(0, np.int64)
        self.rows = row[self.begin]
        self.size = np.diff(np.append(self.begin, len(row)))
        # Place of a row among those that have a set, for each shingle.
        self.own = np.repeat(np.arange(len(self.rows)), self.size)
        self.mixed = mix(self.s.copy())

    def fingerprints(self) -> np.ndarray:
        if not len(self.rows):
            return np.empty(0, np.int64)
        total = np.add.reduceat(self.mixed, self.begin)
        return mix(total + self.size.astype(np.uint64)).view(np.int64)

    def sketches(self) -> list[bytes]:
        bits = np.array([_bits(n) for n in self.size], np.int64)
        start = np.concatenate([[0], np.cumsum(bits)])
        place = mix(self.s ^ np.uint64(0x5BD1E995)) & (bits[self.own] - 1).astype(np.uint64)
        odd = np.bincount(place.astype(np.int64) + start[:-1][self.own], minlength=start[-1]) & 1
        packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
        at = (start // 8).tolist()
        return [packed[lo:hi] for lo, hi in zip(at[:-1], at[1:], strict=True)]

    def elements(self) -> list[bytes]:
        raw = self.s.tobytes()
        return [raw[8 * lo : 8 * (lo + n)] for lo, n in zip(self.begin.tolist(), self.size.tolist(), strict=True)]

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        """(signature, place of its row) for the band of each set and the one below."""
        sigs, owners = [], []
        own_band = np.searchsorted(bands(), self.size, side="right") - 1
        for down in (0, 1):
            band = own_band - down
            segments, single, equal = (_by_band(band, i) for i in range(3))
            salt = mix(band.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7))
            ok = (band >= 0)[self.own]
            own, m, s = self.own[ok], self.mixed[ok], self.s[ok]
            if not len(s):
                continue
            # Sorted hashes fall into segments in order.
            seg = ((s >> np.uint64(32)) * segments[own].astype(np.uint64)) >> np.uint64(32)
            head = np.append(True, (seg[1:] != seg[:-1]) | (own[1:] != own[:-1]))
            begin = np.flatnonzero(head)
            total = np.add.reduceat(m, begin)
            name = mix(seg + salt[own])
            sigs.append(mix(total + name[begin]))
            owners.append(own[begin])
            # Segments in which a set is empty, or would be with one shingle taken away: while they
            # are fewer than the segments that a pair has equal, another of those is equal.
            low = seg < single[own].astype(np.uint64)
            at = np.cumsum(head) - 1
            bare = low & (np.diff(np.append(begin, len(seg)))[at] == 1)
            filled = np.bincount(own[begin], minlength=len(self.rows))
            short = (band >= 0) & (segments - filled + np.bincount(own[bare], minlength=len(self.rows)) >= equal)
            # Subsets with one shingle taken away, of the first segments.
            low &= ~bare | short[own]
            if low.any():
                sigs.append(mix(total[at[low]] - m[low] + name[low]))
                owners.append(own[low])
            for i in np.flatnonzero(short).tolist():
                lo, hi = np.searchsorted(own[begin], (i, i + 1))
                empty = np.setdiff1d(np.arange(segments[i], dtype=np.uint64), seg[begin[lo:hi]])
                sigs.append(mix(mix(empty + salt[i])))
                owners.append(np.full(len(empty), i))
        return np.concatenate(sigs), np.concatenate(owners)


def _by_band(band: np.ndarray, which: int) -> np.ndarray:
    """For each band, a number of its allocation."""
    out = np.zeros(len(band), np.int64)
    for b in np.unique(band[band >= 0]).tolist():
        out[band == b] = allocation(b)[which]
    return out


def _bits(n: int) -> int:
    return max(64, 1 << (int(n) - 1).bit_length())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: key, size of its set, the set's fingerprint (null if empty) and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "_text", SET_BYTES):
                n = part.num_rows
                size, fp, sketch = [0] * n, [None] * n, [None] * n
                sets = Sets(part.column("_text"))
                got = zip(sets.rows.tolist(), sets.size.tolist(), sets.fingerprints().tolist(), sets.sketches(), strict=True)
                for i, k, f, b in got:
                    size[i], fp[i], sketch[i] = k, f, b
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(fp, pa.int64()), pa.array(sketch, pa.binary())],
                    names=["doc_id", "n_shingles", "fp", "sketch"],
                )

    own = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    return own.mapInArrow(run, SETS)


def _packed(docs: DataFrame, ranges: int, key: str, text: str, wanted=None) -> DataFrame:
    """Signatures of whole texts (of keys in the filter ``wanted``) as arrays by range: the sets,
    how many each has there, and the low half of each, which the range does not use: of the millions
    that a task sorts a few hundred pairs agree by chance, and are told apart when they are checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            held: list[tuple] = []
            size = 0
            for part in steps(batch, "_text", SET_BYTES):
                if wanted is not None:
                    part = part.filter(in_filter(part.column("_k"), wanted.value))
                sets = Sets(part.column("_text"))
                if not len(sets.rows):
                    continue
                fps = sets.fingerprints()
                fresh = np.ones(len(fps), bool)
                for i, f in enumerate(fps.tolist()):
                    fresh[i] = f not in seen
                    seen.add(f)
                sig, owner = sets.signatures()
                ok = fresh[owner]
                held.append((sig[ok], fps[owner[ok]]))
                size += int(ok.sum())
                if size > PACK_ROWS:
                    yield _by_range(held, ranges)
                    held, size = [], 0
            if size:
                yield _by_range(held, ranges)

    own = docs.select(F.xxhash64(F.col(f"`{key}`").cast("long")).alias("_k"), F.col(f"`{text}`").alias("_text"))
    return own.mapInArrow(run, "bucket int, fps binary, counts binary, sigs binary")


def _by_range(held: list[tuple], ranges: int) -> pa.RecordBatch:
    sig = np.concatenate([x for x, _ in held])
    fp = np.concatenate([y for _, y in held])
    bucket = (((sig >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int32)
    order = np.lexsort((fp, bucket))
    sig, fp, bucket = sig[order], fp[order], bucket[order]
    low = sig.astype(np.uint32)
    cut = np.searchsorted(bucket, np.arange(ranges + 1))
    rows = ([], [], [], [])
    for b in np.flatnonzero(np.diff(cut)).tolist():
        part = fp[cut[b] : cut[b + 1]]
        at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        rows[0].append(b)
        rows[1].append(part[at].tobytes())
        count = np.diff(np.append(at, len(part)))
        rows[2].append(count.astype(np.uint8 if count.max() < 256 else np.uint32).tobytes())
        rows[3].append(low[cut[b] : cut[b + 1]].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int32()), *(pa.array(r, pa.binary()) for r in rows[1:])],
        names=["bucket", "fps", "counts", "sigs"],
    )


SHARED = "pair boolean, a bigint, b bigint, n bigint"


def _rows(pair: bool, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(a), 100_000):
        cut = slice(lo, lo + 100_000)
        columns = [pa.array(np.full(len(a[cut]), pair)), *(pa.array(x[cut], pa.int64()) for x in (a, b, n))]
        yield pa.RecordBatch.from_arrays(columns, names=["pair", "a", "b", "n"])


def _unpacked(f: pa.Scalar, c: pa.Scalar, x: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sig = np.frombuffer(x.as_buffer(), np.uint32).astype(np.uint64)
    fps = np.frombuffer(f.as_buffer(), np.int64)
    raw = c.as_buffer()
    return sig, fps, np.frombuffer(raw, np.uint8 if raw.size == len(fps) else np.uint32)


def shared_signatures(
    docs: DataFrame, ranges: int, key: str = "doc_id", text: str = "text", wanted=None, packed_sets: int = PACKED_SETS
) -> DataFrame:
    """What signatures of several sets share. Of small groups the pairs: (pair, a, b, n) with the
    number of signatures; of large ones the members: (not pair, a, b, n) with the set, the set of
    its group that shares most (in copies of a text with changes of their own, that is the text),
    and the group's name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, ids, counts, bucket = [], [], [], 0
        for batch in batches:
            bucket = batch.column("bucket")[0].as_py() if batch.num_rows else bucket
            for row in zip(*(batch.column(k) for k in ("fps", "counts", "sigs")), strict=True):
                sig, fp, count = _unpacked(*row)
                sigs.append(sig)
                ids.append(fp)
                counts.append(count)
        fps, place = np.unique(np.concatenate(ids), return_inverse=True)
        # Signature and number of the set in one number, so that one sort brings copies of a
        # signature together, half of it each. More sets than that are sorted apart.
        sig, owner = np.concatenate(sigs), np.repeat(place, np.concatenate(counts))
        del sigs, ids, counts, place
        if len(fps) <= packed_sets:
            sig <<= np.uint64(32)
            sig |= owner.astype(np.uint64)
            sig.sort()
            owner = (sig & np.uint64((1 << 32) - 1)).astype(np.int64)
            sig >>= np.uint64(32)
        else:
            order = np.lexsort((owner, sig))
            sig, owner = sig[order], owner[order]
        new = np.append(True, (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1]))
        sig, owner = sig[new], owner[new]
        head = np.append(True, sig[1:] != sig[:-1])
        several = ~(head & np.append(head[1:], True))
        sig, owner = sig[several], owner[several]
        degree = np.bincount(owner, minlength=len(fps))
        begin = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.empty(0, np.int64)
        size = np.diff(np.append(begin, len(sig)))
        # Pairs of small groups, counted; two numbers of sets in one.
        found = []
        for n in range(2, SMALL + 1):
            at = begin[size == n]
            if len(at):
                members = owner[at[:, None] + np.arange(n)]
                found += [(members[:, i] << 32) | members[:, j] for i in range(n) for j in range(i + 1, n)]
        pair, common = np.unique(np.concatenate(found), return_counts=True) if found else (owner[:0], owner[:0])
        yield from _rows(True, fps[pair >> 32], fps[pair & ((1 << 32) - 1)], common)
        # Of large groups the members, with the least of the sets of the highest degree: one
        # number holds degree and set. The name is told apart by range.
        rank = degree[owner] * (len(fps) + 1) + (len(fps) - owner)
        top = np.maximum.reduceat(rank, begin) if len(begin) else rank
        lead = np.repeat(len(fps) - top % (len(fps) + 1), size)
        large = np.repeat(size > SMALL, size)
        name = (sig.astype(np.int64) << 31) ^ bucket
        yield from _rows(False, fps[owner[large]], fps[lead[large]], name[large])

    packed = _packed(docs, ranges, key, text, wanted).repartition(ranges, "bucket")
    return packed.groupBy("bucket").applyInArrow(run, SHARED)


def _sets_of(docs: DataFrame, reps: DataFrame, key: str, text: str) -> DataFrame:
    """(fp, elements) of the sets whose documents are in ``reps`` (doc_id, fp), once each although
    a row may be repeated, and of a few others that the filter lets by; in partitions by ``fp``."""

    wanted = key_filter(reps, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "_text", SET_BYTES):
                sets = Sets(part.filter(in_filter(part.column("_k"), wanted.value)).column("_text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sets.fingerprints(), pa.int64()),
                        pa.array(sets.elements(), pa.binary()),
                    ],
                    names=["fp", "elements"],
                )

    own = docs.select(F.xxhash64(F.col(f"`{key}`").cast("long")).alias("_k"), F.col(f"`{text}`").alias("_text"))
    return own.mapInArrow(run, "fp bigint, elements binary").groupBy("fp").agg(F.first("elements").alias("elements"))


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets of shingles link."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return DEN * both >= NUM * (len(x) + len(y) - both)


def verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame, key: str, text: str) -> DataFrame:
    """Of ``pairs`` (a, b), a stored table, those whose sets link.

    Pairs are put into cells, and a set goes to each of its cells once, however many pairs it
    has there: a cell is a pair of blocks of a group of pairs, or holds several small groups. A
    group is named by the least set next to either set of a pair, so pairs around a set, or of
    sets that are all alike, are together.
    """
    count = pairs.count()
    near = pairs.union(pairs.select("b", "a")).groupBy("a").agg(F.min("b").alias("m"))
    near = near.select(F.col("a").alias("fp"), F.least("a", "m").alias("m"))
    grouped = pairs.join(near.toDF("a", "ma"), "a").join(near.toDF("b", "mb"), "b")
    grouped = stored(grouped.select(F.least("ma", "mb").alias("g"), "a", "b"), "groups")
    member = grouped.select("g", F.col("a").alias("fp")).union(grouped.select("g", "b")).distinct()
    reps = stored(reps.join(member.select("fp").distinct(), "fp", "left_semi"), "wanted")
    blocks = member.groupBy("g").agg(F.ceil(F.count("*") / PAIR_BLOCK).cast("long").alias("blocks"))
    cells = grouped.join(blocks, "g")
    s, t = (F.pmod(F.xxhash64(x), F.col("blocks")) for x in ("a", "b"))
    few = F.pmod(F.xxhash64("g"), F.lit(max(1, count // PAIR_BLOCK)))
    cells = cells.select(
        F.when(F.col("blocks") > 1, F.col("g")).otherwise(few).alias("c"),
        F.when(F.col("blocks") > 1, F.least(s, t)).otherwise(-1).alias("i"),
        F.when(F.col("blocks") > 1, F.greatest(s, t)).otherwise(-1).alias("j"),
        "a",
        "b",
    )
    cells = stored(cells, "cells")
    there = cells.select("c", "i", "j", F.col("a").alias("fp")).union(cells.select("c", "i", "j", "b")).distinct()
    there = there.join(_sets_of(docs, reps, key, text), "fp")
    # Names of its own: both sides come from one table.
    there = there.toDF("fp", "d", "k", "l", "elements")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        raw = right.column("elements")
        held = {f: np.frombuffer(e.as_buffer(), np.uint64) for f, e in zip(right.column("fp").to_pylist(), raw, strict=True)}
        named = zip(left.column("a").to_pylist(), left.column("b").to_pylist(), strict=True)
        ok = [_alike(held[a], held[b]) for a, b in named]
        return left.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return cells.groupBy("c", "i", "j").cogroup(there.groupBy("d", "k", "l")).applyInArrow(run, "a bigint, b bigint")


def _distance(x: np.ndarray, y: np.ndarray, size_x: np.ndarray, size_y: np.ndarray) -> np.ndarray:
    """Differing sketch bits as a share of both sizes, for rows of x and of y; infinite where
    sketches or sizes rule a link out."""
    differ = np.zeros((len(x), len(y)), np.int64)
    for j in range(x.shape[1]):
        differ += np.bitwise_count(x[:, j, None] ^ y[None, :, j])
    total = size_x[:, None] + size_y[None, :]
    small = np.minimum(size_x[:, None], size_y[None, :])
    large = np.maximum(size_x[:, None], size_y[None, :])
    # Differing shingles are at most (DEN - NUM) / (DEN + NUM) of both sizes together.
    far = (differ * (DEN + NUM) > total * (DEN - NUM)) | (small * DEN < large * NUM)
    return np.where(far, np.inf, differ / total)


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches folded to the size of the shortest."""
    width = min(len(s) for s in sketches)
    out = np.empty((len(sketches), width // 8), np.uint64)
    for i, s in enumerate(sketches):
        v = np.frombuffer(s, np.uint64)
        while len(v) * 8 > width:
            v = v[: len(v) // 2] ^ v[len(v) // 2 :]
        out[i] = v
    return out


def _may_link(rows: DataFrame) -> DataFrame:
    """(sig, fp, near) of the sets of a cell that may link with a set of another component there;
    sets have the same ``near``, one of them, if such pairs connect them in the cell."""

    def found(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        fp, comp, size, side = (t.column(c).to_numpy() for c in ("fp", "comp", "n", "side"))
        if len(fp) < 2 or (comp == comp[0]).all():
            return fp[:0], fp[:0]
        bits = _folded(t.column("sketch").to_pylist())
        two = side.min() != side.max()
        name = np.arange(len(fp))
        some = np.zeros(len(fp), bool)
        for lo in range(0, len(fp), 256):
            cut = slice(lo, lo + 256)
            d = _distance(bits[cut], bits, size[cut], size)
            d[comp[cut, None] == comp[None, :]] = np.inf
            if two:  # of a cell of two blocks only pairs across are its own
                d[side[cut, None] == side[None, :]] = np.inf
            near = np.isfinite(d)
            for i in np.flatnonzero(near.any(1)).tolist():
                some[lo + i] = True
                joined = name[near[i]]
                if (joined != name[lo + i]).any():
                    name[np.isin(name, joined)] = name[lo + i]
        return fp[some], fp[name[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            if batch is not None:
                t = pa.Table.from_batches([batch])
                held = t if held is None else pa.concat_tables([held, t])
            if held is None or not held.num_rows:
                continue
            key = np.stack([held.column(c).to_numpy() for c in ("sig", "i", "j")], 1)
            change = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            # The last cell may go on in the next batch.
            ends = change.tolist() if batch is not None else [*change.tolist(), len(key)]
            for lo, hi in zip([0, *ends[:-1]], ends, strict=False):
                fp, near = found(held.slice(lo, hi - lo))
                columns = [pa.array(x, pa.int64()) for x in (np.full(len(fp), key[lo, 0]), fp, near)]
                yield pa.RecordBatch.from_arrays(columns, names=["sig", "fp", "near"])
            if ends:
                held = held.slice(ends[-1]).combine_chunks()

    cells = rows.select("sig", "i", "j", "fp", "comp", "n", "sketch", "side")
    return cells.mapInArrow(run, "sig bigint, fp bigint, near bigint").distinct()


def _linked(rows: DataFrame) -> DataFrame:
    """Links (a, b) between sets of a cell that, with ``comp``, connect what links there: fewer
    than the cell has sets."""

    def run(t: pa.Table) -> pa.Table:
        fp, comp, side = (t.column(c).to_numpy() for c in ("fp", "comp", "side"))
        held = [np.frombuffer(e.as_buffer(), np.uint64) for e in t.column("elements")]
        size = np.array([len(x) for x in held])
        two = side.min() != side.max()
        # Sketches of one width, with fewer shingles to a bit than those that came here by.
        width = 8 * _bits(int(size.max()))
        bits = np.empty((len(held), width // 64), np.uint64)
        for i, x in enumerate(held):
            place = (mix(x ^ np.uint64(0x5BD1E995)) & np.uint64(width - 1)).astype(np.int64)
            odd = (np.bincount(place, minlength=width) & 1).astype(np.uint8)
            bits[i] = np.packbits(odd, bitorder="little").view(np.uint64)
        name = np.unique(comp, return_inverse=True)[1]
        a, b = [], []
        for i in range(len(held)):
            j = np.flatnonzero(name[i + 1 :] != name[i]) + i + 1
            if two:
                j = j[side[j] != side[i]]
            j = j[np.minimum(size[j], size[i]) * DEN >= np.maximum(size[j], size[i]) * NUM]
            differ = np.bitwise_count(bits[j] ^ bits[i]).sum(1, dtype=np.int64)
            ok = differ * (DEN + NUM) <= (size[j] + size[i]) * (DEN - NUM)
            for k in j[ok][np.argsort(differ[ok], kind="stable")].tolist():
                if name[k] != name[i] and _alike(held[i], held[k]):
                    a.append(fp[i])
                    b.append(fp[k])
                    name[name == name[k]] = name[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    cells = rows.select("g", "sig", "i", "j", "fp", "comp", "side", "elements")
    return cells.groupBy("g", "sig", "i", "j").applyInArrow(run, "a bigint, b bigint")


def _blocks(rows: DataFrame, *by: str) -> DataFrame:
    """Into how many blocks the sets of each group go, and how many rows their cells have."""
    parts = F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)
    blocks = rows.groupBy(*by).agg(F.ceil(parts).cast("int").alias("blocks"), F.count("*").alias("size"))
    return blocks.select(*by, "blocks", (F.col("size") * F.col("blocks")).alias("rows"))


def clusters(left: DataFrame) -> DataFrame:
    """``left`` (sig, g, fp, ...) with one row for each set of a cluster ``g``, under sig 0, where
    that gives cells of fewer rows than those of the leaders: sets that are all alike lead each other,
    and their pairs meet under each of them."""
    whole = _blocks(left.drop("sig").distinct(), "g").select("g", "rows")
    led = _blocks(left, "g", "sig").groupBy("g").agg(F.sum("rows").alias("led"))
    one = whole.join(led, "g").where("rows <= led").select("g", F.lit(0).cast("long").alias("one"))
    left = left.join(one, "g", "left").withColumn("sig", F.coalesce("one", "sig"))
    return left.drop("one").distinct()


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows once for each of their cells: a cell is a pair of the ``blocks`` of a group."""
    rows = rows.withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")})


def links_in_cells(cells: DataFrame, comp: DataFrame, content: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Links (a, b) that connect the components of sets (sig, fp) that meet under a ``sig``. It
    stands for all sets that a leader leads: each group lies with its leader, so pairs meet once
    for all their signatures of one leader."""
    named = cells.join(comp.toDF("fp", "comp"), "fp", "left")
    named = stored(named.withColumn("comp", F.coalesce("comp", "fp")), "named")
    mixed = named.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).where("lo < hi")
    mixed = mixed.select("sig", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = _in_blocks(named.join(mixed, "sig").join(content.select("fp", "n", "sketch"), "fp"))
    rows = rows.select("sig", "i", "j", "fp", "comp", "n", "sketch", "side")
    near = stored(_may_link(rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")), "near")
    # Pairs that may link connect sets to clusters, each pair within one.
    of = components(near, "clusters", "fp", "near").toDF("fp", "g")
    left = near.select("sig", "fp").distinct().join(named, ["sig", "fp"]).join(content.select("fp", "n"), "fp").join(of, "fp")
    left = stored(clusters(stored(left, "left")), "left")
    rows = _in_blocks(left.join(_blocks(left, "g", "sig"), ["g", "sig"])).select("g", "sig", "i", "j", "fp", "comp", "side")
    reps = content.select("doc_id", "fp").join(left.select("fp").distinct(), "fp", "left_semi")
    return _linked(rows.join(_sets_of(docs, stored(reps, "wanted"), key, text), "fp"))


def _near(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, n) that sketches and sizes do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y, p, q in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "p", "q")), strict=True):
                bits = _folded([x, y])
                ok.append(bool(np.isfinite(_distance(bits[:1], bits[1:], np.array([p]), np.array([q]))[0, 0])))
            yield batch.select(["a", "b", "n"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "n", "p", "q", "x", "y").mapInArrow(run, "a bigint, b bigint, n bigint")


def _expected(content: DataFrame) -> float:
    """About the number of signatures of all sets, from how many there are of each band's width."""
    width = F.floor(F.log("n") / F.lit(log(DEN / NUM)))
    total = 0.0
    for r in content.groupBy(width.alias("w")).agg(F.count("*").alias("sets"), F.avg("n").alias("n")).collect():
        band = int(np.searchsorted(bands(), r.n, side="right")) - 1
        for n, one, _ in map(allocation, range(max(0, band - 1), band + 1)):
            total += r.sets * (n + one * r.n / n)
    return total


def _in_order(pairs: DataFrame, *more: str) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *more)


def link(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``."""
    own = stored(fingerprints(docs, key, text), "fingerprints")
    content = stored(
        own.where("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")),
        "content",
    )
    reps = content.select("doc_id", "fp")
    ranges = int(_expected(content) // RANGE_ROWS) + 1
    # A text is indexed once, by its representative; what the filter lets by is one set again below.
    found = stored(shared_signatures(docs, ranges, key, text, key_filter(reps, "doc_id")), "shared")
    members = found.where("NOT pair").select(F.col("n").alias("sig"), F.col("a").alias("fp"), F.col("b").alias("lead"))
    sizes = content.select("fp", "n", "sketch")
    both = _in_order(found.where("pair"), "n").groupBy("a", "b").agg(F.sum("n").alias("n"))
    both = both.join(sizes.toDF("a", "p", "x"), "a").join(sizes.toDF("b", "q", "y"), "b")
    both = stored(_near(both), "pairs")

    cells = stored(members.select(F.col("lead").alias("sig"), "fp").distinct(), "cells")

    # Round 1: the set that a set shares most with, of its pairs and the leaders of its groups.
    stars = members.where("fp <> lead").groupBy(F.col("fp").alias("a"), F.col("lead").alias("b")).agg(F.count("*").alias("n"))
    every = both.union(both.select("b", "a", "n")).union(stars)
    best = every.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b"), F.max("n").alias("n"))
    best = _in_order(best, "n").distinct().join(sizes.toDF("a", "p", "x"), "a").join(sizes.toDF("b", "q", "y"), "b")
    first = stored(_near(best).select("a", "b").distinct(), "pairs")
    links = stored(verify(first, docs, reps, key, text), "links")
    comp = stored(components(links, "components"), "components")

    # Round 2: every other pair that components do not connect, of small groups and of large ones.
    named = comp.select(F.col("node").alias("a"), F.col("component").alias("c"))
    apart = both.join(named, "a", "left").join(named.toDF("b", "d"), "b", "left")
    apart = apart.where("NOT coalesce(c, a) <=> coalesce(d, b)").select("a", "b")
    rest = stored(apart.join(first, ["a", "b"], "left_anti"), "pairs")
    # What is connected already goes on as a link from each set to its component.
    links = comp.toDF("a", "b").union(verify(rest, docs, reps, key, text)).union(links_in_cells(cells, comp, content, docs, key, text))
    comp = components(links, "components").toDF("fp", "comp")

    least = content.join(comp, "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    names = least.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_set = least.select("fp", "comp").join(names, "comp").select("fp", "component_id")
    out = own.select("doc_id", "n_shingles", "fp").join(by_set, "fp", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the document of the least id of each component, and those that link with
    nothing; repeated rows of an id stay as they are."""
    gone = stored(link(docs, key, text).where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    (number,) = free(docs, "_id")
    gone = gone.toDF(number)
    own = docs.withColumn(number, F.col(f"`{key}`").cast("long"))
    sure, rest = split_by_keys(own, number, gone)
    rest = rest.join(gone, number, "left_anti").select(own.columns)
    return sure.unionByName(rest).drop(number)
