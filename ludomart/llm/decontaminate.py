"""Benchmark decontamination by suffix arrays of the training texts.

Texts are cut into shards inside their tasks; a shard's words form one sequence, its suffix
array is built by prefix doubling, and every suffix of every benchmark item is looked up in it
by binary search, word by word, all suffixes at once. That gives the longest verbatim match of
each suffix and where it lies. Suffixes that match for a whole window (``window`` words, or a
shorter item as a whole) mark the words they cover.

Only the benchmark is sent to the tasks, in blocks of at most ``block_words`` words: a larger
benchmark takes one pass over the texts for each block, which adds to what earlier passes
found. Nothing is gathered from the texts, and no group is formed, so copies and frequent
passages cost what their length costs: words that many items and many places share are gone
through once for each place, not for each pair.

Defined results: null and empty texts have no words and are clean; an item without words has
no window; repeated items and repeated rows count each for itself (n_items counts distinct
ids); an empty benchmark leaves every text clean; other columns pass through, and a column
named as a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from ludomart.llm.common import free, keep_where, with_columns
from ludomart.llm.words import ALNUM, words

WINDOW = 10
BLOCK_WORDS = 1 << 20
SHARD_BYTES = 3 << 20
# Documents and items that are paired at a time.
PAIRS = 1 << 20

FIELDS = [
    StructField("n_words", LongType()),
    StructField("longest_match", IntegerType()),
    StructField("hit_starts", ArrayType(LongType())),
    StructField("hit_ends", ArrayType(LongType())),
    StructField("hit_items", ArrayType(StringType())),
]


def suffix_array(seq: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the suffixes of ``seq`` in order of their first words, and where a suffix
    differs from the one before it in these; ``depth`` words, rounded up to a power of two."""
    n = len(seq)
    order = np.argsort(seq)
    value = seq[order]
    head = np.ones(n, bool)
    head[1:] = value[1:] != value[:-1]
    rank = np.empty(n, np.int64)
    # A rank is the place of the first suffix of its group, so groups can be sorted apart.
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    done = 1
    while done < depth:
        # Only groups of several suffixes are sorted on; the rest have their place.
        tail = np.append(head[1:], True)
        at = np.flatnonzero(~(head & tail))
        if not len(at):
            break
        mine = order[at]
        ahead = mine + done
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        sub = np.lexsort((second, rank[mine]))
        mine, second = mine[sub], second[sub]
        order[at] = mine
        same = np.zeros(len(at), bool)
        same[1:] = (second[1:] == second[:-1]) & (rank[mine[1:]] == rank[mine[:-1]])
        head[at] = ~same
        rank[mine] = np.maximum.accumulate(np.where(~same, at, 0))
        done *= 2
    return order, head


class Items:
    """Words of a block of benchmark items, one suffix for each word."""

    def __init__(self, ids: list, texts: list[str], window: int) -> None:
        h, first = words(pa.array(texts, pa.string()), ALNUM)
        length = np.diff(first)
        item = np.repeat(np.arange(len(texts)), length)
        self.words = h
        # Items of one id count as one.
        self.ids, same = np.unique(["" if i is None else str(i) for i in ids], return_inverse=True)
        self.item = same[item] if len(item) else item
        self.left = first[1:][item] - np.arange(len(h))
        # A suffix is a window if it holds as many words as a window of its item.
        self.need = np.minimum(window, length[item])
        self.is_window = self.left >= self.need
        self.depth = int(length.max()) if len(h) else 0


def matches(seq: np.ndarray, order: np.ndarray, items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(depth, suffix, lo, hi) for each depth: the ranges of the suffix array whose suffixes
    begin with the first ``depth`` words of these benchmark suffixes."""
    n = len(seq)
    alive = np.arange(len(items.words))
    lo, hi = np.zeros(len(alive), np.int64), np.full(len(alive), n, np.int64)
    for d in range(items.depth):
        ok = items.left[alive] > d
        alive, lo, hi = alive[ok], lo[ok], hi[ok]
        want = items.words[alive + d]

        def bound(right: bool) -> np.ndarray:
            a, b = lo.copy(), hi.copy()
            while True:
                open_ = np.flatnonzero(a < b)
                if not len(open_):
                    return a
                mid = (a[open_] + b[open_]) >> 1
                at = order[mid] + d
                have = np.where(at < n, seq[np.minimum(at, n - 1)], np.uint64(0))
                up = (have <= want[open_]) if right else (have < want[open_])
                a[open_] = np.where(up, mid + 1, a[open_])
                b[open_] = np.where(up, b[open_], mid)

        lo, hi = bound(False), bound(True)
        ok = lo < hi
        alive, lo, hi = alive[ok], lo[ok], hi[ok]
        if not len(alive):
            return
        yield d + 1, alive, lo, hi


def _lists(row: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """A list for each of ``n`` rows; ``row`` is sorted."""
    return pa.ListArray.from_arrays(np.searchsorted(row, np.arange(n + 1)).astype(np.int32), values)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    total = hi - lo
    return np.repeat(lo - (np.cumsum(total) - total), total) + np.arange(int(total.sum()))


def _crossed(left: np.ndarray, right: np.ndarray, keys: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of equal keys, 0 to ``keys`` - 1 and sorted on both sides, about ``PAIRS`` at a time."""
    b = np.searchsorted(right, np.arange(keys + 1))
    wide = np.diff(b)[left]
    upto = np.cumsum(wide)
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, side="right")))
        mine = np.arange(lo, hi)
        yield np.repeat(mine, wide[lo:hi]), _ranges(b[left[mine]], b[left[mine] + 1])
        lo = hi


def _search(items: Items, pairs: bool = True) -> Callable[[pa.RecordBatch], dict[str, pa.Array]]:
    """The function that adds ``FIELDS``; without ``pairs`` hit_items stay empty."""

    def work(part: pa.RecordBatch, text: str, before: dict[str, pa.Array] | None) -> dict[str, pa.Array]:
        h, first = words(part.column(text), ALNUM)
        n = part.num_rows
        count = np.diff(first)
        # A word 0, which no text has, stands behind every text.
        size = len(h) + n
        seq = np.zeros(size, np.uint64)
        doc = np.repeat(np.arange(n), count + 1)
        start = first[:-1] + np.arange(n)
        body = np.ones(size, bool)
        body[start + count] = False
        seq[body] = h
        longest = np.zeros(n, np.int64)
        cover = np.zeros(size + 1, np.int64)
        pair = np.empty(0, np.int64)
        if size and len(items.words):
            order, _ = suffix_array(seq, items.depth)
            for d, suffix, lo, hi in matches(seq, order, items):
                # Suffixes that begin alike have one range, and other ranges are apart from it: each
                # is gone through once, however many items hold its words.
                at, first_of = np.unique(lo, return_index=True)
                longest[doc[order[_ranges(at, hi[first_of])]]] = d
                whole = items.is_window[suffix] & (items.need[suffix] == d)
                if not whole.any():
                    continue
                at, first_of, own = np.unique(lo[whole], return_index=True, return_inverse=True)
                end = hi[whole][first_of]
                where = order[_ranges(at, end)]
                cover[where] += 1  # a place lies in one range
                np.add.at(cover, where + d, -1)
                if not pairs:
                    continue
                m = len(items.ids)
                docs = np.unique(np.repeat(np.arange(len(at)), end - at) * n + doc[where])
                who = np.unique(own * m + items.item[suffix[whole]])
                for a, b in _crossed(docs // n, who // m, len(at)):
                    pair = np.union1d(pair, docs[a] % n * m + who[b] % m)
        hit = np.cumsum(cover[:-1]) > 0
        edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        row = doc[begin]
        out = {
            "n_words": pa.array(count, pa.int64()),
            "longest_match": pa.array(longest, pa.int32()),
            "hit_starts": _lists(row, pa.array(begin - start[row], pa.int64()), n),
            "hit_ends": _lists(row, pa.array(end - start[row], pa.int64()), n),
            "hit_items": _lists(
                pair // max(1, len(items.ids)),
                pa.array([items.ids[i] for i in pair % max(1, len(items.ids))], pa.string()),
                n,
            ),
        }
        return out if before is None else _joined(before, out)

    return work


def _joined(old: dict[str, pa.Array], new: dict[str, pa.Array]) -> dict[str, pa.Array]:
    """The hits of two passes over the same rows."""
    out = {"n_words": new["n_words"]}
    both = [
        np.maximum(old["longest_match"].to_numpy(), new["longest_match"].to_numpy()),
    ]
    out["longest_match"] = pa.array(both[0], pa.int32())
    starts, ends, ids = [], [], []
    for a, b, c, d, e, f in zip(
        *(x[k].to_pylist() for k in ("hit_starts", "hit_ends", "hit_items") for x in (old, new)), strict=True
    ):
        runs: list[list[int]] = []
        for lo, hi in sorted(zip(a + b, c + d, strict=True)):
            if runs and lo <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], hi)
            else:
                runs.append([lo, hi])
        starts.append([r[0] for r in runs])
        ends.append([r[1] for r in runs])
        ids.append(sorted({*e, *f}))
    out["hit_starts"] = pa.array(starts, pa.list_(pa.int64()))
    out["hit_ends"] = pa.array(ends, pa.list_(pa.int64()))
    out["hit_items"] = pa.array(ids, pa.list_(pa.string()))
    return out


def blocks(benchmark: DataFrame, item: str, text: str, block_words: int) -> Iterator[tuple[list, list[str]]]:
    """The benchmark in blocks of at most ``block_words`` words, or of one item."""
    ids, texts, held = [], [], 0
    rows = benchmark.select(F.col(f"`{item}`").cast("string"), F.coalesce(F.col(f"`{text}`"), F.lit("")))
    for i, t in rows.toLocalIterator():
        size = len(t.encode()) // 2 + 1  # words, at most
        if ids and held + size > block_words:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(i)
        texts.append(t)
        held += size
    if ids:
        yield ids, texts


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` (or their columns ``keep``) with n_words, longest_match (words of the longest
    run shared with an item), hit_starts and hit_ends (runs of covered words) and hit_items."""
    found = list(blocks(benchmark, item, item_text, block_words)) or [([], [])]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in {f.name for f in FIELDS}]
    for i, block in enumerate(found):
        shared = docs.sparkSession.sparkContext.broadcast((*block, window))
        last = i == len(found) - 1
        docs = _pass(docs, text, shared, keep if last else list(dict.fromkeys([*keep, text])), i > 0)
    return docs


def _pass(docs: DataFrame, text: str, shared, keep: list[str], again: bool) -> DataFrame:
    names = [f.name for f in FIELDS]
    (so_far,) = free(docs, "_found")
    if again:  # what earlier passes found comes in as one column
        docs = docs.withColumn(so_far, F.struct(*names)).drop(*names)

    def make() -> Callable[[pa.RecordBatch], dict[str, pa.Array]]:
        work = _search(Items(*shared.value))

        def step(part: pa.RecordBatch) -> dict[str, pa.Array]:
            before = None
            if again:
                flat = part.column(so_far).flatten()
                before = dict(zip(names, flat, strict=True))
            return work(part, text, before)

        return step

    if not again:
        return with_columns(docs, text, FIELDS, make, keep, SHARD_BYTES)
    return with_columns(docs, text, FIELDS, make, [*keep, so_far], SHARD_BYTES).drop(so_far)


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **kwargs) -> DataFrame:
    """For each row: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = search(docs, benchmark, keep=[key], **kwargs)
    n_hit = F.aggregate(
        F.zip_with("hit_starts", "hit_ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x
    )
    ids = F.array_join(F.array_sort("hit_items"), ",")
    return found.select(
        f"`{key}`",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the rows in which a window of an item occurs."""
    for block in blocks(benchmark, item, item_text, block_words):
        shared = docs.sparkSession.sparkContext.broadcast((*block, window))

        def make(shared=shared) -> Callable[[pa.RecordBatch], list]:
            work = _search(Items(*shared.value), pairs=False)
            return lambda part: pc.equal(pc.list_value_length(work(part, text, None)["hit_starts"]), 0)

        docs = keep_where(docs, text, make, SHARD_BYTES)
    return docs
