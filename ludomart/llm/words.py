"""Words of many texts at once, from the bytes of an Arrow string column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Separators are ASCII only, so a class of characters is a class of bytes of
# UTF-8, and bytes from 0x80 on always belong to a word.
SPACE = np.ones(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
# Bytes whose words are hashed at a time.
SLICE_BYTES = 1 << 19
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([np.ones(1, np.uint64), np.full(max(n, 256) - 1, _BASE)]).cumprod()
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close values."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row begins in them; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind, width = np.int64, 8
    else:
        kind, width = np.int32, 4
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, n + 1, column.offset * width).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    raw = raw[at[0] : at[-1]]
    at = at - at[0]
    if column.null_count:
        gone = column.is_null().to_numpy(zero_copy_only=False)
        if (np.diff(at)[gone] > 0).any():  # bytes below a null
            hide = np.repeat(gone, np.diff(at))
            raw = raw[~hide]
            at = np.concatenate([[0], np.cumsum(np.where(gone, 0, np.diff(at)))])
    return raw, at


def words(column: pa.Array, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): a 64-bit hash of each word in lower case (A-Z only), never 0, and
    where the words of each row begin (one more entry at the end)."""
    raw, at = bytes_of(column)
    # Rows in slices: several numbers of 64 bits for each byte are held of one slice only.
    cuts = [0]
    while cuts[-1] < len(at) - 1:
        lo = cuts[-1]
        cuts.append(max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE_BYTES, side="right")) - 1))
    found = [_words(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], inside) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    if len(found) == 1:
        return found[0]
    count = np.concatenate([np.empty(0, np.int64), *(np.diff(first) for _, first in found)])
    return np.concatenate([np.empty(0, np.uint64), *(h for h, _ in found)]), np.concatenate([[0], np.cumsum(count)])


def _words(raw: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(at) - 1
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    mask = inside[raw]
    starts = mask.copy()
    starts[1:] &= ~mask[:-1]
    heads = at[:-1][np.diff(at) > 0]
    starts[heads] = mask[heads]
    word = _LOWER[raw[mask]] + np.uint64(1)
    begin = np.flatnonzero(starts[mask])
    if not len(begin):
        return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    length = np.diff(np.append(begin, len(word)))
    place = np.arange(len(word)) - np.repeat(begin, length)
    h = np.add.reduceat(word * powers(int(length.max()))[place], begin)
    h = mix(h + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    h[h == 0] = np.uint64(1)
    where = np.flatnonzero(starts)
    return h, np.searchsorted(where, at).astype(np.int64)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``k`` words within a row; a row of fewer words has its
    whole sequence as one run."""
    n = len(first) - 1
    count = np.diff(first)
    runs = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(n), runs)
    start = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs) + first[:-1][row]
    out = np.zeros(len(row), np.uint64)
    left = np.minimum(count[row], k)
    for j in range(k):
        ok = j < left
        if ok.all():
            out = mix(out * _BASE + h[start + j])
        else:
            out[ok] = mix(out[ok] * _BASE + h[start[ok] + j])
    return row, out
