"""Vectorised text kernels on Arrow buffers, used inside Arrow batch functions.

A block is a run of rows whose texts hold about ``BLOCK_BYTES`` together, so the memory of a
task does not depend on how many rows Spark puts in one Arrow batch.  A single longer text makes
a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words are runs of bytes outside 0x20 and 0x09-0x0D.
SPACE_BREAKS = np.zeros(256, dtype=bool)
SPACE_BREAKS[[0x20, *range(0x09, 0x0E)]] = True
#: Words are runs of digits, lower-case ASCII letters and bytes of non-ASCII characters.
ALNUM_BREAKS = np.ones(256, dtype=bool)
ALNUM_BREAKS[0x30:0x3A] = ALNUM_BREAKS[0x61:0x7B] = ALNUM_BREAKS[0x80:] = False


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    column = pa.concat_arrays([column]) if column.offset else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        have = np.full(size, base, dtype=U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash of ``data``; see ``span_hashes``."""
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(len(data)), out=out[1:], dtype=U64)
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of data[start:stop], equal for equal bytes wherever they stand."""
    h = (prefix[stop] - prefix[start]) * powers(len(prefix), _BASE_INV)[start]
    return mix(h ^ ((stop - start).astype(U64) * U64(0xD6E8FEB86659FD93)))


_LANE_KEYS = mix(np.arange(1, (1 << 12) + 1, dtype=U64) * U64(_BASE))
_LANE_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` on as one number; zeros follow the end."""
    padded = np.zeros(len(data) + 9, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 2,), "<u8", padded, 0, (1,))


def lane_at(wide: np.ndarray, place: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The numbers at ``place`` of ``lanes``, each with its first ``left`` bytes only."""
    return wide[np.minimum(place, len(wide) - 1)] & _LANE_MASK[np.clip(left, 0, 8)]


def byte_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of data[start:stop], equal for equal bytes wherever they stand.

    Eight bytes at a time go through a bijection keyed by their place, and the results are added:
    no structure of the bytes cancels out, as it does in a polynomial modulo 2**64.  Strings of
    equal length up to eight bytes never collide.
    """
    size = (stop - start).astype(np.int64)
    if not len(size):
        return np.zeros(0, U64)
    count = np.maximum(1, -(-size // 8))
    first = np.r_[0, np.cumsum(count)[:-1]]
    nth = np.arange(first[-1] + count[-1]) - np.repeat(first, count)
    value = lane_at(lanes(data), np.repeat(start, count) + 8 * nth, np.repeat(size, count) - 8 * nth)
    most = int(nth.max()) + 1
    keys = _LANE_KEYS if most <= len(_LANE_KEYS) else mix(np.arange(1, most + 1, dtype=U64) * U64(_BASE))
    return mix(np.add.reduceat(mix(value ^ keys[nth]), first) ^ (size.astype(U64) * U64(0xD6E8FEB86659FD93)))


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, row) of every word of lower-cased ``data``; words never cross rows."""
    inside = ~breaks[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | first[:-1]))
    stop = np.flatnonzero(inside & (~after | first[1:])) + 1
    return start, stop, np.searchsorted(offsets, start, "right") - 1


_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], dtype=U64)


def word_shingles(word: np.ndarray, row: np.ndarray, k: int = 5, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, row, first word) of all k-word shingles, in order of the words.

    A row with fewer than ``k`` words has its whole sequence as its only shingle if ``short``.
    """
    n = len(word)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(row[: max(0, n - k + 1)] == row[k - 1 :]) if n >= k else np.zeros(0, np.int64)
    acc = np.zeros(len(at), dtype=U64)
    for j in range(k):
        acc += mix(word[at + j] + U64(int(_STEPS[j % 5]) * (j // 5 + 1) % (1 << 64))) * _STEPS[(j + 1) % 5]
    value, owner = mix(acc), row[at]
    if short:
        heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        counts = np.diff(np.r_[heads, n])
        heads, counts = heads[counts < k], counts[counts < k]
        if len(heads):
            tail = np.zeros(len(heads), dtype=U64)
            for j in range(k - 1):
                have = counts > j
                tail[have] += mix(word[heads[have] + j] + _STEPS[j % 5]) * _STEPS[(j + 1) % 5]
            tail = mix(tail ^ counts.astype(U64))
            value, owner, at = np.r_[value, tail], np.r_[owner, row[heads]], np.r_[at, heads]
            order = np.argsort(at, kind="stable")
            value, owner, at = value[order], owner[order], at[order]
    return value, owner, at
