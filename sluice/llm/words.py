"""Words of Arrow text batches as NumPy arrays: spans, hashes, windows and packed sorted hash lists.

Everything here works inside a task on one Arrow batch, in pieces of bounded size. Word hashes are polynomial over the
bytes, computed for a whole piece at once by prefix sums modulo 2^64, and mixed afterwards.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 2 << 20
BLOCK = 1 << 18
_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_WHITE = {0x20, *range(0x09, 0x0E)}
#: Bytes of words: all but ASCII white space; or digits, lower-case ASCII letters and everything beyond ASCII.
SPACED = _table(set(range(256)) - _WHITE)
ALNUM = _table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


@dataclass
class Piece:
    """Rows ``lo`` to ``hi`` of a batch: their bytes, and where each row's bytes begin (one entry more than rows)."""
    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cuts a text column into runs of rows of about ``size`` bytes; a longer text is a piece of its own. NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield Piece(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Words of a piece in order: first byte, byte behind the last, and per row the number of the first word."""
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.firsts) - 1), np.diff(self.firsts))


def words_of(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> Words:
    inside = members[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _POWERS:
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(BLOCK + 1, b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _POWERS[base] = tuple(made)
    return _POWERS[base]


def word_hashes(data: np.ndarray, words: Words, which: int = 0) -> np.ndarray:
    """A 64-bit hash per word; ``which`` picks one of two independent functions."""
    base = _BASES[which]
    up, down = _powers(base)
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
    inverse = pow(base, -1, 1 << 64)
    at_start, at_end = np.empty(len(words.starts), np.uint64), np.empty(len(words.starts), np.uint64)
    scale = np.empty(len(words.starts), np.uint64)
    total = 0
    for lo in range(0, len(data), BLOCK):
        block = data[lo:lo + BLOCK]
        sums = np.empty(len(block) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[block] * up[:len(block)], out=sums[1:])
        factor = np.uint64(pow(base, lo, 1 << 64))
        a, b = np.searchsorted(words.starts, [lo, lo + len(block)])
        at_start[a:b] = np.uint64(total) + factor * sums[words.starts[a:b] - lo]
        scale[a:b] = down[words.starts[a:b] - lo] * np.uint64(pow(inverse, lo, 1 << 64))
        a, b = np.searchsorted(words.ends, [lo + 1, lo + len(block) + 1])
        at_end[a:b] = np.uint64(total) + factor * sums[words.ends[a:b] - lo]
        total = (total + int(factor) * int(sums[-1])) & _MASK
    lengths = (words.ends - words.starts).astype(np.uint64)
    return mix((at_end - at_start) * scale + lengths * np.uint64(0xA0761D6478BD642F))


def windows(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """The hash of every run of ``width`` words, by its first word; runs may cross rows, see :func:`whole`."""
    n = max(0, len(hashes) - width + 1)
    found = np.zeros(n, np.uint64)
    for k in range(width):
        found = found * np.uint64(_BASES[1 - which]) + hashes[k:k + n]
    return mix(found)


def whole(words: Words, width: int) -> np.ndarray:
    """The first words of runs of ``width`` words that lie in one row."""
    rows = words.rows()
    n = max(0, len(rows) - width + 1)
    return np.flatnonzero(rows[:n] == rows[width - 1:width - 1 + n]) if n else np.zeros(0, np.int64)


def order_pairs(values: np.ndarray, seconds: np.ndarray) -> np.ndarray:
    """The order by value, then by second; only runs of equal values pay for the second key."""
    order = np.argsort(values)
    v = values[order]
    same = np.zeros(len(v) + 1, bool)
    same[1:-1] = v[1:] == v[:-1]
    mixed = np.flatnonzero(same[1:] | same[:-1])
    order[mixed] = order[mixed][np.lexsort((seconds[order[mixed]], v[mixed]))]
    return order


def run_starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin in sorted columns."""
    if not len(sorted_columns[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(sorted_columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return np.flatnonzero(new)


def lists_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Distinct keys, and for each the list of its values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    cuts = run_starts(keys)
    return keys[cuts], pa.ListArray.from_arrays(pa.array(np.append(cuts, len(keys)).astype(np.int32)), pa.array(values.view(np.int64)))


def list_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list<long> column; a NULL list is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.array(column.value_lengths().fill_null(0)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def member(values: np.ndarray, of_sorted: np.ndarray) -> np.ndarray:
    """Which values occur in a sorted array."""
    if not len(of_sorted):
        return np.zeros(len(values), bool)
    at = np.searchsorted(of_sorted, values)
    at[at == len(of_sorted)] = 0
    return of_sorted[at] == values


def pack(ascending: np.ndarray) -> bytes:
    """Sorted unsigned numbers as byte planes of their differences: the high planes are zeros, which shuffles compress."""
    steps = np.diff(ascending.astype(np.uint64), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_small(numbers: np.ndarray) -> bytes:
    """Unsigned numbers below 2^32 as byte planes."""
    return np.ascontiguousarray(numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_small(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def bucket_count(total_bytes: int, bytes_per_bucket: int = 24 << 20, least: int = 64) -> int:
    """How many buckets a table's windows are dealt into: grows with the text, so a bucket stays of bounded size."""
    return max(least, -(-int(total_bytes or 0) // bytes_per_bucket))


def bucket_slices(ascending: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """Ranges of sorted 64-bit hashes by bucket: (bucket, from, to) for buckets that have any."""
    of = ((ascending >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(of, prepend=-1)) if len(of) else []
    for a, b in zip(cuts, [*cuts[1:], len(of)]):
        yield int(of[a]), int(a), int(b)
