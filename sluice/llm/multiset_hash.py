"""Homomorphic multiset hash of documents: wide vectors hashed from paragraphs, summed modulo powers of two.

A paragraph is a line of the text; a text is the multiset of its paragraphs, an empty text has none. Each paragraph gives
a vector, and the vector of a text is the sum of those of its paragraphs, so that it does not depend on their order, equal
texts have equal vectors, and a paragraph is inserted or deleted by adding or subtracting its vector
(:func:`added`, :func:`removed`; after Clarke et al. 2003 and Bellare and Micciancio 1997).

* ``SEALS`` lanes modulo 2^64 are hashes of the paragraph's bytes: they tell whether two multisets are equal.
* ``LANES`` lanes modulo 2^32 tell how alike they are: every run of ``WIDTH`` words of a paragraph, and the paragraph
  itself, adds 1 or -1 to one of them (Charikar et al. 2002). The squared length of the difference of two vectors is an
  unbiased estimate of that of the difference of the two multisets; see :func:`likeness`.

:func:`edited_fingerprints` puts the documents in order by range: cuts of the ids (and of text hashes where one id fills
more than one range), dealt once. Within a range the next document is the next row; the first row of each range is sent
to the range before it, too. Texts cross the network once and are never gathered: a task holds one batch and one row.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import SPACED, Words, mix, pieces, run_starts, whole, windows, word_hashes, words_of

SEALS = 4
LANES = 128
WIDTH = 3
ROWS = 4096
RANGE_BYTES = 32 << 20
MAX_RANGES = 1 << 16
_BREAK = 0x0A
_SALTS = mix(np.arange(1, SEALS + 1, dtype=np.uint64))


def _summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2^64 of values by row; rows ascend."""
    out = np.zeros(n, np.uint64)
    if len(rows):
        cuts = run_starts(rows)
        out[rows[cuts]] = np.add.reduceat(values, cuts)
    return out


def vectors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seal lanes and counting lanes of the texts between ``offsets`` in UTF-8 bytes."""
    n = len(offsets) - 1
    filled = np.flatnonzero(np.diff(offsets))
    # A paragraph begins where a text does and behind each break, and ends before a break or where the text does.
    breaks = np.flatnonzero(data == _BREAK)
    starts = np.sort(np.concatenate([offsets[:-1][filled], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:][filled]]))
    held = np.searchsorted(breaks, offsets)
    row = np.repeat(filled, np.diff(held)[filled] + 1)
    text = np.flatnonzero(ends > starts)
    hashes = [np.zeros(len(starts), np.uint64) for _ in range(2)]
    for which in range(2):
        hashes[which][text] = word_hashes(data, Words(starts[text], ends[text], offsets), which)
    seals = np.stack([_summed(row, mix(mix(hashes[0] + s) ^ hashes[1]), n) for s in _SALTS], axis=1)

    words = words_of(data, offsets, SPACED)
    inside = Words(words.starts, words.ends, np.append(np.searchsorted(words.starts, starts), len(words.starts)))
    first = whole(inside, WIDTH)
    units = windows(word_hashes(data, words), WIDTH)[first]
    at = np.concatenate([words.rows()[first], row])
    units = np.concatenate([units, mix(hashes[0] ^ hashes[1])])
    lane = at * LANES + (units >> np.uint64(57)).astype(np.int64)
    sign = 1.0 - 2.0 * (units & np.uint64(1)).astype(np.float64)
    lanes = np.bincount(lane, weights=sign, minlength=n * LANES).astype(np.int64).astype(np.uint32).reshape(n, LANES)
    return seals, lanes


def texts_vectors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """:func:`vectors` of a text column, in pieces of bounded size; NULL is empty."""
    found = [(np.zeros((0, SEALS), np.uint64), np.zeros((0, LANES), np.uint32))]
    for lo in range(0, len(texts), ROWS):
        found += [vectors(p.data, p.offsets) for p in pieces(texts.slice(lo, ROWS))]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def packed(seals: np.ndarray, lanes: np.ndarray) -> list[bytes]:
    """Fingerprints as bytes, little-endian: the seal lanes, then the counting lanes."""
    return [s.tobytes() + c.tobytes() for s, c in zip(seals.astype("<u8"), lanes.astype("<u4"))]


def unpacked(fingerprints: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = np.frombuffer(b"".join(fingerprints), np.uint8).reshape(len(fingerprints), SEALS * 8 + LANES * 4)
    split = np.ascontiguousarray(joined[:, :SEALS * 8]), np.ascontiguousarray(joined[:, SEALS * 8:])
    return split[0].view("<u8").astype(np.uint64), split[1].view("<u4").astype(np.uint32)


def fingerprint(text: str | None) -> bytes:
    """The fingerprint of one text; NULL is empty."""
    return packed(*texts_vectors(pa.array([text], pa.large_string())))[0]


def _combined(a: bytes, b: bytes, sign: int) -> bytes:
    (s, t), (c, d) = unpacked([a]), unpacked([b])
    return packed(s + c if sign > 0 else s - c, t + d if sign > 0 else t - d)[0]


def added(a: bytes, b: bytes) -> bytes:
    """The fingerprint of all paragraphs of both."""
    return _combined(a, b, 1)


def removed(a: bytes, b: bytes) -> bytes:
    """The fingerprint of ``a`` without the paragraphs of ``b``, all of which ``a`` must have."""
    return _combined(a, b, -1)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1 per row: 1 less the squared length of the difference over the sum of both squared lengths, which is the share
    of word runs that both have (twice the common ones over all). 1 for equal vectors, also for two empty texts.

    The error is about (1 - likeness) times the root of 2 over ``LANES``. Counts of one run that differ by 2^31 or more
    wrap around.
    """
    square = lambda x: (x.view(np.int32).astype(np.float64) ** 2).sum(axis=1)
    far, total = square(np.ascontiguousarray(a[1] - b[1])), square(a[1]) + square(b[1])
    found = 1.0 - far / np.where(total > 0, total, 1.0)
    same = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    return np.where(same, 1.0, np.clip(np.where(total > 0, found, 0.0), 0.0, 1.0))


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """The table with the fingerprint (binary) of each text as the column ``out``, in one pass without a shuffle.

    A NULL text is empty. Repeated rows stay; an empty table stays empty. A column that is called ``out`` is replaced.
    """
    kept = docs.drop(out) if out in docs.columns else docs
    position = kept.columns.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(packed(*texts_vectors(batch.column(position))), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])

    return kept.mapInArrow(each, kept.withColumn(out, F.lit(b"")).schema)


# ------------------------------------------------ documents in order, each with the next one

def _cuts(ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Range starts (inverted id, text hash) from ascending sample ids; an id that repeats is cut by its text hashes."""
    values, counts = np.unique(np.array(ids, np.int64), return_counts=True)
    keys, hashes = [], []
    for v, m in zip((~values).tolist(), counts.tolist()):
        for j in range(m):
            keys.append(v)
            hashes.append(-(1 << 63) + (j << 64) // m)
    order = np.lexsort((np.array(hashes, np.int64), np.array(keys, np.int64)))
    return np.array(keys, np.int64)[order], np.array(hashes, np.int64)[order]


class Ranges:
    """Where rows belong in descending order of ids, NULLs last, ties by text hash."""

    def __init__(self, ids: list[int], null_ranges: int):
        self.keys, self.hashes = _cuts(ids)
        self.nulls = np.array([-(1 << 63) + (j << 64) // null_ranges for j in range(1, null_ranges)], np.int64)

    def of(self, null: np.ndarray, key: np.ndarray, h: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        out = lo.copy()
        for a in np.unique(lo[hi > lo]):
            own = np.flatnonzero((lo == a) & (hi > lo))
            out[own] = a + np.searchsorted(self.hashes[a:hi[own[0]]], h[own], "right")
        return np.where(null, len(self.keys) + 1 + np.searchsorted(self.nulls, h, "right"), out)


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id is NULL, inverted id, text hash) per row: ascending in the order of the documents."""
    ids = batch.column(0)
    return np.array(ids.is_null()), ~ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(1).to_numpy(zero_copy_only=False)


def _first_keys(plain: DataFrame, ranges: Ranges) -> dict[int, tuple]:
    """The first key of every range that has rows."""
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null, key, h = _keys(batch)
            of = ranges.of(null, key, h)
            order = np.lexsort((h, key, null, of))
            first = order[run_starts(of[order])]
            yield pa.RecordBatch.from_arrays([pa.array(of[first].astype(np.int32)), pa.array(null[first]), pa.array(key[first]), pa.array(h[first])],
                                             names=["bucket", "nul", "key", "h"])

    found = plain.select("id", "h").mapInArrow(least, "bucket int, nul boolean, key long, h long")
    return {r[0]: tuple(r[1]) for r in found.groupBy("bucket").agg(F.min(F.struct("nul", "key", "h"))).collect()}


def _dealt(plain: DataFrame, ranges: Ranges, firsts: dict[int, tuple]) -> DataFrame:
    """Rows with their range; equal rows of a batch once, with their number; first rows also as guests of the range before."""
    order = sorted(firsts)
    before = {firsts[b]: order[i - 1] for i, b in enumerate(order)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null, key, h = _keys(batch)
            order = np.lexsort((h, key, null))
            cuts = run_starts(null[order], key[order], h[order])
            rows, n = order[cuts], np.diff(np.append(cuts, len(order)))
            of = ranges.of(null[rows], key[rows], h[rows])
            guests = [(i, host) for i, k in enumerate(zip(null[rows].tolist(), key[rows].tolist(), h[rows].tolist())) if (host := before.get(k)) is not None]
            picked = np.concatenate([np.arange(len(rows)), np.array([i for i, _ in guests], np.int64)])
            at = rows[picked]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([of, np.array([b for _, b in guests], np.int64)]).astype(np.int32)), pa.array(np.arange(len(picked)) >= len(rows)),
                 pa.array(null[at]), pa.array(key[at]), pa.array(h[at]), pa.array(n[picked].astype(np.int64)), batch.column(2).take(pa.array(at))],
                names=["bucket", "guest", "nul", "key", "h", "n", "text"])

    return plain.select("id", "h", "text").mapInArrow(deal, "bucket int, guest boolean, nul boolean, key long, h long, n long, text string")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; each is closed by the row behind it in its range."""
    open_row = None  # (bucket, id, text, seals, lanes)
    for batch in batches:
        seals, lanes = texts_vectors(batch.column(6))
        buckets, guests, nulls, keys, copies = (batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5))
        done = []
        for i, text in enumerate(batch.column(6)):
            row = (buckets[i], None if nulls[i] else ~keys[i], text.as_py() or "", seals[i], lanes[i])
            if open_row and open_row[0] == row[0]:
                done.append((1, open_row, row))
            if copies[i] > 1 and not guests[i]:
                done.append((copies[i] - 1, row, row))
            open_row = None if guests[i] else row
        for lo in range(0, len(done), ROWS):
            yield _rows(done[lo:lo + ROWS])


def _rows(done: list[tuple]) -> pa.RecordBatch:
    texts = [a[2][:len(a[2]) - len(a[2]) // 2] + b[2][:len(a[2]) // 2] for _, a, b in done]
    column = pa.array(texts, pa.large_string())
    own, after = ((np.stack([r[k][3] for r in done]), np.stack([r[k][4] for r in done])) for k in (1, 2))
    new = texts_vectors(column)
    times = np.repeat(np.arange(len(done)), [n for n, _, _ in done])
    found = pa.RecordBatch.from_arrays(
        [pa.array([a[1] for _, a, _ in done], pa.int64()), pa.array([len(a[2]) for _, a, _ in done], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
         pa.array(packed(*own), pa.binary()), pa.array(packed(*new), pa.binary()), pa.array(likeness(own, new)), pa.array(likeness(own, after))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    return found.take(pa.array(times)) if len(times) > len(done) else found


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of ``docs``.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many, or all, of the next
    document's. Documents go by descending id (a whole number), rows without an id last, ties by the hash of the text;
    the one behind the last is the first. Fingerprints are binary.

    A NULL text is empty, and an empty text stays empty when edited. Repeated rows give a row each: of equal rows each is
    the next one of another. A single row is its own next one; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n, known, size = plain.agg(F.count(F.lit(1)), F.count("id"), F.sum(F.octet_length("text"))).first()
    parts = min(MAX_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // RANGE_BYTES)))
    count = 4 * parts
    ids = plain.agg(F.percentile_approx("id", [i / count for i in range(1, count)], max(10_000, 4 * count))).first()[0] if known else None
    ranges = Ranges(ids or [], max(1, -(-count * (n - known) // max(1, n))))
    hashed = plain.withColumn("h", F.xxhash64("text"))
    dealt = _dealt(hashed, ranges, _first_keys(hashed, ranges))
    sorted_ = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "guest", "nul", "key", "h")
    return sorted_.mapInArrow(_edited, "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double")
