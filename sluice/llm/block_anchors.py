"""Removal of word sequences that an earlier document has, by fixed-block anchors.

A *window* is ``width`` consecutive words of one document. A word goes if a window over it also starts in a document
with a smaller id; windows are judged on the input.

1. Index and probes: every document indexes its non-overlapping blocks of ``(width + 1) / 2`` words and probes with
   every rolling block of that length. A window of ``width`` words always holds one whole indexed block, wherever it
   starts. Block hashes travel to range buckets, packed and sorted; a block is an *anchor* for the documents that have
   it if one of them indexed it and another has it anywhere.
2. Extension: around its anchors a document lists the windows that hold one. For each such window (80 bits of hash)
   the least document id is found; runs of windows with a smaller one elsewhere are the maximal exact repeats.
3. The words under those windows are dropped.

Both exchanges are combined per piece of text before they leave a task: what a piece's own documents decide is not sent,
and a hash leaves a piece once, so a passage that a third of all documents share reaches a bucket once per piece.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .words import (SPACED, bucket_count, bucket_slices, list_values, lists_by, member, order_pairs, pack, pack_small, pieces, run_starts,
                    unpack, unpack_small, whole, windows, word_hashes, words_of)

SENT = "bucket long, ids binary, hashes binary, checks binary, rows binary"
SENT_ARROW = pa.schema([("bucket", pa.int64()), ("ids", pa.binary()), ("hashes", pa.binary()), ("checks", pa.binary()), ("rows", pa.binary())])
FOUND = "id long, hashes array<long>"
#: Block hashes keep 48 bits, which travel in fewer bytes; a false anchor only means windows that are looked at in vain.
_CLEAR = np.uint64(0xFFFFFFFFFFFF0000)
_FLAG, _SHIFT = np.uint64(0x8000), np.uint64(15)


def _send(h: np.ndarray, check: np.ndarray, row: np.ndarray, ids: np.ndarray, buckets: int, shift: np.uint64 = np.uint64(0)) -> dict:
    """Entries sorted by hash as one packed record per bucket; ``ids`` ascend, ``row`` points into them."""
    out = {name: [] for name in SENT_ARROW.names}
    for bucket, a, b in bucket_slices(h, buckets):
        used, local = np.unique(row[a:b], return_inverse=True)
        for name, value in zip(SENT_ARROW.names, (bucket, pack(ids[used]), pack(h[a:b] >> shift), pack_small(check[a:b]), pack_small(local))):
            out[name].append(value)
    return out


def _piece_keys() -> Iterator[int]:
    """Negative buckets, one for each piece of this task that no other piece has."""
    task = TaskContext.get().partitionId()
    return (-1 - (task << 32 | n) for n in count())


def _keep(out: dict, h: np.ndarray, row: np.ndarray, ids: np.ndarray, key: int) -> pa.RecordBatch:
    """Adds what the piece has decided itself, under the piece's own negative bucket, which is passed through. A group of
    such a bucket is one piece's, however many pieces hold the same text."""
    if len(h):
        used, local = np.unique(row, return_inverse=True)
        for name, value in zip(SENT_ARROW.names, (key, pack(ids[used]), pack(h), pack_small(np.zeros(len(h))), pack_small(local))):
            out[name].append(value)
    return pa.RecordBatch.from_pydict(out, SENT_ARROW)


def _received(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    columns = [[x.as_py() for x in table.column(c)] for c in ("ids", "hashes", "checks", "rows")]
    ids = np.concatenate([unpack(i)[unpack_small(r)] for i, r in zip(columns[0], columns[3])])
    return np.concatenate([unpack(x) for x in columns[1]]), np.concatenate([unpack_small(x) for x in columns[2]]), ids


def _lists(ids: np.ndarray, h: np.ndarray) -> pa.Table:
    keys, lists = lists_by(ids, h)
    return pa.table({"id": pa.array(keys.view(np.int64)), "hashes": lists})


def _rank(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids ascending as unsigned numbers, and each row's place among them."""
    return np.unique(ids.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), return_inverse=True)


def _anchor_lists(docs: DataFrame, block: int, buckets: int) -> DataFrame:
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _piece_keys()
        for batch in batches:
            for piece in pieces(batch.column(1)):
                words = words_of(piece.data, piece.offsets, SPACED)
                ids, rank = _rank(batch.column(0).slice(piece.lo, piece.hi - piece.lo))
                starts = whole(words, block)
                h = windows(word_hashes(piece.data, words), block)[starts] & _CLEAR
                rows = words.rows()[starts]
                indexed = (starts - words.firsts[rows]) % block == 0
                doc = rank[rows]
                order = order_pairs(h, doc)
                h, doc, indexed = h[order], doc[order], indexed[order]
                one = run_starts(h, doc)
                indexed = np.logical_or.reduceat(indexed, one) if len(one) else indexed
                h, doc = h[one], doc[one]
                runs = run_starts(h)
                sizes = np.diff(np.append(runs, len(h)))
                settled = (sizes > 1) & (np.logical_or.reduceat(indexed, runs) if len(runs) else np.zeros(0, bool))
                first = np.zeros(len(h), bool)
                first[runs] = True
                settled = np.repeat(settled, sizes)
                sent = first | ~settled
                flag = np.where((indexed | settled)[sent], _FLAG, np.uint64(0))
                out = _send(h[sent] | flag, np.zeros(int(sent.sum())), doc[sent], ids, buckets, _SHIFT)
                yield _keep(out, h[settled], doc[settled], ids, next(keys))
    return docs.mapInArrow(lists, SENT)


def _anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    h, _, ids = _received(table)
    if key[0].as_py() < 0:
        return _lists(ids, h)
    h = h << _SHIFT
    flag, h = (h & _FLAG).astype(bool), h & _CLEAR
    order = np.argsort(h)
    h, flag, ids = h[order], flag[order], ids[order]
    runs = run_starts(h)
    anchor = np.logical_or.reduceat(flag, runs) & (np.minimum.reduceat(ids, runs) != np.maximum.reduceat(ids, runs))
    anchor = np.repeat(anchor, np.diff(np.append(runs, len(h))))
    return _lists(ids[anchor], h[anchor])


def _signed_order(ids: np.ndarray) -> np.ndarray:
    return ids.view(np.int64)


def _window_lists(anchored: DataFrame, width: int, block: int, buckets: int) -> DataFrame:
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _piece_keys()
        for batch in batches:
            batch = batch.filter(batch.column(2).is_valid())
            anchor_offsets, anchors = list_values(batch.column(2))
            for piece in pieces(batch.column(1)):
                words = words_of(piece.data, piece.offsets, SPACED)
                ids, rank = _rank(batch.column(0).slice(piece.lo, piece.hi - piece.lo))
                hashes = word_hashes(piece.data, words)
                blocks = windows(hashes, block) & _CLEAR
                change = np.zeros(len(hashes) + 1, np.int64)
                for row in range(piece.hi - piece.lo):
                    a, b = words.firsts[row], words.firsts[row + 1]
                    if b - a < width:
                        continue
                    own = np.sort(anchors[anchor_offsets[piece.lo + row]:anchor_offsets[piece.lo + row + 1]].view(np.uint64))
                    hits = a + np.flatnonzero(member(blocks[a:b - block + 1], own))
                    np.add.at(change, np.maximum(hits - (width - block), a), 1)
                    np.add.at(change, np.minimum(hits, b - width) + 1, -1)
                starts = np.flatnonzero(np.cumsum(change)[:len(hashes)] > 0)
                starts = starts[starts <= len(hashes) - width]
                h = windows(hashes, width)[starts]
                check = (windows(word_hashes(piece.data, words, 1), width, 1)[starts] >> np.uint64(48)).astype(np.uint32)
                doc = rank[words.rows()[starts]]
                order = np.lexsort((_signed_order(ids)[doc], check, h))
                h, check, doc = h[order], check[order], doc[order]
                one = run_starts(h, check, doc)
                h, check, doc = h[one], check[one], doc[one]
                first = np.zeros(len(h), bool)
                first[run_starts(h, check)] = True
                yield _keep(_send(h[first], check[first], doc[first], ids, buckets), h[~first], doc[~first], ids, next(keys))
    return anchored.mapInArrow(lists, SENT)


def _repeats(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    h, check, ids = _received(table)
    if key[0].as_py() < 0:
        return _lists(ids, h)
    order = np.lexsort((_signed_order(ids), check, h))
    h, check, ids = h[order], check[order], ids[order]
    runs = run_starts(h, check)
    least = np.repeat(ids[runs], np.diff(np.append(runs, len(h))))
    return _lists(ids[ids != least], h[ids != least])


def _gathered(df: DataFrame) -> DataFrame:
    return df.groupBy("id").agg(F.flatten(F.collect_list("hashes")).alias("hashes"))


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, digest: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept) for every row; ``kept`` joins the words left by one space.

    With ``digest`` the last column is ``kept_sha256`` instead. NULL and empty texts have no words. A row with a NULL
    id is never earlier nor later than another: it keeps all words and removes none. Rows with one id are one document
    for the comparison (they do not remove each other's words), and come back one by one. Ids are integers.
    """
    block = (width + 1) // 2
    if width < 3 or width - block < block - 1:
        raise ValueError("a window must hold a whole block wherever it starts")
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(total, 12 << 20, 48)
    known = plain.where("id is not null")
    anchors = _gathered(_anchor_lists(known, block, buckets).groupBy("bucket").applyInArrow(_anchors, FOUND))
    listed = _window_lists(plain.join(anchors, "id", "left"), width, block, buckets)
    gone = _gathered(listed.groupBy("bucket").applyInArrow(_repeats, FOUND))
    last = "kept_sha256" if digest else "kept"

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, hashes = list_values(batch.column(2))
            for piece in pieces(batch.column(1)):
                n_words, n_removed, kept = [], [], []
                for row in range(piece.hi - piece.lo):
                    data = piece.data[piece.offsets[row]:piece.offsets[row + 1]]
                    words = data.tobytes().split()
                    own = hashes[offsets[piece.lo + row]:offsets[piece.lo + row + 1]]
                    n_words.append(len(words))
                    if len(own):
                        spans = words_of(data, np.array([0, len(data)]), SPACED)
                        found = windows(word_hashes(data, spans), width)
                        hits = np.flatnonzero(member(found, np.sort(own.view(np.uint64))))
                        change = np.zeros(len(words) + 1, np.int64)
                        change[hits] += 1
                        change[hits + width] -= 1
                        words = list(compress(words, (np.cumsum(change)[:-1] == 0).tolist()))
                    n_removed.append(n_words[-1] - len(words))
                    text = b" ".join(words)
                    kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(piece.lo, piece.hi - piece.lo), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                                  pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", last])

    out = plain.join(gone, "id", "left").mapInArrow(removed, f"id long, n_words long, n_removed long, {last} string")
    return out.withColumnRenamed("id", id_col)
