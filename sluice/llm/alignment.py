"""Token alignment between two tokenizers by galloping intersection of their lists of token ends.

A text is encoded by a byte-level vocabulary (A) and by word pieces with byte fallback (B). The shorter list of byte ends
drives an exponential and then a binary search into the longer one (:func:`gallop`). Ends that both lists have cut the text
into groups; the difference of the ranks of two neighbouring ends is the range of tokens that a token overlaps, its links.

Neither vocabulary has an entry that goes on behind a space after a letter, digit or sign, so a text may be cut before such
spaces, encoded unit by unit, and aligned unit by unit: a unit's end is an end in both lists. Units repeat, so each task
keeps those it has met. Where an entry of a vocabulary crosses such a place, whole texts are units.

Counts of linked id pairs are statistics of the whole corpus. Tasks write their documents' pairs in blocks of bounded size,
and once per block its distinct pairs with the number of documents. These are summed by pair over all blocks, compared with
the highest of their A id, and sent back to the blocks they came from, where the documents add them up. A pair has one row
per block, however frequent it is; nothing but one number per id of A is broadcast.
"""
from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import scratch_path, written
from .words import pack, pack_small, run_starts, unpack, unpack_small

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
PIECE_BYTES = 2 << 20
PIECE_ROWS = 4096
BLOCK_BYTES = 16 << 20
MAX_UNITS = 200_000
MAX_UNIT_LINKS = 4 << 20

#: A space behind a letter, digit or ASCII sign begins a new unit.
_CUT = re.compile(r"(?<=[\w!-~])(?= )")
_SPACE = "▁"


# ------------------------------------------------ alignment of two lists of ends

def gallop(values: np.ndarray, guess: np.ndarray, begin: np.ndarray, stop: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """For each value the first position in ``longer[begin:stop]``, which ascends, with an element not below it, else ``stop``.

    From ``guess`` the search doubles its step to the side where the value lies, and halves the bracket it ends in.
    """
    guess = np.clip(guess, begin, np.maximum(begin, stop - 1))
    # Below low everything is smaller, and from high on nothing is.
    low, high = begin.copy(), stop.copy()
    upward = (guess < stop) & (longer[np.minimum(guess, len(longer) - 1)] < values) if len(longer) else np.zeros(len(values), bool)
    low[upward], high[~upward] = guess[upward] + 1, guess[~upward]
    for side, sign in ((upward, 1), (~upward, -1)):
        at, step = np.flatnonzero(side), 1
        while len(at):
            place = guess[at] + sign * step
            inside = (place < high[at]) if sign > 0 else (place >= low[at])
            at, place = at[inside], place[inside]
            smaller = longer[place] < values[at]
            low[at[smaller]], high[at[~smaller]] = place[smaller] + 1, place[~smaller]
            at = at[smaller if sign > 0 else ~smaller]
            step *= 2
    at = np.flatnonzero(low < high)
    while len(at):
        middle = (low[at] + high[at]) >> 1
        smaller = longer[middle] < values[at]
        low[at[smaller]], high[at[~smaller]] = middle[smaller] + 1, middle[~smaller]
        at = at[low[at] < high[at]]
    return low


def _side(ends: np.ndarray, firsts: np.ndarray, others: np.ndarray, other_firsts: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, ...]:
    """For the tokens of ``units`` in ``ends``: their positions, first and last overlapping token of the other list, and
    whether both lists end there."""
    counts = np.diff(firsts)[units]
    own = np.repeat(firsts[units] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    unit = np.repeat(units, counts)
    begin, stop = other_firsts[unit], other_firsts[unit + 1]
    last = gallop(ends[own], begin + own - firsts[unit], begin, stop, others)
    common = others[last] == ends[own] if len(own) else np.zeros(0, bool)
    first = np.where(own == firsts[unit], begin, np.roll(last + common, 1))
    return own, first, last, common


def align(ends_a: np.ndarray, firsts_a: np.ndarray, ends_b: np.ndarray, firsts_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links and common ends of units that follow one another: (A token, B token) per link in order, and (A token, B token)
    per common end. ``firsts`` has the first token of each unit and the number of tokens."""
    shorter_a = np.diff(firsts_a) <= np.diff(firsts_b)
    found = []
    for units, args in ((np.flatnonzero(shorter_a), (ends_a, firsts_a, ends_b, firsts_b)), (np.flatnonzero(~shorter_a), (ends_b, firsts_b, ends_a, firsts_a))):
        own, first, last, common = _side(*args, units)
        counts = last - first + 1
        left = np.repeat(own, counts)
        right = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        found.append((left, right, own[common], last[common]))
    (a, b, x, y), (d, c, z, w) = found  # where B drives, A is the other side
    a, b, x, y = np.concatenate([a, c]), np.concatenate([b, d]), np.concatenate([x, w]), np.concatenate([y, z])
    order = np.lexsort((b, a))
    return a[order], b[order], np.sort(x), np.sort(y)


# ------------------------------------------------ vocabularies

def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if it is visible, else the next one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers of a process, and the bytes of their entries."""

    def __init__(self, byte_level: str, word_pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=word_pieces)
        letters = _byte_letters()
        self.bytes_a = [b""] * (max(self.a.get_vocab().values()) + 1)
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(_SPACE, " ").encode() for i in range(self.b.get_piece_size())]
        self.names = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id(_SPACE)
        # Bytes that begin or end within a character count as letters.
        self.cut = not any(_CUT.search(x.decode(errors="replace").replace("\ufffd", "a")) for x in self.bytes_a + self.bytes_b)

    def units(self, text: str) -> list[str]:
        """The units of a space and the text."""
        return _CUT.split(" " + text) if self.cut else [" " + text]

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each unit, which begins with a space, by both tokenizers; B adds that space itself."""
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = [ids if u != " " else [self.space] for u, ids in zip(units, self.b.encode([u[1:] for u in units], num_threads=1))]
        return a, b


def vocabularies(byte_level: str, word_pieces: str) -> Vocabularies:
    """The process's own. This package travels to workers by value, together with its globals; a library's module does not."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers
    kept = vars(tokenizers).setdefault("_sluice_kept", {})
    if (byte_level, word_pieces) not in kept:
        kept[byte_level, word_pieces] = Vocabularies(byte_level, word_pieces)
    return kept[byte_level, word_pieces]


class Units:
    """Units met so far: per unit whether both tokenizers give its bytes, counts of tokens and groups, the groups as text,
    and its links as pair codes, A's id times the size of B and B's id."""

    def __init__(self, known: Vocabularies):
        self.known = known
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.counts = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups; 1 if the bytes differ
        self.codes, self.firsts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def numbers(self, units: list[str]) -> list[int]:
        """The number of each unit; new ones are encoded and aligned together."""
        new = [u for u in dict.fromkeys(units) if u not in self.index]
        if new:
            self._add(new)
        return [self.index[u] for u in units]

    def _add(self, new: list[str]) -> None:
        k = self.known
        ids_a, ids_b = k.encode(new)
        same = [b"".join([k.bytes_a[i] for i in x]) == (w := u.encode()) and b"".join([k.bytes_b[i] for i in y]) == w and all(len(k.bytes_b[i]) for i in y) for u, x, y in zip(new, ids_a, ids_b)]
        ids_a, ids_b = ([x if ok else [] for x, ok in zip(ids, same)] for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.array([i for x in ids for i in x], np.int64) for ids in (ids_a, ids_b))
        first_a, first_b = (np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64) for ids in (ids_a, ids_b))
        a, b, x, y = align(np.cumsum(k.lengths_a[flat_a]), first_a, np.cumsum(k.lengths_b[flat_b]), first_b)
        groups = np.searchsorted(x, first_a)  # the first group of each unit
        names_a, names_b = ([k.names[i] for i in flat.tolist()] for flat in (flat_a, flat_b))
        said, i, j = [], 0, 0
        for p, q in zip((x + 1).tolist(), (y + 1).tolist()):
            said.append(f"{','.join(names_a[i:p])}|{','.join(names_b[j:q])}")
            i, j = p, q
        at = len(self.texts)
        self.index.update(zip(new, range(at, at + len(new))))
        bounds = groups.tolist()
        self.texts += [";".join(said[i:j]).encode() for i, j in zip(bounds, bounds[1:])]
        self.counts = np.concatenate([self.counts, np.stack([np.diff(first_a), np.diff(first_b), np.diff(groups), 1 - np.array(same, np.int64)], axis=1)])
        self.firsts = np.concatenate([self.firsts, self.firsts[-1] + np.searchsorted(a, first_a[1:])])
        self.codes = np.concatenate([self.codes, flat_a[a] * len(k.bytes_b) + flat_b[b]])


def aligned(texts: list[str | None], met: Units) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts: (A tokens, B tokens, groups, links) by row, digests of the groups, and every row's distinct pair codes
    with how often they are linked, as (row, code, times) in this order."""
    if len(met.index) > MAX_UNITS or len(met.codes) > MAX_UNIT_LINKS:
        met.forget()
    cut = [met.known.units(t) if t else [] for t in texts]
    sizes = np.array([len(c) for c in cut], np.int64)
    flat = np.array(met.numbers([u for c in cut for u in c]), np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    good = np.bincount(row, weights=met.counts[flat, 3], minlength=len(texts)) == 0
    good &= sizes > 0
    kept = good[row]
    flat, row = flat[kept], row[kept]
    links = (met.firsts[1:] - met.firsts[:-1])[flat]
    counts = np.stack([np.bincount(row, weights=w, minlength=len(texts)) for w in (*met.counts[flat, :3].T, links)], axis=1).astype(np.int64)
    numbers, bounds = flat.tolist(), np.searchsorted(row, np.arange(len(texts) + 1)).tolist()
    digests = [hashlib.sha256(b";".join([met.texts[i] for i in numbers[x:y]])).hexdigest() if ok else "" for ok, x, y in zip(good, bounds, bounds[1:])]
    at = np.repeat(met.firsts[flat] - (np.cumsum(links) - links), links) + np.arange(links.sum())
    bits = (len(met.known.bytes_a) * len(met.known.bytes_b)).bit_length()
    keys = np.sort(np.repeat(row, links) << bits | met.codes[at])
    first = run_starts(keys)
    times = np.diff(np.append(first, len(keys)))
    return counts, digests, keys[first] >> bits, keys[first] & ((1 << bits) - 1), times


# ------------------------------------------------ Spark

LINKS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary, kind int"
DOCUMENTS, PAIRS = 0, 1


def _summed(codes: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, numbers = np.concatenate(codes), np.concatenate(numbers)
    order = np.argsort(codes, kind="stable")
    first = run_starts(codes[order])
    return codes[order][first], np.add.reduceat(numbers[order], first) if len(first) else numbers


def _links(plain: DataFrame, byte_level: str, word_pieces: str) -> DataFrame:
    """Rows of documents with their pairs, and rows of blocks with the number of documents that hold each pair."""
    names = [c.split(" ")[0] for c in LINKS.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Units(vocabularies(byte_level, word_pieces))
        block, held, codes, numbers = TaskContext.get().partitionId() << 32, 0, [], []

        def close() -> pa.RecordBatch:
            pairs, n = _summed(codes, numbers)
            row = [[block], [None], [None], [None], [None], [None], [None], [pack(pairs)], [pack(np.cumsum(n))], [PAIRS]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=names)

        kinds = [*[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary(), pa.int32()]
        for batch in batches:
            sizes = np.array(batch.column(2).fill_null(0)).astype(np.int64)
            lo = 0
            while lo < len(sizes):
                hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:lo + PIECE_ROWS]), PIECE_BYTES, "right")))
                counts, digests, row, code, times = aligned(batch.column(1).slice(lo, hi - lo).to_pylist(), met)
                cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = [(pack(code[x:y]), pack_small(times[x:y])) for x, y in zip(cuts, cuts[1:])]
                columns = [pa.array(np.full(hi - lo, block)), batch.column(0).slice(lo, hi - lo), *[pa.array(c) for c in counts.T], pa.array(digests), pa.array([x for x, _ in lists], pa.binary()),
                           pa.array([y for _, y in lists], pa.binary()), pa.array(np.full(hi - lo, DOCUMENTS, np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                distinct, n = np.unique(code, return_counts=True)
                codes.append(distinct)
                numbers.append(n)
                held += int(sizes[lo:hi].sum())
                lo = hi
                if held > BLOCK_BYTES:
                    yield close()
                    block, held, codes, numbers = block + 1, 0, [], []
        if codes:
            yield close()

    return plain.mapInArrow(encode, LINKS)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            codes = unpack(pairs.as_py()).astype(np.int64)
            counts = np.diff(unpack(n.as_py()).astype(np.int64), prepend=0)
            for lo in range(0, len(codes), 1 << 16):
                some = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes[some]), block)), pa.array(codes[some]), pa.array(counts[some])], names=["block", "code", "n"])


def _scored(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links."""
    codes, total, best = (pairs.column(c).to_numpy() for c in ("code", "total", "best"))
    order = np.argsort(codes)
    codes, total, best = codes[order], total[order], best[order]
    n_best, count_sum = np.zeros(len(documents), np.int64), np.zeros(len(documents), np.int64)
    for i, (p, t) in enumerate(zip(documents.column("pairs"), documents.column("times"))):
        own, times = np.searchsorted(codes, unpack(p.as_py()).astype(np.int64)), unpack_small(t.as_py()).astype(np.int64)
        n_best[i], count_sum[i] = times[best[own]].sum(), (times * total[own]).sum()
    out = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return out.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))


def token_alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str = BYTE_LEVEL, word_pieces: str = PIECES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) per row of ``docs``.

    A encodes a space and the text, B the text, before which it adds the space. Where the tokens' bytes differ from a space
    and the text, as where B normalises something, and where the text is NULL or empty, the row has no tokens: zeros, and
    '' as its digest. The digest is that of ``a1,a2|b1;a3|b2,b3``: ids by group. A pair's count is the number of rows that
    hold it linked; repeated rows count each. ``n_best`` counts links whose pair is the most frequent of its A id, ties
    included. Rows without an id stay. Other columns are not read; an empty table gives no rows.

    A stretch without spaces is encoded as a whole, in memory that the tokenizers take in proportion to its length.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.octet_length(text_col).cast("long").alias("bytes"))
    path = scratch_path(spark, "links")
    _links(plain, byte_level, word_pieces).write.partitionBy("kind").parquet(path)
    read = lambda kind: spark.read.schema(LINKS).parquet(path).where(F.col("kind") == kind).drop("kind")
    counted = read(PAIRS).select("block", "pairs", "times").mapInArrow(_opened, "block long, code long, n long")
    totals = written(counted.select("block", "code", F.sum("n").over(W.partitionBy("code")).alias("total")), "totals")
    size_b = len(vocabularies(byte_level, word_pieces).bytes_b)
    of_a = F.floor(F.col("code") / size_b).cast("int").alias("a")
    # One row per id of A: no more than the vocabulary has.
    highest = F.broadcast(totals.groupBy(of_a).agg(F.max("total").alias("most")))
    judged = totals.withColumn("a", of_a).join(highest, "a").select("block", "code", "total", (F.col("total") == F.col("most")).alias("best"))
    return read(DOCUMENTS).groupBy("block").cogroup(judged.groupBy("block")).applyInArrow(
        _scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
