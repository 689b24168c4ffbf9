"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A document's words are streamed through it; after each word it
knows the longest run ending there that some item has. Runs of ``window`` words or more are hits, and so are whole items
of fewer words. Spans of hit words are cut out of the text, and a document that is mostly hits goes as a whole.

Only stretches of words that all occur in items are streamed; the others leave the automaton in its start anyway.
Items are dealt into shards of bounded text, one automaton each; every shard is one pass over the documents and the only
thing that is broadcast. With more than one shard the documents are written between passes.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import written
from .words import ALNUM, lower_ascii, member, pieces, word_hashes, words_of

SHARD_BYTES = 256 << 10


class Automaton:
    """Longest runs of words that items have, with the items of each run of ``window`` words and of each shorter item."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        shorts: dict[int, set] = {}
        longs: list[tuple[int, str | None]] = []
        self.shortest = window
        for name, text in items:
            data = lower_ascii(np.frombuffer(text.encode(), np.uint8))
            spans = words_of(data, np.array([0, len(data)]), ALNUM)
            words = [data[a:b].tobytes() for a, b in zip(spans.starts, spans.ends)]
            last = 0
            for k, word in enumerate(words):
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
                if k + 1 >= window:
                    longs.append((last, name))
            if 0 < len(words) < window:
                shorts.setdefault(last, set()).add(name)
                self.shortest = min(self.shortest, len(words))
        # Splitting states later never changes the class that a whole prefix of an item leads to.
        self.top = [-1] * len(self.link)
        self.shorts: list[tuple] = [()] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[v]
            if self.length[v] >= window:
                self.top[v] = v if self.length[up] < window else self.top[up]
            own = ((self.length[v], frozenset(shorts[v])),) if v in shorts else ()
            self.shorts[v] = self.shorts[up] + own
        self.items: dict[int, set] = {}
        for v, name in longs:
            self.items.setdefault(self.top[v], set()).add(name)
        known = b"\n".join(self.vocabulary)
        data = np.frombuffer(known, np.uint8)
        self.hashes = np.sort(word_hashes(data, words_of(data, np.array([0, len(data)]), ALNUM))) if known else np.zeros(0, np.uint64)

    def _extend(self, last: int, token: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if token in nxt[last]:
            q = nxt[last][token]
            return q if length[q] == length[last] + 1 else self._clone(last, token, q)
        new = len(link)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and token not in nxt[p]:
            nxt[p][token] = new
            p = link[p]
        if p != -1:
            q = nxt[p][token]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, token, q)
        return new

    def _clone(self, p: int, token: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(link)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p != -1 and nxt[p].get(token) == q:
            nxt[p][token] = copy
            p = link[p]
        return copy

    def run(self, tokens: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Hits (first, last word) of a stretch of known words, and the items that occur in it."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        hits, found = [], set()
        for i, token in enumerate(tokens):
            while state and token not in nxt[state]:
                state = link[state]
                matched = length[state]
            if token in nxt[state]:
                state = nxt[state][token]
                matched += 1
            if matched >= window:
                hits.append((i - window + 1, i))
                found |= self.items[self.top[state]]
            for size, names in self.shorts[state]:
                if size <= matched:
                    hits.append((i - size + 1, i))
                    found |= names
        return hits, found

    def search(self, data: np.ndarray, words, known: np.ndarray, first: int, last: int) -> tuple[list[tuple[int, int]], set]:
        """Hits among words ``first`` to ``last`` of a piece, counted from ``first``."""
        edges = np.flatnonzero(np.diff(known[first:last].astype(np.int8), prepend=0, append=0))
        hits, found = [], set()
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a < self.shortest:
                continue
            tokens = [self.vocabulary.get(data[s:e].tobytes(), -1) for s, e in zip(words.starts[first + a:first + b], words.ends[first + a:first + b])]
            at, names = self.run(tokens)
            hits += [(x + int(a), y + int(a)) for x, y in at]
            found |= names
        return hits, found


def _merged(hits: list[tuple[int, int]]) -> list[int]:
    """Overlapping and touching hits as flat [first, last, first, last, ..]."""
    out: list[int] = []
    for a, b in sorted(hits):
        if out and a <= out[-1] + 1:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _shards(benchmark: DataFrame, id_col: str, text_col: str, shard_bytes: int) -> Iterator[list[tuple]]:
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    for k in range(shards):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == k).collect()]


MATCHES = "n_words long, hits array<long>, items array<string>, clean string"


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hits: list[int], max_span: int) -> str | None:
    """The text without its hit stretches of more than ``max_span`` words; None if there are none."""
    spans = [(a, b) for a, b in zip(hits[::2], hits[1::2]) if b - a + 1 > max_span]
    if not spans:
        return None
    at, left, raw = 0, [], data.tobytes()
    for a, b in spans:
        left.append(raw[at:starts[a]])
        at = ends[b]
    return b"".join([*left, raw[at:]]).decode()


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                      window: int = 10, shard_bytes: int = SHARD_BYTES, cut_over: int | None = None) -> DataFrame:
    """(row, n_words, hits, items, clean) for every row of ``docs``: ``row`` is the whole row as a struct, so columns of any name pass.

    Words are runs of digits, letters and characters beyond ASCII, with A-Z folded. ``hits`` holds the first and last
    word of every maximal stretch of hit words; ``items`` the ids of items that occur, as text, without NULL ids. A
    NULL or empty text has no words; items without words, or with NULL text, match nothing. Equal items are all named.
    With ``cut_over``, ``clean`` is the text without stretches of more words than that, NULL where nothing is to cut.
    """
    spark = docs.sparkSession
    frame = docs.select(F.struct("*").alias("row"), F.array().cast("array<long>").alias("hits"), F.array().cast("array<string>").alias("items"))
    schema = T.StructType(frame.schema.fields[:1] + T.StructType.fromDDL(MATCHES).fields)
    shards = list(enumerate(_shards(benchmark, item_id_col, item_text_col, shard_bytes)))
    for k, rows in shards:
        if k:
            frame = written(frame.select("row", "hits", "items"), "matches")
        shared = spark.sparkContext.broadcast(Automaton(rows, window))
        last = k == len(shards) - 1

        def search(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                texts = batch.column(0).field(text_col)
                for piece in pieces(texts, 1 << 20):
                    own = batch.slice(piece.lo, piece.hi - piece.lo)
                    before = own.column(1).to_pylist(), own.column(2).to_pylist()
                    data = lower_ascii(piece.data)
                    words = words_of(data, piece.offsets, ALNUM)
                    known = member(word_hashes(data, words), automaton.hashes)
                    hits, items, clean = [], [], []
                    for row, (old, named) in enumerate(zip(*before)):
                        a, b = words.firsts[row], words.firsts[row + 1]
                        at, names = automaton.search(data, words, known, a, b)
                        hits.append(_merged(at + list(zip(old[::2], old[1::2]))))
                        items.append(sorted({*named, *(n for n in names if n is not None)}))
                        lo, hi = piece.offsets[row], piece.offsets[row + 1]
                        clean.append(_cut(piece.data[lo:hi], words.starts[a:b] - lo, words.ends[a:b] - lo, hits[-1], cut_over)
                                     if last and cut_over is not None and hits[-1] else None)
                    yield pa.RecordBatch.from_arrays([own.column(0), pa.array(np.diff(words.firsts).astype(np.int64)), pa.array(hits, pa.list_(pa.int64())),
                                                      pa.array(items, pa.list_(pa.string())), pa.array(clean, pa.string())], names=["row", "n_words", "hits", "items", "clean"])

        frame = frame.mapInArrow(search, schema)
    return frame


def hit_words(hits: str = "hits"):
    """The number of words in the stretches of ``hits``."""
    pairs = F.sequence(F.lit(0), F.size(hits) - 1, F.lit(2))
    total = F.aggregate(pairs, F.lit(0).cast("long"), lambda s, i: s + F.get(hits, i + 1) - F.get(hits, i) + 1)
    return F.when(F.size(hits) > 0, total).otherwise(F.lit(0).cast("long"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", window: int = 10) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``."""
    found = benchmark_matches(docs, benchmark, window=window)
    n_hit = hit_words()
    return found.select(F.col("row").getField(id_col).alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = 10, max_span: int = 0, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` with its own columns, without benchmark passages.

    Stretches of more than ``max_span`` hit words are cut out of the text, from the first word's start to the last
    word's end. A document of which more than ``max_coverage`` of the words are hits goes as a whole. Documents
    without a hit come back as they are.
    """
    found = benchmark_matches(docs, benchmark, text_col=text_col, window=window, cut_over=max_span)
    kept = found.where(hit_words() <= F.col("n_words") * max_coverage)
    return kept.select(*[(F.coalesce("clean", F.col("row").getField(c)) if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
