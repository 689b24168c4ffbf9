"""Toxicity by maximum-scoring segment search over token log-odds.

Terms are whole words and the first 4, 5 or 6 bytes of longer ones, which catches words that appear with many endings.

1. Candidates are terms of at least ``MIN_DOCS`` toxic documents of a bounded labelled sample. One pass over *all*
   documents counts their occurrences, which give the Dirichlet prior, and the sample's clean documents that hold them.
2. A term's score is its log-odds between toxic and clean documents under that prior (after Monroe et al. 2008), kept if
   it exceeds ``MIN_ODDS`` and ``Z_LIMIT`` standard errors. All other words share one negative score, which makes the
   mean score of a word negative; the decay rate of random segment scores then follows from the counts of all documents
   (Karlin and Altschul 1990).
3. Scoring scans a document once for all its maximal scoring segments (Ruzzo and Tompa 1999) over positions with terms, the
   stretches between them being one step each. A segment of score s in a document of n words is significant if
   ``K n exp(-rate s)`` is below ``E_LIMIT``; the excess of significant segments is summed and turned into a probability
   by a logistic curve fitted to the sample.

The model is a table of terms of the sample's toxic documents and a handful of numbers; the size of the sample is a parameter
of the fit. Everything else covers all documents and whole texts.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .folds import held_out, labelled_sample
from .words import ALNUM, Words, lower_ascii, mix, order_pairs, pieces, run_starts, word_hashes, words_of

FIT_ROWS = 12_000
MIN_DOCS = 3
Z_LIMIT = 3.0
MIN_ODDS = 2.0
PRIOR = 5.0
E_LIMIT = 0.5
PREFIXES = (4, 5, 6)


def _terms(data: np.ndarray, words: Words) -> list[np.ndarray]:
    """Per kind of term, one 64-bit name per word; 0 where a word has no term of the kind."""
    names = [word_hashes(data, words) | np.uint64(1)]
    lengths = words.ends - words.starts
    head = np.zeros(len(words.starts), np.uint64)
    for k in range(max(PREFIXES)):
        at = np.minimum(words.starts + k, max(0, len(data) - 1))
        head |= np.where(k < lengths, data[at] if len(data) else 0, 0).astype(np.uint64) << np.uint64(8 * k)
        if k + 1 in PREFIXES:
            names.append(np.where(lengths > k + 1, mix(head | np.uint64(k + 1) << np.uint64(56)) & ~np.uint64(1), np.uint64(0)))
    return names


def _documents_with(names: list[np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (name, row)."""
    h = np.concatenate(names)
    r = np.tile(rows, len(names))
    h, r = h[h != 0], r[h != 0]
    order = order_pairs(h, r)
    h, r = h[order], r[order]
    one = run_starts(h, r)
    return h[one], r[one]


def _toxic_terms(sample: DataFrame, min_docs: int) -> dict[int, int]:
    """Terms of the sample's toxic documents, with the number of these; the sample bounds them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(0)):
                data = lower_ascii(piece.data)
                words = words_of(data, piece.offsets, ALNUM)
                h, _ = _documents_with(_terms(data, words), words.rows())
                runs = run_starts(h)
                yield pa.RecordBatch.from_arrays([pa.array(h[runs].view(np.int64)), pa.array(np.diff(np.append(runs, len(h))))], names=["term", "n"])

    counted = sample.where("label = 1").select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return dict(counted.where(F.col("n") >= min_docs).collect())


def _corpus_counts(docs: DataFrame, sample: DataFrame, text_col: str, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Occurrences of every term in all documents, clean sample documents that have it, and the number of words."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def counter(by_document: bool):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            counts, total = np.zeros(len(known), np.int64), 0
            for batch in batches:
                for piece in pieces(batch.column(0)):
                    data = lower_ascii(piece.data)
                    words = words_of(data, piece.offsets, ALNUM)
                    names, rows = _terms(data, words), words.rows()
                    total += len(rows)
                    found = _documents_with(names, rows)[0] if by_document else np.concatenate(names)
                    at = np.minimum(np.searchsorted(known, found), max(0, len(known) - 1))
                    if len(known):
                        counts += np.bincount(at[known[at] == found], minlength=len(known))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], total))], names=["k", "n"])
        return count

    def summed(texts: DataFrame, by_document: bool) -> tuple[np.ndarray, int]:
        found = dict(texts.mapInArrow(counter(by_document), "k long, n long").groupBy("k").agg(F.sum("n")).collect())
        total = found.pop(-1, 0)
        out = np.zeros(len(terms), np.int64)
        for k, n in found.items():
            out[k] = n
        return out, total

    everywhere, words = summed(docs.select(text_col), False)
    clean, _ = summed(sample.where("label = 0").select("text"), True)
    return everywhere, clean, words


@dataclass
class Model:
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    other: float = -1.0
    rate: float = 1.0
    k: float = 1.0
    intercept: float = -2.0
    slope: float = 1.0

    def segments(self, at: np.ndarray, scores: np.ndarray) -> list[tuple[int, int, float]]:
        """All maximal scoring segments (first word, last word, score), given the words with terms and their scores.

        Every segment knows the last one before it that begins at a smaller sum, so that a search skips what earlier
        searches have passed; the whole scan takes time in proportion to the words with terms.
        """
        first, end, low, high, back = [], [], [], [], []
        total, last = 0.0, -1
        for position, score in zip(at.tolist(), scores.tolist()):
            before = total + self.other * (position - last - 1)
            total, last = before + score, position
            begin, least, j = position, before, len(low) - 1
            while j >= 0 and low[j] >= least:
                j = back[j]
            while j >= 0 and high[j] < total:
                begin, least, smaller = first[j], low[j], back[j]
                for kept in (first, end, low, high, back):
                    del kept[j:]
                j = smaller
            for kept, value in ((first, begin), (end, position), (low, least), (high, total), (back, j)):
                kept.append(value)
        return [(a, b, y - x) for a, b, x, y in zip(first, end, low, high)]

    def evidence(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[tuple]]]:
        """Per row of a piece: the summed excess of significant segments, and these as (first byte, byte behind, score)."""
        data = lower_ascii(data)
        words = words_of(data, offsets, ALNUM)
        best = np.zeros(len(words.starts))
        for names in _terms(data, words) if len(self.terms) else []:
            at = np.minimum(np.searchsorted(self.terms, names), len(self.terms) - 1)
            best = np.maximum(best, np.where(self.terms[at] == names, self.scores[at], 0))
        hits = np.flatnonzero(best > 0)
        bounds = np.searchsorted(hits, words.firsts)
        out, spans = np.zeros(len(offsets) - 1), [[] for _ in range(len(offsets) - 1)]
        for row in np.flatnonzero(np.diff(bounds)):
            own = hits[bounds[row]:bounds[row + 1]]
            n = words.firsts[row + 1] - words.firsts[row]
            for a, b, s in self.segments(own - words.firsts[row], best[own]):
                excess = self.rate * s - np.log(self.k * n / E_LIMIT)
                if excess > 0:
                    out[row] += excess
                    spans[row].append((int(words.starts[words.firsts[row] + a] - offsets[row]), int(words.ends[words.firsts[row] + b] - offsets[row]), float(s)))
        return out, spans

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * np.log1p(evidence), -50, 50)))


def _term_scores(terms: np.ndarray, toxic: np.ndarray, clean: np.ndarray, everywhere: np.ndarray, words: int, n_toxic: int, n_clean: int) -> Model:
    share = everywhere / max(1, words)
    prior = PRIOR * np.sqrt(share) + 0.5  # pseudo-documents: more for terms that all documents use
    odds = np.log((toxic + prior) / np.maximum(n_toxic - toxic + prior, 0.5)) - np.log((clean + prior) / np.maximum(n_clean - clean + prior, 0.5))
    error = np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    kept = (odds > Z_LIMIT * error) & (odds > MIN_ODDS)
    model = Model(terms[kept], odds[kept])
    p = share[kept]
    mean = float((p * model.scores).sum())
    model.other = -max(0.05, 2 * mean)

    def moment(rate: float) -> float:
        return float((p * np.exp(np.minimum(rate * model.scores, 500))).sum() + max(0.0, 1 - p.sum()) * np.exp(rate * model.other)) - 1

    low, high = 1e-6, 1.0
    while moment(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if moment(middle) < 0 else (low, middle)
    model.rate = high
    return model


def _calibrated(model: Model, sample: DataFrame) -> Model:
    """K from the best segments of clean documents, then the logistic curve."""
    def collect(what: Model) -> tuple[np.ndarray, np.ndarray]:
        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [what.evidence(piece.data, piece.offsets)[0] for piece in pieces(batch.column(0))]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found) if found else np.zeros(0)), batch.column(1)], names=["x", "label"])
        rows = sample.mapInArrow(measure, "x double, label int").groupBy(F.round("x", 4).alias("x"), "label").count().collect()
        rows = [r for r in rows for _ in range(r["count"])]
        return np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows])

    # With K as small as this every segment is significant, and the excess of the single best one gives K by the mean
    # of n exp(-rate s), which random segments spread like an exponential variable.
    tiny = 1e-9
    model.k = tiny
    x, y = collect(model)
    clean = x[(y == 0) & (x > 0)]
    model.k = float(np.clip(1 / np.mean(np.exp(-(clean + np.log(tiny / E_LIMIT)))), 1e-6, 1.0)) if len(clean) >= 5 else 1e-3
    x, y = collect(model)
    if len(set(y.tolist())) == 2:
        design = np.stack([np.ones(len(x)), np.log1p(x)], 1)
        beta = np.array([-2.0, 1.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
            beta = beta + np.clip(np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * beta), -2, 2)
        model.intercept, model.slope = float(beta[0]), max(float(beta[1]), 0.0)
    return model


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> Model:
    sample = labelled_sample(docs, labels, label, id_col, text_col, fit_rows)
    sizes = dict(sample.groupBy("label").count().collect())
    if not sizes.get(1) or not sizes.get(0):
        return Model(intercept=-2.0)
    found = _toxic_terms(sample, MIN_DOCS)
    terms = np.sort(np.array(list(found), np.int64).view(np.uint64))
    toxic = np.array([found[int(t)] for t in terms.view(np.int64)], np.float64)
    everywhere, clean, words = _corpus_counts(docs, sample, text_col, terms)
    return _calibrated(_term_scores(terms, toxic, clean, everywhere, words, sizes[1], sizes[0]), sample)


def toxic_passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, passages) for every row: passages are the significant segments as (first byte, byte behind the last, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL(
        "score double, passages array<struct<first:long,behind:long,score:double>>").fields])
    kind = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64()), ("score", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.evidence(piece.data, piece.offsets) for piece in pieces(batch.column(1))]
            x = np.concatenate([e for e, _ in found]) if found else np.zeros(0)
            spans = [[dict(zip(("first", "behind", "score"), s)) for s in row] for _, rows in found for row in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.probability(x)), pa.array(spans, kind)], names=["id", "score", "passages"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(score, schema).withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **fit) -> DataFrame:
    """(id, held_out, score, predicted, passages) for every row of ``docs``.

    NULL and empty texts have no segment and get the curve's lowest value. Without labelled rows of both classes nothing is
    toxic. Repeated rows score alike. Only the text is looked at.
    """
    model = fitted(docs, labels, id_col=id_col, text_col=text_col, **fit)
    scored = toxic_passages(docs, model, id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")
