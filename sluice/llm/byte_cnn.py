"""Quality classifier: a byte-level convolutional network in NumPy.

A text is its UTF-8 bytes, padded with zeros to blocks of 64. Two layers of learned filters read every part of it: one
over windows of 8 bytes (step 4) through a learned embedding of bytes, one over the shares of bytes within 16 that equal
the byte 1 to 24 places earlier, which shows repetition of any word. Their rectified responses are max-pooled over
overlapping chunks of 1024 bytes that cover the whole document; the largest and the mean chunk value of every filter
are combined into one probability.

The network is fitted on the driver on a bounded sample of labelled rows (``fit_rows``), of which whole texts are used,
by Adam in a fixed order, in as many passes as it takes to see ``FIT_TEXTS`` texts, four at least; only its few thousand numbers are broadcast.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .folds import held_out, labelled_sample
from .words import pieces

BLOCK, CHUNK_BLOCKS, CHUNK_STEP = 64, 16, 15
WIDTH, STEP, EMBEDDING, BYTE_FILTERS = 8, 4, 8, 16
LAGS, LAG_FILTERS = 24, 6
FILTERS = BYTE_FILTERS + LAG_FILTERS
FIT_ROWS = 3000
FIT_TEXTS = 12_000


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bytes, each row padded with at least 32 zeros to whole blocks; and the first block of each row."""
    lengths = np.diff(offsets)
    blocks = (lengths + 32 + BLOCK - 1) // BLOCK
    firsts = np.concatenate([[0], np.cumsum(blocks)])
    out = np.zeros(int(firsts[-1]) * BLOCK, np.uint8)
    out[np.arange(len(data)) + np.repeat(firsts[:-1] * BLOCK - offsets[:-1], lengths)] = data
    return out, firsts


def lag_shares(data: np.ndarray) -> np.ndarray:
    """For every 8th byte and lag: the share of the next 16 bytes that equal the byte ``lag`` places before them."""
    out = np.empty((len(data) // 8, LAGS), np.float32)
    real = data != 0
    for lag in range(1, LAGS + 1):
        same = np.zeros(len(data), np.uint8)
        np.equal(data[lag:], data[:-lag], out=same[lag:].view(bool))
        same &= real
        eight = np.bitwise_count(same.view(np.uint64)).astype(np.float32)
        out[:, lag - 1] = eight
        out[:-1, lag - 1] += eight[1:]
    return out / 16


class Network:
    def __init__(self, seed: int = 4):
        draw = np.random.default_rng(seed)
        self.p = {"emb": draw.normal(0, 0.5, (256, EMBEDDING)), "w": draw.normal(0, 0.2, (WIDTH * EMBEDDING, BYTE_FILTERS)), "wb": np.zeros(BYTE_FILTERS),
                  "v": np.abs(draw.normal(0, 0.3, (LAGS, LAG_FILTERS))), "vb": np.full(LAG_FILTERS, -0.3), "u": draw.normal(0, 0.1, 2 * FILTERS), "b": np.zeros(1)}
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def responses(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rectified responses: of byte filters per 4 bytes, of lag filters per 8 bytes. ``ends`` are the blocks behind
        each row's last; a window that would reach into the next row has none, so a row's score is its own."""
        p = self.p
        x = p["emb"][data].reshape(len(data) // STEP, STEP * EMBEDDING)
        near, far = x @ p["w"][:STEP * EMBEDDING], x @ p["w"][STEP * EMBEDDING:]
        near[:-1] += far[1:]
        h, g = np.maximum(near + p["wb"], 0), np.maximum(lag_shares(data) @ p["v"] + p["vb"], 0)
        h[ends * (BLOCK // STEP) - 1] = 0
        g[ends * (BLOCK // 8) - 1] = 0
        return h, g

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The probability of each row of a piece; long rows are read in slices of whole chunks."""
        bytes_, firsts = padded(data, offsets)
        blocks = np.empty((int(firsts[-1]) + 1, FILTERS), np.float32)
        blocks[-1] = 0
        slice_blocks = 4096
        for lo in range(0, int(firsts[-1]), slice_blocks):
            hi = min(int(firsts[-1]), lo + slice_blocks)
            before = 1 if lo else 0
            after = 1 if hi < firsts[-1] else 0
            inside = firsts[(firsts > lo) & (firsts <= hi)] - (lo - before)
            h, g = self.responses(bytes_[(lo - before) * BLOCK:(hi + after) * BLOCK], inside)
            h = h.reshape(-1, BLOCK // STEP, BYTE_FILTERS).max(1)
            g = g.reshape(-1, BLOCK // 8, LAG_FILTERS).max(1)
            blocks[lo:hi, :BYTE_FILTERS] = h[before:before + hi - lo]
            blocks[lo:hi, BYTE_FILTERS:] = g[before:before + hi - lo]
        sizes = np.diff(firsts)
        counts = np.maximum(1, -(-(sizes - CHUNK_BLOCKS) // CHUNK_STEP) + 1)
        row = np.repeat(np.arange(len(sizes)), counts)
        number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = firsts[row] + number * CHUNK_STEP
        end = np.minimum(begin + CHUNK_BLOCKS, firsts[row + 1])
        chunks = np.maximum.reduceat(blocks, np.stack([begin, end], 1).ravel())[::2]
        at = np.cumsum(counts) - counts
        features = np.concatenate([np.maximum.reduceat(chunks, at), np.add.reduceat(chunks, at) / counts[:, None]], 1)
        return 1 / (1 + np.exp(-(features @ self.p["u"] + self.p["b"][0]).astype(np.float64)))

    def _gradients(self, text: bytes, label: int) -> dict[str, np.ndarray]:
        """Gradients of the log loss of one text; through a maximum they reach its position only."""
        p = self.p
        data, firsts = padded(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        h, g = self.responses(data, firsts[1:])
        chunks = max(1, -(-(int(firsts[-1]) - CHUNK_BLOCKS) // CHUNK_STEP) + 1)
        best, where = np.empty((chunks, FILTERS), np.float32), np.empty((chunks, FILTERS), np.int64)
        for c in range(chunks):
            for values, per, part in ((h, BLOCK // STEP, slice(0, BYTE_FILTERS)), (g, BLOCK // 8, slice(BYTE_FILTERS, FILTERS))):
                lo = c * CHUNK_STEP * per
                cut = values[lo:lo + CHUNK_BLOCKS * per]
                where[c, part] = lo + cut.argmax(0)
                best[c, part] = cut.max(0)
        top = best.argmax(0)
        features = np.concatenate([best[top, np.arange(FILTERS)], best.mean(0)])
        error = 1 / (1 + np.exp(-(features @ p["u"] + p["b"][0]))) - label
        coefficient = np.tile(error * p["u"][FILTERS:] / chunks, (chunks, 1))
        coefficient[top, np.arange(FILTERS)] += error * p["u"][:FILTERS]
        coefficient = (coefficient * (best > 0)).astype(np.float32)
        out = {k: np.zeros_like(v) for k, v in p.items()}
        out["u"], out["b"] = (error * features).astype(np.float32), np.array([error], np.float32)
        grown = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
        shares = lag_shares(data)
        for k in range(FILTERS):
            some = np.flatnonzero(coefficient[:, k])
            if not len(some):
                continue
            c, at = coefficient[some, k], where[some, k]
            if k < BYTE_FILTERS:
                seen = grown[at[:, None] * STEP + np.arange(WIDTH)]
                out["w"][:, k] = c @ p["emb"][seen].reshape(len(some), -1)
                out["wb"][k] = c.sum()
                np.add.at(out["emb"], seen, c[:, None, None] * p["w"][:, k].reshape(1, WIDTH, EMBEDDING))
            else:
                out["v"][:, k - BYTE_FILTERS] = c @ shares[at]
                out["vb"][k - BYTE_FILTERS] = c.sum()
        return out

    def fit(self, texts: list[bytes], labels: list[int], batch: int = 16, rate: float = 0.01, seed: int = 4) -> Network:
        draw = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        for n in range(max(4, -(-FIT_TEXTS // max(1, len(texts)))) if texts else 0):
            order = draw.permutation(len(texts))
            for lo in range(0, len(order), batch):
                step += 1
                some = order[lo:lo + batch]
                found = [self._gradients(texts[i], labels[i]) for i in some]
                for k in self.p:
                    grad = sum(f[k] for f in found) / len(found) + 1e-4 * self.p[k]
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad * grad
                    self.p[k] -= (rate / (1 + n * len(texts) / 3000) * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> Network:
    """The network; with fewer than two classes in the sample it says 1 or 0 for everything, and 1 without any label."""
    rows = labelled_sample(docs, labels, label, id_col, text_col, fit_rows).collect()
    rows = sorted(((r["text"] or "").encode(), int(r["label"])) for r in rows)
    network, classes = Network(), {y for _, y in rows}
    if len(classes) < 2:
        network.p["u"][:] = 0
        network.p["b"][:] = -9.0 if classes == {0} else 9.0
        return network
    return network.fit([t for t, _ in rows], [y for _, y in rows])


def with_scores(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """(row, score) for every row of ``docs``; ``row`` is the whole row as a struct."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    frame = docs.select(F.struct("*").alias("row"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(0).field(text_col), 1 << 20):
                own = batch.column(0).slice(piece.lo, piece.hi - piece.lo)
                yield pa.RecordBatch.from_arrays([own, pa.array(shared.value.scores(piece.data, piece.offsets))], names=["row", "score"])

    return frame.mapInArrow(score, T.StructType([frame.schema["row"], T.StructField("score", T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    NULL and empty texts are all padding and get the score that the network gives to that. Repeated rows score alike.
    Without labelled rows of both classes all rows score alike. Only the text is looked at.
    """
    network = fitted(docs, labels, "quality", id_col, text_col, fit_rows)
    scored = with_scores(docs.select(id_col, text_col), network, text_col).select(F.col("row").getField(id_col).alias(id_col), "score")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = 0.3, **fit) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, as they are."""
    network = fitted(docs, labels, text_col=text_col, **fit)
    kept = with_scores(docs, network, text_col).where(F.col("score") >= threshold)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
