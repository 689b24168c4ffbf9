"""Gradient-boosted trees over all labels at once, grown level by level from histograms.

Each round grows one tree per label for the softmax loss. Rows that agree in all bins and in the label also agree in scores
and derivatives, so they are counted first and are one row with a count from then on. These stay where they are, as blocks
of bin numbers, labels, counts and scores so far; a pass over them gives, per open node, feature and bin, the sums of first and second derivatives, which are
all that the driver needs to choose the splits of a level (after Chen and Guestrin 2016). Derivatives are whole multiples
of a power of two, so that sums are exact and the model is the same for any partitioning. A missing value has a bin of its
own and goes to the side where the gain is higher.

The driver holds one pass of histograms (``HISTOGRAM_BYTES`` at most; wide tables take several passes a level) and the
trees. Scores are kept between rounds, and their lineage is cut by checkpoints in the shared folder.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import local_table, written

BINS = 256  # with the bin of missing values, the last one
SAMPLE = 1 << 16
BLOCK_ROWS = 1 << 14
HISTOGRAM_BYTES = 16 << 20
DIRECT = 16
CHECKPOINT_EVERY = 10
LEAST_GAIN = 1e-6
NODE = "feature int, threshold double, missing_left boolean, below int, above int, value double, cover double, gain double"


@dataclass
class Tree:
    """Nodes in the order they were made, the root first; leaves have feature -1. ``below`` is the child of values up to the
    threshold, ``cover`` the sum of second derivatives."""
    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    below: np.ndarray
    above: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    def leaves_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row of values; NaN is missing."""
        at = np.zeros(len(rows), np.int32)
        moving = np.flatnonzero(self.feature[at] >= 0)
        while len(moving):
            node = at[moving]
            x = rows[moving, self.feature[node]]
            left = np.where(np.isnan(x), self.missing_left[node], x <= self.threshold[node])
            at[moving] = np.where(left, self.below[node], self.above[node])
            moving = moving[self.feature[at[moving]] >= 0]
        return at


@dataclass
class Boosted:
    """Trees by round and label; the score of a label is the sum of its trees' values."""
    trees: list[list[Tree]]
    n_labels: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.n_labels))
        for trees in self.trees:
            for k, tree in enumerate(trees):
                out[:, k] += tree.value[tree.leaves_of(rows)]
        return out

    def importance(self, n_features: int) -> np.ndarray:
        """Mean gain of the splits on each feature, as a share of the sum over features."""
        gain, count = np.zeros(n_features), np.zeros(n_features)
        for tree in (t for trees in self.trees for t in trees):
            inner = tree.feature >= 0
            np.add.at(gain, tree.feature[inner], tree.gain[inner])
            np.add.at(count, tree.feature[inner], 1)
        mean = gain / np.maximum(count, 1)
        return mean / mean.sum() if mean.sum() > 0 else mean

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(r, k, i, *(v.item() for v in node)) for r, trees in enumerate(self.trees) for k, t in enumerate(trees)
                for i, node in enumerate(zip(t.feature, t.threshold, t.missing_left, t.below, t.above, t.value, t.cover, t.gain))]
        return local_table(spark, rows, f"round int, label int, node int, {NODE}")

    @staticmethod
    def of_table(df: DataFrame, n_labels: int) -> Boosted:
        table = df.orderBy("round", "label", "node").toPandas()
        trees: list[list[Tree]] = []
        for (r, _), part in table.groupby(["round", "label"], sort=True):
            while len(trees) <= r:
                trees.append([])
            trees[r].append(Tree(*[part[c.split(" ")[0]].to_numpy() for c in NODE.split(", ")]))
        return Boosted(trees, n_labels)


# ------------------------------------------------ bins

def cut_points(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Upper ends of all bins but the last for ascending distinct values: one bin per value, or of about equal counts."""
    if len(values) < bins:
        return values[:-1]
    upto = np.cumsum(counts)
    return np.unique(values[np.searchsorted(upto, upto[-1] * np.arange(1, bins - 1) / (bins - 1))])


def _cuts(df: DataFrame, n: int, width: int) -> list[np.ndarray]:
    """Cut points per feature, from the rows with the smallest hashes: all, or about ``SAMPLE`` distinct ones."""
    values = F.transform("values", lambda x: F.when(F.isnan(x), F.lit(None)).otherwise(x + F.lit(0.0)))
    plain = df.select(values.alias("values"))
    if n > SAMPLE:
        plain = plain.where(F.pmod(F.xxhash64("values"), F.lit(1 << 40)) < int(SAMPLE / n * (1 << 40)))
    rows = plain.groupBy("values").agg(F.count(F.lit(1)).alias("n")).toArrow()
    table = np.array(rows.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)
    weights, out = rows.column("n").to_numpy(), []
    for column in table.T:
        known = ~np.isnan(column)
        found, index = np.unique(column[known], return_inverse=True)
        out.append(cut_points(found, np.bincount(index, weights=weights[known], minlength=len(found))) if len(found) else found)
    return out


def binned(rows: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    out = np.empty(rows.shape, np.uint8)
    for f, c in enumerate(cuts):
        out[:, f] = np.where(np.isnan(rows[:, f]), BINS - 1, np.searchsorted(c, rows[:, f], "left"))
    return out


def _binned(cuts: list[np.ndarray], width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bins of each row as bytes, with its label; equal rows of one batch are counted."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.array(batch.column(0).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)
        packed = np.concatenate([binned(rows, cuts), batch.column(1).to_numpy().astype(np.int32).view(np.uint8).reshape(-1, 4)], axis=1)
        found, counts = np.unique(packed.view(f"V{width + 4}").ravel(), return_counts=True)
        bins = np.ascontiguousarray(found.view(np.uint8).reshape(-1, width + 4)[:, :width])
        labels = np.ascontiguousarray(found.view(np.uint8).reshape(-1, width + 4)[:, width:]).view(np.int32).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(labels), pa.array(counts.astype(np.int64))], names=["bins", "label", "n"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(lo, BLOCK_ROWS)
            columns = [b"".join(part.column(0).to_pylist()), part.column(1).to_numpy().astype(np.int32).tobytes(), part.column(2).to_numpy().astype(np.int64).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["bins", "labels", "counts"])


# ------------------------------------------------ growing

@dataclass
class Growing:
    """A tree while it grows: as :class:`Tree`, with bins for thresholds, and the nodes that are open."""
    feature: list[int]
    split: list[int]
    missing_left: list[bool]
    below: list[int]
    above: list[int]
    open: list[int]

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        feature, split, missing, below, above = map(np.array, (self.feature, self.split, self.missing_left, self.below, self.above))
        at = np.zeros(len(bins), np.int32)
        moving = np.flatnonzero(feature[at] >= 0)
        while len(moving):
            node = at[moving]
            b = bins[moving, feature[node]]
            left = np.where(b == BINS - 1, missing[node], b <= split[node])
            at[moving] = np.where(left, below[node], above[node])
            moving = moving[feature[at[moving]] >= 0]
        return at


def derivatives(scores: np.ndarray, labels: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the softmax loss by (row, label), rounded to whole multiples of 1 / scale."""
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    p = e / e.sum(axis=1, keepdims=True)
    g = p.copy()
    g[np.arange(len(labels)), labels] -= 1
    return np.rint(g * scale), np.maximum(np.rint(2 * p * (1 - p) * scale), 1)


def _exact_sums(index: np.ndarray, weights: np.ndarray, n: int, plain: bool) -> np.ndarray:
    """Sums of whole numbers by index. Doubles hold whole numbers to 2 ** 53; larger ones are summed in two parts."""
    if plain:
        return np.bincount(index, weights=weights, minlength=n).astype(np.int64)
    whole = weights.astype(np.int64)
    high, low = (np.bincount(index, weights=part, minlength=n).astype(np.int64) for part in (whole >> 26, whole & ((1 << 26) - 1)))
    return (high << 26) + low


def _histogram(growing: list[Growing], wanted: list[tuple[int, int, int]], scale: float, blocks: Iterator[tuple]) -> Iterator[list[np.ndarray]]:
    """Per wanted (label, first feature, behind the last): sums by (open node, feature, bin, derivative)."""
    out = [np.zeros((len(growing[k].open), hi - lo, BINS, 2), np.int64) for k, lo, hi in wanted]
    for bins, labels, counts, scores in blocks:
        plain = int(counts.sum()) * scale < 1 << 53
        g, h = (d * counts[:, None] if plain else d.astype(np.int64) * counts[:, None] for d in derivatives(scores, labels, scale))
        slots = {}
        for found, (k, lo, hi) in zip(out, wanted):
            if k not in slots:
                place = np.full(len(growing[k].feature), -1)
                place[growing[k].open] = np.arange(len(growing[k].open))
                slots[k] = place[growing[k].nodes_of(bins)]
            rows = np.flatnonzero(slots[k] >= 0)
            base, weights = slots[k][rows] * BINS, (g[rows, k], h[rows, k])
            for f in range(lo, hi):
                index = base + bins[rows, f]
                for d in range(2):
                    found[:, f - lo, :, d] += _exact_sums(index, weights[d], found.shape[0] * BINS, plain).reshape(-1, BINS)
    yield out


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b)]


def _pass(state, growing: list[Growing], wanted: list[tuple[int, int, int]], scale: float) -> list[np.ndarray]:
    partial_sums = state.mapPartitions(partial(_histogram, growing, wanted, scale))
    if state.getNumPartitions() > DIRECT:
        return partial_sums.treeReduce(_added)
    found = partial_sums.collect()
    return [sum(parts) for parts in zip(*found)]


def best_splits(sums: np.ndarray, cuts: list[int], scale: float, penalty: float, least_cover: float) -> list[tuple]:
    """Per node of a histogram (node, feature, bin, derivative): (gain, feature, bin, missing goes left), gain 0 without a
    split. Ties go to the smaller feature, then the smaller bin, then to the left."""
    total = sums[:, 0].sum(axis=1)
    inside, missing = sums[:, :, :-1].cumsum(axis=2), sums[:, :, -1]
    gains = np.full((2, *sums.shape[:2], BINS - 1), -np.inf)
    score = lambda s: (s[..., 0] / scale) ** 2 / (s[..., 1] / scale + penalty)
    for side, left in enumerate((inside + missing[:, :, None], inside)):
        right = total[:, None, None] - left
        ok = (left[..., 1] >= least_cover * scale) & (right[..., 1] >= least_cover * scale)
        gains[side] = np.where(ok, score(left) + score(right) - score(total)[:, None, None], -np.inf)
    for f, n in enumerate(cuts):
        gains[:, :, f, n:] = -np.inf
        # Between missing and all others: all values left, missing right.
        gains[1, :, f, n] = np.where((missing[:, f, 1] >= least_cover * scale) & (inside[:, f, -1, 1] >= least_cover * scale),
                                     score(inside[:, f, -1]) + score(missing[:, f]) - score(total), -np.inf)
    ordered = gains.transpose(1, 2, 3, 0).reshape(len(sums), -1)
    best = ordered.argmax(axis=1)
    found = []
    for node, at in enumerate(best):
        gain = ordered[node, at]
        f, b, side = np.unravel_index(at, (sums.shape[1], BINS - 1, 2))
        found.append((float(gain), int(f), int(b), side == 0) if gain > LEAST_GAIN else (0.0, -1, 0, True))
    return found


def _grow(state, cuts: list[np.ndarray], n_labels: int, depth: int, step: float, penalty: float, least_cover: float, scale: float) -> list[Tree]:
    """The trees of one round."""
    growing = [Growing([-1], [0], [True], [-1], [-1], [0]) for _ in range(n_labels)]
    totals: list[dict[int, np.ndarray]] = [{} for _ in range(n_labels)]
    gains: list[dict[int, float]] = [{} for _ in range(n_labels)]
    width, sizes = len(cuts), [len(c) for c in cuts]
    for _ in range(depth):
        asked, wanted, held = [k for k in range(n_labels) if growing[k].open], [], 0
        if not asked:
            break
        passes = [wanted]
        for k in asked:
            each = len(growing[k].open) * BINS * 16
            room = max(1, HISTOGRAM_BYTES // each)
            for lo in range(0, width, room):
                hi = min(width, lo + room)
                if wanted and held + (hi - lo) * each > HISTOGRAM_BYTES:
                    wanted, held = [], 0
                    passes.append(wanted)
                wanted.append((k, lo, hi))
                held += (hi - lo) * each
        chosen: dict[int, list[tuple]] = {}
        for wanted in passes:
            for (k, lo, hi), sums in zip(wanted, _pass(state, growing, wanted, scale)):
                for i, node in enumerate(growing[k].open):
                    totals[k][node] = sums[i, 0].sum(axis=0)
                found = [(g, f + lo if f >= 0 else -1, b, m, sums[i, f] if f >= 0 else None) for i, (g, f, b, m) in enumerate(best_splits(sums, sizes[lo:hi], scale, penalty, least_cover))]
                chosen[k] = [b if b[0] > a[0] else a for a, b in zip(chosen[k], found)] if k in chosen else found
        for k in asked:
            tree, opened = growing[k], []
            for node, (gain, f, b, missing_left, sums) in zip(tree.open, chosen[k]):
                if f < 0:
                    continue
                left = sums[:b + 1].sum(axis=0) + (sums[-1] if missing_left else 0)
                tree.feature[node], tree.split[node], tree.missing_left[node], gains[k][node] = f, b, missing_left, gain
                tree.below[node], tree.above[node] = len(tree.feature), len(tree.feature) + 1
                for part in (left, totals[k][node] - left):
                    totals[k][len(tree.feature)] = part
                    opened.append(len(tree.feature))
                    for values, empty in ((tree.feature, -1), (tree.split, 0), (tree.missing_left, True), (tree.below, -1), (tree.above, -1)):
                        values.append(empty)
            tree.open = opened
    out = []
    for k, tree in enumerate(growing):
        sums = np.array([totals[k][i] for i in range(len(tree.feature))]) / scale
        # A split behind the last cut parts missing values from all others.
        threshold = [float(cuts[f][b]) if f >= 0 and b < sizes[f] else np.inf if f >= 0 else 0.0 for f, b in zip(tree.feature, tree.split)]
        out.append(Tree(np.array(tree.feature, np.int32), np.array(threshold), np.array(tree.missing_left), np.array(tree.below, np.int32), np.array(tree.above, np.int32),
                        -sums[:, 0] / (sums[:, 1] + penalty) * step, sums[:, 1], np.array([gains[k].get(i, 0.0) for i in range(len(tree.feature))])))
    return out


def _bin_trees(trees: list[Tree], cuts: list[np.ndarray]) -> list[tuple[Growing, np.ndarray]]:
    """Trees over bin numbers, with their values."""
    split = lambda f, t: int(np.searchsorted(cuts[f], t, "left")) if f >= 0 else 0
    return [(Growing(t.feature.tolist(), [split(f, x) for f, x in zip(t.feature, t.threshold)], t.missing_left.tolist(), t.below.tolist(), t.above.tolist(), []), t.value) for t in trees]


def _unpacked(width: int, n_labels: int, row) -> tuple:
    labels = np.frombuffer(row["labels"], np.int32)
    return np.frombuffer(row["bins"], np.uint8).reshape(-1, width), labels, np.frombuffer(row["counts"], np.int64), np.zeros((len(labels), n_labels))


def _moved(trees: list[tuple[Growing, np.ndarray]], block: tuple) -> tuple:
    bins, labels, counts, scores = block
    return bins, labels, counts, scores + np.stack([values[tree.nodes_of(bins)] for tree, values in trees], axis=1)


def train(df: DataFrame, n_labels: int, width: int, rounds: int = 100, depth: int = 6, step: float = 0.3, penalty: float = 1.0, least_cover: float = 1.0) -> Boosted:
    """Boosted trees for a table (values array<double>, target int); a NULL or NaN value is missing, infinities are values."""
    spark = df.sparkSession
    table = written(df.select("values", "target"), "training")
    n = table.count()
    cuts = _cuts(table, n, width)
    counted = table.mapInArrow(partial(_binned, cuts, width), "bins binary, label int, n bigint").groupBy("bins", "label").agg(F.sum("n").alias("n"))
    counted = written(counted, "counted")
    n_distinct = counted.count()
    parts = max(1, n_distinct >> 20, min(-(-n_distinct // (2 * BLOCK_ROWS)), 4 * spark.sparkContext.defaultParallelism))
    blocks = written(counted.repartition(parts).mapInArrow(_blocks, "bins binary, labels binary, counts binary"), "blocks")
    state = blocks.rdd.map(partial(_unpacked, width, n_labels)).persist(StorageLevel.MEMORY_AND_DISK)
    scale = float(1 << min(30, 62 - n.bit_length()))
    trees: list[list[Tree]] = []
    older = None
    for r in range(rounds if n else 0):
        made = _grow(state, cuts, n_labels, depth, step, penalty, least_cover, scale)
        if older is not None:
            older.unpersist()
        trees.append(made)
        if all(len(t.feature) == 1 and abs(t.value[0]) < 1e-12 for t in made):
            break
        older, state = state, state.map(partial(_moved, _bin_trees(made, cuts))).persist(StorageLevel.MEMORY_AND_DISK)
        if (r + 1) % CHECKPOINT_EVERY == 0:
            state.checkpoint()
    for held in (older, state):
        if held is not None:
            held.unpersist()
    return Boosted(trees, n_labels)
