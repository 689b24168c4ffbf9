"""Random forests grown level by level from histograms, as models of Spark ML.

The algorithm is that of Spark ML's ``RandomForestClassifier``: per tree a bootstrap of the rows by Poisson draws, per node a
random choice of features (the square root of their number), at most ``BINS`` bins a feature with thresholds halfway between
values, Gini impurity, and leaves of one parent with the same prediction merged. Spark ML keeps for every row a count and a
node per tree, 800 bytes for 100 trees. Here a row keeps its bins only. Rows that agree in all bins and in the label are one
row with a count, and its draw has the count as its mean; draws are made again in every pass from the number of the row's
block, and nodes are found by walking the trees. Nothing that a row keeps depends on the number of trees.

Blocks follow from the distinct rows, and sums of draws are whole numbers, so the model is the same for any partitioning. The
driver holds one pass of histograms (``HISTOGRAM_BYTES`` at most; deep levels and many labels take several passes) and the
trees. These are written in the format in which Spark ML 4.1 stores a model, and loaded.
"""
from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import ceil, exp, factorial, sqrt

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import q
from ..session import local_table, scratch_path, written

BINS = 32
SAMPLE = 1 << 16
FREQUENT = 256
BLOCK_ROWS = 1 << 16
LEAST_BLOCK_ROWS = 1 << 12
PARTITION_ROWS = 1 << 20
BLOCKS = 64
HISTOGRAM_BYTES = 8 << 20
DIRECT = 16
POISSON_ONE = np.cumsum([exp(-1) / factorial(i) for i in range(18)])
SPLIT = "struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
NODE = ("struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, "
        f"rightChild: int, split: {SPLIT}>")


@dataclass
class Tree:
    """A tree while it grows: nodes in the order they are made, the root first; leaves have feature -1. Bins up to ``split``
    go to ``below``; ``stats`` are the sums of draws by label."""
    feature: list[int]
    split: list[int]
    below: list[int]
    above: list[int]
    gain: list[float]
    stats: list[np.ndarray | None]
    open: list[int]


# ------------------------------------------------ bins

def cut_points(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Thresholds halfway between ascending distinct values: between all of them, or so that bins have about equal counts."""
    if len(values) <= BINS:
        at = np.arange(1, len(values))
    else:
        upto, stride, at = np.cumsum(counts).tolist(), counts.sum() / BINS, []
        for i in range(1, len(upto)):
            target = stride * (len(at) + 1)
            if abs(upto[i - 1] - target) < abs(upto[i] - target):
                at.append(i)
        at = np.array(at[:BINS - 1], int)
    middle = (values[at - 1] + values[at]) / 2
    return np.unique(middle[~np.isnan(middle)])


def _cuts(df: DataFrame, names: list[str], n: int, frequent: list[int]) -> list[np.ndarray]:
    """Cut points per feature, from the rows with the smallest hashes: all, or about ``SAMPLE`` distinct ones. A row that
    makes up a part in ``FREQUENT`` of the table or more is always among them, with its part."""
    digest, share = F.xxhash64(*[q(c) for c in names]), min(1.0, SAMPLE / max(n, 1))
    chosen = F.lit(True) if n <= SAMPLE else F.pmod(digest, F.lit(1 << 40)) < int(share * (1 << 40))
    rows = df.withColumn("_chosen", chosen).where(q("_chosen") | digest.isin(frequent)) if frequent else df.withColumn("_chosen", chosen).where("_chosen")
    rows = rows.groupBy(*[q(c) for c in names]).agg(F.count(F.lit(1)).alias("_n"), F.first("_chosen").alias("_chosen")).toArrow()
    counts, chosen = rows.column("_n").to_numpy(), rows.column("_chosen").to_numpy(zero_copy_only=False)
    often = (counts >= n / FREQUENT) if n > SAMPLE else np.zeros(len(counts), bool)
    weights, out = np.where(often, counts * share, counts * chosen), []
    for c in names:
        found, index = np.unique(rows.column(c).to_numpy()[weights > 0], return_inverse=True)
        out.append(cut_points(found, np.bincount(index, weights=weights[weights > 0], minlength=len(found))))
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of bytes as one value."""
    n, width = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.py_buffer(rows.tobytes())])


def _binned(cuts: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bins of each row as bytes, with its label."""
    for batch in batches:
        bins = np.stack([np.searchsorted(c, batch.column(f).to_numpy(zero_copy_only=False), "left").astype(np.uint8) for f, c in enumerate(cuts)], axis=1)
        yield pa.RecordBatch.from_arrays([_binary(bins), batch.column(len(cuts)).cast(pa.int32())], names=["bins", "label"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition in blocks of ``BLOCK_ROWS``, numbered."""
    number, held, rows = 0, [], 0

    def packed(table: pa.Table) -> pa.RecordBatch:
        columns = [b"".join(table.column("bins").to_pylist()), table.column("label").to_numpy().astype(np.int32).tobytes(), table.column("n").to_numpy().astype(np.int64).tobytes()]
        return pa.RecordBatch.from_arrays([table.column("part").combine_chunks().slice(0, 1), pa.array([number], pa.int32()), *[pa.array([c], pa.binary()) for c in columns]],
                                          names=["part", "block", "bins", "labels", "counts"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        while rows >= BLOCK_ROWS:
            table = pa.Table.from_batches(held)
            yield packed(table.slice(0, BLOCK_ROWS))
            number, rows = number + 1, rows - BLOCK_ROWS
            held = table.slice(BLOCK_ROWS).to_batches()
    if rows:
        yield packed(pa.Table.from_batches(held))


def _unpacked(width: int, row) -> tuple:
    return (row["part"], row["block"]), np.frombuffer(row["bins"], np.uint8), np.frombuffer(row["labels"], np.int32), np.frombuffer(row["counts"], np.int64)


# ------------------------------------------------ growing

def draws(seed: int, block: tuple[int, int], tree: int, counts: np.ndarray) -> np.ndarray:
    """How often each row of a block is in the bootstrap of a tree: Poisson draws with the counts as means."""
    random = np.random.default_rng([seed, *block, tree])
    many = counts > 1
    out = np.searchsorted(POISSON_ONE, random.random(len(counts)), "right")
    if many.any():
        out[many] = random.poisson(counts[many])
    return out


def _histogram(trees: dict[int, Tree], wanted: list[tuple[int, int, int]], chosen: list[np.ndarray], width: int, n_labels: int, seed: int, blocks: Iterator[tuple]
               ) -> Iterator[list[np.ndarray]]:
    """Per wanted (tree, first open node, behind the last): sums of draws by (open node, chosen feature, bin, label)."""
    out = [np.zeros((*features.shape, BINS, n_labels)) for features in chosen]
    walked = {t: tuple(np.array(v) for v in (tree.feature, tree.split, tree.below, tree.above)) for t, tree in trees.items()}
    places = []
    for t, lo, hi in wanted:
        place = np.full(len(trees[t].feature), -1)
        place[trees[t].open[lo:hi]] = np.arange(hi - lo)
        places.append(place)
    for block, bins, labels, counts in blocks:
        of, found = None, None
        for (t, _, _), place, features, sums in zip(wanted, places, chosen, out):
            if t != of:
                of, found = t, _reached(walked[t], bins, width, draws(seed, block, t, counts))
            rows, nodes, weights = found
            slots = place[nodes]
            if (slots < 0).any():
                here = slots >= 0
                rows, slots, weights = rows[here], slots[here], weights[here]
            if not len(rows):
                continue
            target, m = labels[rows], features.shape[1]
            for j in range(m):
                index = ((slots * m + j) * BINS + bins[rows * width + features[slots, j]]) * n_labels + target
                sums += np.bincount(index, weights=weights, minlength=sums.size).reshape(sums.shape)
    yield out


def _reached(tree: tuple, bins: np.ndarray, width: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that are drawn and reach the last level, with their nodes there."""
    feature, split, below, above = tree
    rows = np.flatnonzero(weights)
    nodes, weights = np.zeros(len(rows), np.int64), weights[rows].astype(float)
    inner = feature >= 0
    moving = inner[nodes]
    while moving.any():
        if not moving.all():
            rows, nodes, weights = rows[moving], nodes[moving], weights[moving]
        nodes = np.where(bins[rows * width + feature[nodes]] <= split[nodes], below[nodes], above[nodes])
        moving = inner[nodes]
    return rows, nodes, weights


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b)]


def gini(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(axis=-1, keepdims=True)
    return np.where(total[..., 0] > 0, 1 - ((stats / np.maximum(total, 1)) ** 2).sum(axis=-1), 0.0)


def best_splits(sums: np.ndarray, features: np.ndarray, sizes: np.ndarray) -> list[tuple[float, int, int, np.ndarray]]:
    """Per node of a histogram (node, chosen feature, bin, label): (gain, feature, bin, sums of the bins up to it); the gain is 0
    where no split gains. Ties go to the smaller feature, then to the smaller bin."""
    total = sums[:, 0].sum(axis=1)
    left = sums.cumsum(axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    n, n_left, n_right = total.sum(axis=1)[:, None, None], left.sum(axis=3), right.sum(axis=3)
    gains = gini(total)[:, None, None] - (n_left * gini(left) + n_right * gini(right)) / np.maximum(n, 1)
    gains[(n_left < 1) | (n_right < 1) | (np.arange(BINS - 1) >= sizes[features][:, :, None])] = 0
    at = gains.reshape(len(sums), -1).argmax(axis=1)
    j, b = np.unravel_index(at, gains.shape[1:])
    return [(float(gains[i, j[i], b[i]]), int(features[i, j[i]]), int(b[i]), left[i, j[i], b[i]]) for i in range(len(sums))]


def _passes(growing: dict[int, Tree], each: int) -> Iterator[list[tuple[int, int, int]]]:
    """The open nodes in passes of (tree, first open node, behind the last), whose histograms of ``each`` bytes a node fit."""
    room, wanted, held = max(1, HISTOGRAM_BYTES // each), [], 0
    for t, tree in growing.items():
        for lo in range(0, len(tree.open), room):
            hi = min(len(tree.open), lo + room)
            if held + hi - lo > room:
                yield wanted
                wanted, held = [], 0
            wanted.append((t, lo, hi))
            held += hi - lo
    if wanted:
        yield wanted


def _grow(state, sizes: np.ndarray, n_labels: int, n_trees: int, depth: int, seed: int) -> list[Tree]:
    width = len(sizes)
    m = width if n_trees == 1 else ceil(sqrt(width))
    trees = [Tree([-1], [0], [-1], [-1], [0.0], [None], [0]) for _ in range(n_trees)]
    for level in range(max(depth, 1)):
        growing, opened = {t: tree for t, tree in enumerate(trees) if tree.open}, {}
        best: dict[int, list[tuple]] = {t: [] for t in growing}
        for wanted in _passes(growing, m * BINS * n_labels * 8):
            chosen = [np.stack([np.sort(np.random.default_rng([seed, t, node, width]).permutation(width)[:m]) for node in trees[t].open[lo:hi]]) for t, lo, hi in wanted]
            sums = state.mapPartitions(partial(_histogram, {t: trees[t] for t, _, _ in wanted}, wanted, chosen, width, n_labels, seed))
            if state.getNumPartitions() > DIRECT:
                sums = sums.treeReduce(_added)
            else:
                sums = [sum(parts) for parts in zip(*sums.collect())]
            for (t, _, _), features, found in zip(wanted, chosen, sums):
                best[t] += best_splits(found, features, sizes)
                if trees[t].stats[0] is None:
                    trees[t].stats[0] = found[0, 0].sum(axis=0)
        # All open nodes of a tree are on one level while rows are counted, so nodes are split only now.
        for t, tree in growing.items():
            for node, (gain, f, b, left) in zip(tree.open, best[t]):
                if gain <= 0 or not depth:
                    continue
                tree.feature[node], tree.split[node], tree.gain[node] = f, b, gain
                tree.below[node], tree.above[node] = len(tree.feature), len(tree.feature) + 1
                for stats in (left, tree.stats[node] - left):
                    if level + 1 < depth and np.count_nonzero(stats) > 1:
                        opened.setdefault(t, []).append(len(tree.feature))
                    for values, empty in ((tree.feature, -1), (tree.split, 0), (tree.below, -1), (tree.above, -1), (tree.gain, 0.0), (tree.stats, stats)):
                        values.append(empty)
            tree.open = opened.get(t, [])
    return trees


def train(df: DataFrame, names: list[str], target: str, n_labels: int, trees: int = 100, depth: int = 10, seed: int = 42) -> tuple[list[Tree], list[np.ndarray]]:
    """The trees for a table of numbers without missing ones, and the cut points of its features. It is read three times."""
    spark, seed = df.sparkSession, seed % (1 << 64)
    df = df.select(*[q(c) for c in names], q(target))
    sketch = F.expr(f"approx_top_k(_digest, {2 * FREQUENT}, {32 * FREQUENT})")  # errs by a part in 3,000 of the rows at most
    n, frequent = df.select(F.xxhash64(*[q(c) for c in names]).alias("_digest")).agg(F.count(F.lit(1)), sketch).first()
    if not n or n_labels < 2:
        raise ValueError("a forest needs rows of two labels or more")
    often = [r["item"] for r in frequent if r["count"] >= n / (2 * FREQUENT)]
    cuts = _cuts(df, names, n, often if n > SAMPLE else [])
    counted = df.mapInArrow(partial(_binned, cuts), "bins binary, label int").groupBy("bins", "label").agg(F.count(F.lit(1)).alias("n"))
    counted = written(counted, "counted")
    n_distinct = counted.count()
    parts = max(1, min(BLOCKS, -(-n_distinct // LEAST_BLOCK_ROWS)), -(-n_distinct // PARTITION_ROWS))
    dealt = counted.repartition(parts, "bins", "label").sortWithinPartitions("bins", "label").withColumn("part", F.spark_partition_id())
    blocks = written(dealt.mapInArrow(_blocks, "part int, block int, bins binary, labels binary, counts binary"), "blocks")
    tasks = min(max(parts, n_distinct // BLOCK_ROWS), 2 * spark.sparkContext.defaultParallelism)
    state = blocks.repartition(tasks).rdd.map(partial(_unpacked, len(names))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _grow(state, np.array([len(c) for c in cuts]), n_labels, trees, depth, seed), cuts
    finally:
        state.unpersist()


# ------------------------------------------------ as Spark ML's model

def _nodes(tree: Tree, cuts: list[np.ndarray]) -> list[dict]:
    """The nodes as Spark ML numbers and stores them; leaves of one parent with the same prediction are one leaf."""
    guess = [int(np.argmax(s)) for s in tree.stats]
    leaf = [f < 0 for f in tree.feature]
    for at in reversed(range(len(leaf))):  # children come after their parents
        if not leaf[at]:
            a, b = tree.below[at], tree.above[at]
            leaf[at] = leaf[a] and leaf[b] and guess[a] == guess[b]
    impurity, out = gini(np.array(tree.stats)), []

    def add(at: int) -> int:
        stats = tree.stats[at]
        node = {"id": len(out), "prediction": float(guess[at]), "impurity": float(impurity[at]), "impurityStats": stats.tolist(), "rawCount": int(stats.sum()),
                "gain": -1.0, "leftChild": -1, "rightChild": -1, "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        out.append(node)
        if not leaf[at]:
            f = tree.feature[at]
            node.update(gain=tree.gain[at], leftChild=add(tree.below[at]), rightChild=add(tree.above[at]),
                        split={"featureIndex": f, "leftCategoriesOrThreshold": [float(cuts[f][tree.split[at]])], "numCategories": -1})
        return node["id"]

    add(0)
    return out


def as_model(spark: SparkSession, trees: list[Tree], cuts: list[np.ndarray], n_labels: int, depth: int, seed: int, columns: dict[str, str]) -> RandomForestClassificationModel:
    """The trees as Spark ML's model; ``columns`` names its columns (``featuresCol`` and so on)."""
    path = scratch_path(spark, "forest")

    def about(kind: str, uid: str, own: dict, **more) -> str:
        default = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction", "probabilityCol": "probability", "rawPredictionCol": "rawPrediction", "leafCol": "",
                   "impurity": "gini", "maxBins": BINS, "maxDepth": 5, "minInfoGain": 0.0, "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0, "maxMemoryInMB": 256,
                   "cacheNodeIds": False, "checkpointInterval": 10}
        return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": f"{uid}_{uuid.uuid4().hex[:12]}",
                           "paramMap": {**columns, "maxDepth": depth, "seed": seed, **own}, "defaultParamMap": default | more.pop("default", {}), **more})

    whole = about("RandomForestClassificationModel", "RandomForestClassifier", {"numTrees": len(trees)}, numFeatures=len(cuts), numClasses=n_labels, numTrees=len(trees),
                  default={"numTrees": 20, "bootstrap": True, "featureSubsetStrategy": "auto", "subsamplingRate": 1.0})
    local_table(spark, [(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [(t, about("DecisionTreeClassificationModel", "dtc", {}), 1.0) for t in range(len(trees))]
    local_table(spark, each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(t, node) for t, tree in enumerate(trees) for node in _nodes(tree, cuts)]
    local_table(spark, nodes, f"treeID int, nodeData {NODE}").coalesce(1).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
