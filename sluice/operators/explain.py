"""Why a model predicted a class: the features that pushed the first row of each class up or down most."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from ..functions import direction, dtypes, explain_text, q, quoted
from ..session import scratch_path
from .boosting import Boosted, Tree
from .models import TrainedModel, _assembled


def forest_leaves(model: TrainedModel) -> list[list[tuple]]:
    """Per tree its leaves as ``(class shares, [(feature, low, high, missing, share)])``.

    A row follows the path to a leaf in a feature if its value is in (low, high], or if it is missing and ``missing`` holds;
    ``share`` is the part of the training rows that the splits on this feature let through. The nodes are read from the saved model; their number is bounded
    by the number and depth of the trees.
    """
    path = scratch_path(SparkSession.active(), "forest")
    model.classifier.write().overwrite().save(path)
    stored = SparkSession.active().read.parquet(f"{path}/data")
    trees: dict[int, dict[int, object]] = {}
    for row in stored.select("treeID", "nodeData").collect():
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    return [_leaves(trees[t]) for t in sorted(trees)]


def _leaves(nodes: dict) -> list[tuple]:
    out, stack = [], [(0, {})]
    while stack:
        at, limits = stack.pop()
        node = nodes[at]
        if node["leftChild"] < 0:
            stats = np.array(node["impurityStats"], dtype=float)
            out.append((stats / stats.sum(), [(f, *limit) for f, limit in sorted(limits.items())]))
            continue
        feature, threshold = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
        low, high, _, share = limits.get(feature, (-np.inf, np.inf, False, 1.0))
        for child, span in ((node["leftChild"], (low, min(high, threshold))), (node["rightChild"], (max(low, threshold), high))):
            stack.append((child, {**limits, feature: (*span, False, share * nodes[child]["rawCount"] / node["rawCount"])}))
    return out


def boosted_leaves(model: Boosted) -> list[list[tuple]]:
    """As :func:`forest_leaves`, with the value that a leaf adds to each label's score, and shares by second derivatives."""
    return [_boosted_leaves(tree, np.eye(model.n_labels)[k]) for trees in model.trees for k, tree in enumerate(trees)]


def _boosted_leaves(tree: Tree, unit: np.ndarray) -> list[tuple]:
    out, stack = [], [(0, {})]
    while stack:
        at, limits = stack.pop()
        feature = int(tree.feature[at])
        if feature < 0:
            out.append((unit * tree.value[at], [(f, *limit) for f, limit in sorted(limits.items())]))
            continue
        low, high, missing, share = limits.get(feature, (-np.inf, np.inf, True, 1.0))
        threshold, left = float(tree.threshold[at]), bool(tree.missing_left[at])
        for child, span, takes in ((tree.below[at], (low, min(high, threshold)), left), (tree.above[at], (max(low, threshold), high), not left)):
            stack.append((child, {**limits, feature: (*span, missing and takes, share * tree.cover[child] / tree.cover[at])}))
    return out


def contributions(leaves: list[list[tuple]], rows: np.ndarray, classes: np.ndarray, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Path-dependent Shapley values of the given class's value per row and feature, and the base values: the mean over the
    trees, or their sum times ``scale``.

    A leaf counts for a set of known features with the product of "the row passes" over the known and of the training
    share over the unknown ones (Lundberg et al. 2018). Its Shapley value for one feature is the weighted sum of the
    coefficients of the product of (share + passes * t) over the other features of the path.
    """
    out, base = np.zeros(rows.shape), np.zeros(len(rows))
    for tree in leaves:
        for shares, path in tree:
            value = shares[classes] * (scale or 1 / len(leaves))
            if not value.any():
                continue
            base += value * np.prod([p[4] for p in path])
            d = len(path)
            # An open lower end takes minus infinity, too.
            passes = [np.where(np.isnan(rows[:, f]), missing, ((rows[:, f] > low) | (low == -np.inf)) & (rows[:, f] <= high)) for f, low, high, missing, _ in path]
            weights = [factorial(s) * factorial(d - 1 - s) / factorial(d) for s in range(d)]
            for i, (feature, _, _, _, share) in enumerate(path):
                poly = np.zeros((len(rows), d))
                poly[:, 0] = 1
                for j in range(d):
                    if j != i:
                        shifted = np.roll(poly, 1, axis=1) * passes[j][:, None]
                        poly = poly * path[j][4] + shifted
                out[:, feature] += value * (passes[i] - share) * (poly @ weights)
    return out, base


def _first_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each class in a batch, so that the rows of a table need not be sorted to find its first ones."""
    for batch in batches:
        labels = batch.column(1).dictionary_encode().indices
        order = pc.sort_indices(pa.table({"label": labels, "key": batch.column(0)}), sort_keys=[("label", "ascending"), ("key", "ascending")], null_placement="at_start")
        labels = labels.take(order).to_numpy(zero_copy_only=False)
        yield batch.take(order.filter(pa.array(np.append(True, labels[1:] != labels[:-1])[:len(labels)])))


def explain_rows(model: TrainedModel, df: DataFrame, key: str, k: int = 3, all_rows: bool = False) -> DataFrame:
    """``(key, predicted_label, base, contributions, features, values)`` for the first row of each predicted class.

    "First" is the smallest key. Only one row per class is explained, unless ``all_rows`` asks for every row.
    """
    scored = _assembled(model, df)
    position = df.columns.index(key)
    wanted = scored.select(q(f"_carry{position}").alias(key), "predicted_label", q("_prediction").cast("int").alias("_class"),
                           vector_to_array(q("_features")).alias("_row"))
    if not all_rows:
        if isinstance(dtypes(df)[key], (T.StringType, T.IntegralType, T.DateType, T.TimestampType)):  # ordered by Arrow as by Spark
            wanted = wanted.mapInArrow(_first_of_batches, wanted.schema)
        first = F.row_number().over(W.partitionBy("predicted_label").orderBy(q(key)))
        wanted = wanted.withColumn("_r", first).where(q("_r") == 1).drop("_r")
    schema = (f"{quoted(key)} {dtypes(df)[key].simpleString()}, predicted_label string, base double, contributions array<double>, "
              "top_features array<string>, top_values array<double>")
    leaves, scale = (boosted_leaves(model.boosted), 1.0) if model.boosted else (forest_leaves(model), None)
    return wanted.mapInPandas(_explainer(leaves, scale, model.features, key, k), schema)


def _explainer(leaves: list[list[tuple]], scale: float | None, features: list[str], key: str, k: int) -> Callable:
    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                values, base = contributions(leaves, np.stack(batch["_row"].to_numpy()), batch["_class"].to_numpy(), scale)
                top = np.argsort(-np.abs(values), axis=1, kind="stable")[:, :k]
                yield pd.DataFrame({key: batch[key], "predicted_label": batch["predicted_label"], "base": base,
                                    "contributions": list(values), "top_features": [[features[j] for j in t] for t in top],
                                    "top_values": [values[i, t] for i, t in enumerate(top)]})
    return explain


def explain_predictions(model: TrainedModel, df: DataFrame, key: str, k: int = 3) -> DataFrame:
    """One sentence per predicted class: its first row's ``k`` strongest features, ``high`` or ``low`` by sign."""
    rows = explain_rows(model, df, key, k)
    signs = F.transform("top_values", direction)
    return rows.select("predicted_label", q(key), explain_text(q("predicted_label"), q("top_features"), signs).alias("explanation"))
