"""Class balancing: targets, undersampling, and oversampling by interpolation between neighbours.

What each label needs is a table that is joined to the rows, so labels may be many.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import dtypes, is_numeric, q
from ..session import local_table, small_table, written
from .neighbors import knn_lists, vector_of
from .ranking import repeat_rows, take_first

BORDER_NEIGHBORS = 10


def balance_targets(df: DataFrame, ratio: float, label_col: str = "label") -> DataFrame:
    """``(label, n, target)``: the majority keeps its count, every other label gets at least ``ratio`` of it."""
    if not 0 < ratio <= 1:
        raise ValueError("ratio must be in (0, 1]")
    counts = df.where(q(label_col).isNotNull()).groupBy(q(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).scalar()
    return counts.withColumn("target", F.greatest(q("n"), F.floor(most * F.lit(ratio)).cast("bigint")))


def undersample(df: DataFrame, targets: DataFrame, label_col: str = "label", key=None, seed: int = 42) -> DataFrame:
    """Keeps ``target`` random rows of each label; labels without a target, and rows without a label, are kept whole."""
    labelled = df.where(q(label_col).isNotNull())
    aims = labelled.select(q(label_col)).distinct().join(
        targets.select(q("label").alias(label_col), "target"), label_col, "left")
    taken = take_first(labelled, label_col, F.coalesce(q("target"), q("_total")), key, seed, out="_taken", targets=aims)
    return taken.where(q("_taken")).drop("_taken").unionByName(df.where(q(label_col).isNull()))


def _needs(targets: DataFrame) -> tuple[DataFrame, int | None]:
    """``(label, extra)`` for the labels below their target, and the size of the smallest of them."""
    needs = written(targets.where(q("target") > q("n")).select(q("label").cast("string").alias("label"), "n", (q("target") - q("n")).alias("extra")), "needs")
    return needs.drop("n"), needs.agg(F.min("n")).first()[0]


def neighbors_for(smallest: int) -> int:
    return max(1, min(smallest - 1, 5))


def _of_labels(df: DataFrame, labels: DataFrame | list[str], label_col: str, how: str = "inner") -> DataFrame:
    """The rows whose label is in a table of distinct labels, with its other columns; a small table is broadcast."""
    if not isinstance(labels, DataFrame):
        labels = local_table(df.sparkSession, [(c,) for c in labels], "label string")
    known = labels.select(q("label").alias("_named"), *[q(c) for c in labels.columns if c != "label"])
    known, _ = small_table(known)
    found = df.join(known, q(label_col).cast("string") == q("_named"), how)
    return found.drop("_named") if how == "inner" else found


def border_share(df: DataFrame, labels: DataFrame | list[str], features, label_col: str, key: str, k: int) -> DataFrame:
    """Rows of the given labels with ``_foreign``, the share of other labels among their ``k`` nearest rows."""
    labelled = df.where(q(label_col).isNotNull())
    near = knn_lists(_of_labels(labelled, labels, label_col, "left_semi"), labelled, key, features, k, label=label_col, vectors=False)
    other = F.size(F.filter("neighbors", lambda n: n["label"] != q(label_col).cast("string")))
    return near.withColumn("_foreign", other / F.size("neighbors")).drop("neighbors")


def borderline_candidates(df: DataFrame, labels: DataFrame | list[str], features, label_col: str = "label", key: str = "id",
                          m: int = BORDER_NEIGHBORS) -> DataFrame:
    """Minority rows of which at least half, but not all, of the ``m`` nearest rows carry another label. ``labels`` are
    texts, or a table with the column ``label``."""
    return border_share(df, labels, features, label_col, key, m).where((q("_foreign") >= 0.5) & (q("_foreign") < 1)).drop("_foreign")


def adasyn_weights(df: DataFrame, labels: DataFrame | list[str], features, label_col: str = "label", key: str = "id", k: int = 5) -> DataFrame:
    """Minority rows with ``weight``: their share of foreign neighbours, as a part of the label's sum."""
    shares = written(border_share(df, labels, features, label_col, key, k), "shares")
    sums, _ = small_table(written(shares.groupBy(q(label_col).alias("_label")).agg(F.sum("_foreign").alias("_sum")), "sums"))
    return (shares.join(sums, q(label_col) == q("_label"))
            .withColumn("weight", F.try_divide("_foreign", "_sum")).drop("_label", "_sum", "_foreign"))


def oversample(df: DataFrame, targets: DataFrame, features: str | list[str], label_col: str = "label", key: str = "id",
               method: str = "smote", seed: int = 42, k: int | None = None, out: str = "synthetic") -> DataFrame:
    """All rows, and for each label below its target new rows between one of its rows and a neighbour of that label.

    ``smote`` spreads the new rows evenly over the label's rows, ``borderline`` over those at the border to other labels,
    ``adasyn`` in proportion to the share of foreign neighbours (what rounding down leaves over goes to one row each, so
    that the target is met exactly). Where no row qualifies, all of the label's rows do. Which neighbour and how far towards it follows from
    the hash of (seed, key, copy number). New rows carry the features and the label; other columns are NULL.
    """
    needs, smallest = _needs(targets)
    original = df.withColumn(out, F.lit(False))
    if smallest is None:
        return original
    k = k or neighbors_for(smallest)
    seeds = _seeds(df, needs, features, label_col, key, method, seed, k)
    # Neighbours are sought for the rows that get copies only, among all rows of their label.
    members = _of_labels(df, needs.select("label"), label_col, "left_semi")
    near = knn_lists(seeds.where(q("_copies") > 0), members, key, features, k, within=label_col)
    lists = near.withColumn("_near", F.transform("neighbors", lambda n: n["vector"])).withColumn("_v", vector_of(df, features))
    made = repeat_rows(lists.select(q(label_col), q(key), "_v", "_near", "_copies"), "_copies", "_copy")
    pick = F.md5(F.concat_ws(":", F.lit(str(seed)), q(key).cast("string"), q("_copy").cast("string")))
    part = lambda start: F.conv(F.substring(pick, start, 8), 16, 10).cast("double") / float(16 ** 8)
    # A row without a neighbour is copied as it is.
    other = F.coalesce(F.get("_near", F.floor(part(1) * F.size("_near")).cast("int")), q("_v"))
    made = made.withColumn("_other", other).withColumn("_u", part(9))
    made = made.withColumn("_new", F.transform(F.arrays_zip("_v", "_other"), lambda p: p["_v"] + (p["_other"] - p["_v"]) * q("_u")))
    types = dtypes(df)
    if isinstance(features, str):
        values = {features: q("_new").cast(types[features])}
    else:
        values = {c: F.get("_new", F.lit(i)).cast(types[c] if not _whole(types[c]) else "double").cast(types[c]) for i, c in enumerate(features)}
    values[label_col] = q(label_col)
    new = made.select(*[values.get(c, F.lit(None).cast(types[c])).alias(c) for c in df.columns], F.lit(True).alias(out))
    return original.unionByName(new)


def _whole(dtype) -> bool:
    return is_numeric(dtype) and dtype.simpleString() not in ("double", "float")


def _seeds(df: DataFrame, needs: DataFrame, features, label_col: str, key: str, method: str, seed: int, k: int) -> DataFrame:
    """The rows of the needy labels with ``_copies``, the number of new rows that start from them."""
    pool = _of_labels(df, needs, label_col)
    if method == "smote":
        return _even(pool, label_col, key, seed)
    labels = needs.select("label")
    if method == "borderline":
        chosen = _of_labels(written(borderline_candidates(df, labels, features, label_col, key), "border"), needs, label_col)
        return _even(chosen.unionByName(_without(pool, chosen, label_col)), label_col, key, seed)
    if method == "adasyn":
        weighted = _of_labels(written(adasyn_weights(df, labels, features, label_col, key, k), "weights").where(q("weight") > 0), needs, label_col)
        weighted = weighted.withColumn("_each", F.floor(q("weight") * q("extra")).cast("bigint"))
        given = weighted.groupBy(q(label_col)).agg((F.max("extra") - F.sum("_each")).alias("_left"))
        share = _spread(weighted.drop("weight", "extra"), written(given, "given"), label_col, key, seed)
        return share.unionByName(_even(_without(pool, weighted, label_col), label_col, key, seed))
    raise ValueError(method)


def _without(pool: DataFrame, chosen: DataFrame, label_col: str) -> DataFrame:
    """The rows of labels that no chosen row has."""
    had = written(chosen.select(q(label_col).cast("string").alias("label")).distinct(), "had")
    return _of_labels(pool, had, label_col, "left_anti")


def _even(pool: DataFrame, label_col: str, key: str, seed: int) -> DataFrame:
    """Spreads each label's ``extra`` new rows evenly over its rows."""
    sizes = pool.groupBy(q(label_col)).agg(F.max("extra").alias("_extra"), F.count(F.lit(1)).alias("_n"))
    sizes = written(sizes.select(q(label_col), F.floor(q("_extra") / q("_n")).cast("bigint").alias("_each"), F.pmod("_extra", "_n").alias("_left")), "sizes")
    each = sizes.select(q(label_col).cast("string").alias("label"), "_each")
    return _spread(_of_labels(pool.drop("extra"), each, label_col), sizes.select(q(label_col), "_left"), label_col, key, seed)


def _spread(pool: DataFrame, left: DataFrame, label_col: str, key: str, seed: int) -> DataFrame:
    """``_copies``: the row's own part ``_each``, and one of its label's ``_left`` more for the first rows in seeded order."""
    taken = take_first(pool, label_col, q("_left"), key, seed, out="_more", targets=left)
    return taken.withColumn("_copies", q("_each") + q("_more").cast("bigint")).drop("_each", "_more")
