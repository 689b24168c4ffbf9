"""Shuffling, sampling, splitting and numbering of rows; all seeded by key, independent of partitioning."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import class_of, half_even, q, safe_name
from .ranking import number_rows, ordered, take_first
from .rules import split_by_missing


def shuffle(df: DataFrame, key=None, seed: int = 42, position: str | None = None) -> DataFrame:
    """Rows in seeded random order; ``position`` adds the 1-based place in that order."""
    if position:
        return number_rows(df, (), key, seed, out=position).orderBy(position)
    o = ordered(df, (), key, seed)
    return o.plain(o.df.orderBy(*[q(c) for c in o.order]))


def interleave(df: DataFrame, by: str, key=None, seed: int | None = None, out: str = "rank") -> DataFrame:
    """Round robin over the values of ``by``: the first row of each, then the second of each, and so on."""
    return number_rows(df, by, key, seed, out=out).orderBy(out, q(by))


def shuffle_by_label(df: DataFrame, label_col: str = "label", key=None, seed: int = 42, out: str = "rank") -> DataFrame:
    """Shuffles within each label and interleaves the labels; rows without a label are dropped."""
    return interleave(df.where(q(label_col).isNotNull()), label_col, key, seed, out)


def stratified_split(df: DataFrame, ratio: float = 0.6, label_col: str = "label", key=None, seed: int | None = None,
                     by: str | None = None, out: str = "split") -> DataFrame:
    """Adds ``train`` or ``test``: the first half-even(n * ratio) rows of each label train, the others test.

    First means in key order, or in seeded order if a seed is given. Rows without a label go to test and train in
    turns. ``by`` splits within each of its values (files).
    """
    strata = [label_col, *([by] if by else [])]
    labelled = take_first(df.where(q(label_col).isNotNull()), strata, half_even(q("_total") * ratio), key, seed, out="_train")
    labelled = labelled.withColumn(out, F.when(q("_train"), "train").otherwise("test")).drop("_train")
    rest = number_rows(df.where(q(label_col).isNull()), strata[1:], key, seed, out="_rn")
    rest = rest.withColumn(out, F.when(q("_rn") % 2 == 1, "test").otherwise("train")).drop("_rn")
    return labelled.unionByName(rest)


def split_counts(split: DataFrame, label_col: str = "label", split_col: str = "split") -> DataFrame:
    """Rows per label: all, train and test."""
    return split.groupBy(q(label_col).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(q(split_col) == "train").alias("train"), F.count_if(q(split_col) == "test").alias("test"))


def sample_exact(df: DataFrame, fraction: float, by=(), key=None, seed: int = 42, where: Column | None = None) -> DataFrame:
    """Exactly half-even(n * fraction) random rows per value of ``by``; rows outside ``where`` are kept whole."""
    pool = df if where is None else df.where(F.coalesce(where, F.lit(False)))
    taken = take_first(pool, by, half_even(q("_total") * fraction), key, seed, out="_taken")
    taken = taken.where(q("_taken")).drop("_taken")
    return taken if where is None else taken.unionByName(df.where(~F.coalesce(where, F.lit(False))))


def downscale(df: DataFrame, fraction: float = 0.1, label_col: str = "label", by: str | None = None, key=None, seed: int = 42,
              benign: str = "benign") -> DataFrame:
    """Keeps a fraction of the benign rows (per file ``by``) and every other row."""
    return sample_exact(df, fraction, [by] if by else [], key, seed, where=class_of(q(label_col), benign) == "benign")


def part_number(df: DataFrame, limit: int | Column, by=(), key=None, seed: int | None = None, out: str = "part") -> DataFrame:
    """Numbers the rows of each group into parts of at most ``limit`` rows; ``limit`` may depend on the group."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    numbered = number_rows(df, by, key, seed, out="_rn")
    return numbered.withColumn(out, (F.floor((q("_rn") - 1) / limit) + 1).cast("bigint")).drop("_rn")


def bounded_parts(df: DataFrame, label_col: str = "label", benign_rows: int = 1_000_000, attack_rows: int = 1_000_000,
                  separate: str = "both", shuffle_seed: int | None = None, key=None, benign: str = "benign") -> DataFrame:
    """Adds ``class``, ``status``, ``label_name`` and ``part`` for writing part files of bounded size.

    ``separate`` (``both``, ``benign``, ``attack``, ``none``) says for which class complete and incomplete rows get
    separate files; elsewhere ``status`` is ``All``, and parts are numbered over both kinds. A limit of 0 drops a class.
    """
    labelled = split_by_missing(df, label_col).withColumn("class", class_of(q(label_col), benign))
    if separate not in ("both", "benign", "attack", "none"):
        raise ValueError(separate)
    if separate != "both":
        labelled = labelled.withColumn("status", F.when(q("class") == separate, q("status")).otherwise("All"))
    limit = F.when(q("class") == "benign", benign_rows).otherwise(attack_rows)
    labelled = labelled.where(limit > 0).withColumn("label_name", safe_name(q(label_col)))
    order = {"key": key, "seed": shuffle_seed}
    return part_number(labelled, limit, ["status", "class", "label_name"], **order)
