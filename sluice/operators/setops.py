"""Appending, deduplicating and comparing tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import DIGEST, digest_columns, q
from ..session import small_table, written
from .ranking import repeat_rows


def dedupe_rows(df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Drops repeated rows; with ``keys`` keeps the first row of each key in the given order.

    Both forms drop copies before the shuffle (partial aggregation, or a row limit per key within each task).
    """
    if not keys:
        return df.dropDuplicates()
    rank = F.row_number().over(W.partitionBy(*[q(k) for k in keys]).orderBy(*[q(c) for c in order or df.columns]))
    return df.withColumn("_rank", rank).where(q("_rank") == 1).drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    """The number of distinct rows, by their 128-bit digests."""
    return df.select(*digest_columns(df)).dropDuplicates().agg(F.count(F.lit(1)).alias("n_distinct"))


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[q(c).cast("string").alias(c) for c in df.columns])


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each digest of a row with ``_a`` and ``_b``, how often the row occurs in either table, compared as text and by column
    position; copies are counted before the shuffle."""
    left, right = (t.select(*digest_columns(t)) for t in (as_text(a), as_text(b)))
    both = (left.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0))
            .union(right.withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))))
    return both.groupBy(*DIGEST).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))


def missing_rows(a: DataFrame, b: DataFrame, multiset: bool = False) -> DataFrame:
    """Rows of ``a`` that are not in ``b``, compared as text and by column position; NULLs are equal.

    Distinct rows, or with ``multiset`` as many copies as ``a`` has more than ``b``. Digests are compared first; whole rows
    move only where their digests differ, or where these are too many to be broadcast.
    """
    if len(a.columns) != len(b.columns):
        raise ValueError(f"{len(a.columns)} columns cannot be compared with {len(b.columns)}")
    more = _sides(a, b).where(q("_a") > q("_b") if multiset else (q("_a") > 0) & (q("_b") == 0))
    wanted, _ = small_table(written(more.select(*DIGEST, (q("_a") - q("_b")).alias("_n")), "digests"))
    text = as_text(a)
    found = text.select("*", *digest_columns(text)).join(wanted, list(DIGEST)).dropDuplicates(list(DIGEST))
    rows = found.select(*[q(c) for c in text.columns], "_n")
    return repeat_rows(rows, "_n", "_copy").drop("_copy") if multiset else rows.drop("_n")


def extra_rows(a: DataFrame, b: DataFrame, multiset: bool = False) -> DataFrame:
    """Rows of ``b`` that are not in ``a``."""
    return missing_rows(b, a, multiset).toDF(*b.columns)


def compare_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: distinct rows of both tables, rows missing in and extra in ``b``, and whether the two sets are equal."""
    in_a, in_b = q("_a") > 0, q("_b") > 0
    return (_sides(a, b).agg(F.count_if(in_a).alias("n_a"), F.count_if(in_b).alias("n_b"),
                             F.count_if(in_a & ~in_b).alias("n_missing"), F.count_if(in_b & ~in_a).alias("n_extra"))
            .withColumn("same", (q("n_missing") == 0) & (q("n_extra") == 0)))


def union_positional(tables: list[DataFrame]) -> DataFrame:
    """Appends by position; the first table gives the names. Headers that differ are refused."""
    for t in tables[1:]:
        if t.columns != tables[0].columns:
            raise ValueError(f"header {t.columns} differs from {tables[0].columns}; use union_by_name")
    return reduce(DataFrame.union, tables)


def union_by_name(tables: list[DataFrame]) -> DataFrame:
    """Appends by name; columns that a table lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
