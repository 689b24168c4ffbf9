"""Running sums over a whole table in a given order, without bringing the table to one task."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import local_table, written


def running(df: DataFrame, order: list[Column], value: str, out: str = "running") -> DataFrame:
    """Adds ``out``: the sum of the integer column ``value`` over all rows up to and including this one.

    The table is sorted by range over all tasks and written; sums per range, one row each, give the offset of each
    range. ``order`` must tell rows apart, or rows that tie must be interchangeable. NULL counts as 0. Only ranges of
    completely equal keys cannot be cut, so a hot first key is spread by the others.
    """
    names = [f"_o{i}" for i in range(len(order))]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(order, names)])
    ranged = written(keyed.repartitionByRange(*[F.col(n).asc_nulls_last() for n in names]).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = sorted(tuple(r) for r in ranged.groupBy("_range").agg(F.sum(F.coalesce(value, F.lit(0))).cast("long")).collect())
    offsets, total = [], 0
    for part, amount in sums:
        offsets.append((part, total))
        total += amount
    starts = F.broadcast(local_table(df.sparkSession, offsets, "_range int, _offset long"))
    upto = W.partitionBy("_range").orderBy(*[F.col(n).asc_nulls_last() for n in names]).rowsBetween(W.unboundedPreceding, 0)
    return (ranged.withColumn(out, F.sum(F.coalesce(value, F.lit(0))).over(upto)).join(starts, "_range")
            .withColumn(out, (F.col(out) + F.col("_offset")).cast("long")).drop("_range", "_offset", *names))
