"""Exact row numbers and exact-size selections within groups of any size.

A window over a label would put the majority class on one task. Here the order of each group is cut into cells: an
ordinary aggregate counts the rows per (group, cell), the running sum of these counts gives each cell's offset, and
only rows of one cell are sorted together. Seeded orders use the prefix of the hash as the cell, which needs no
look at the data; orders by a key use ranges of the whole key.

Keys must tell rows apart. For tables without such a key, :func:`with_copy_number` adds the missing part.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions import cell_digits, hash_cell, order_hash, q
from ..session import small_table, written

COPY_BLOCK = 100_000
ROWS_PER_CELL = 1_000_000


@dataclass
class Ordered:
    """A table with its order (``_o0.._on``), its cell (``_cell``) and its group columns (``_g0.._gn``)."""
    df: DataFrame
    group: list[str]
    order: list[str]

    def plain(self, df: DataFrame) -> DataFrame:
        return df.drop("_cell", *self.group, *self.order)


def repeat_rows(df: DataFrame, times: str, out: str) -> DataFrame:
    """Writes each row ``times`` times and numbers these copies 0, 1, .. in ``out``; the column ``times`` is dropped.

    Rows with many copies are divided into blocks first and the blocks spread over the tasks.
    """
    zero = F.lit(0).cast("bigint")
    few = df.where(q(times).between(1, COPY_BLOCK)).withColumn(out, F.explode(F.sequence(zero, q(times) - 1)))
    blocks = (df.where(q(times) > COPY_BLOCK)
              .withColumn("_b", F.explode(F.sequence(zero, F.floor((q(times) - 1) / COPY_BLOCK))))
              .repartition(q("_b"), *[q(c) for c in df.columns]))
    many = blocks.withColumn(out, F.explode(F.sequence(
        q("_b") * COPY_BLOCK, F.least((q("_b") + 1) * COPY_BLOCK, q(times)) - 1))).drop("_b")
    return few.unionByName(many).drop(times)


def with_copy_number(df: DataFrame, out: str = "_copy") -> DataFrame:
    """Numbers the copies of equal rows 0, 1, ..; all columns together with ``out`` are then a key.

    Copies are counted with partial aggregation and written out again in blocks, so a row that fills a third of the
    table is never held by one task.
    """
    counted = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return repeat_rows(counted, "_n", out)


def _by_key(df: DataFrame, key: list[str], rows_per_cell: int) -> DataFrame:
    """Adds ``_cell``: ranges of the whole key over the whole table, about ``rows_per_cell`` rows each.

    Spark samples full keys for the borders, so neither a hot first column nor texts with a long common beginning fill a
    cell. The table is written once in this order, which fixes the cells.
    """
    cells = -(-df.count() // rows_per_cell)
    if cells < 2:
        return df.withColumn("_cell", F.lit(0))
    return written(df.repartitionByRange(cells, *[q(k).asc() for k in key]).withColumn("_cell", F.spark_partition_id()), "cells")


def ordered(df: DataFrame, by: list[str], key: list[str] | str | None, seed=None,
            rows_per_cell: int = ROWS_PER_CELL, keep: bool = False) -> Ordered:
    """Prepares ``df`` for ranking: in seeded order, or by ``key`` itself when ``seed`` is None.

    ``keep`` is for callers that read the result several times: without a key, copies are then numbered and hashes taken
    once and written, 16 bytes of hash beside each row.
    """
    by = [by] if isinstance(by, str) else list(by)
    digits = cell_digits(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if key is None:
        if seed is None:
            raise ValueError("an order needs a key or a seed")
        plain = df.columns
        df = with_copy_number(df)
        df = df.withColumn("_o0", F.md5(F.concat_ws(":", F.lit(str(seed)), F.to_json(F.struct(*[q(c) for c in plain])), q("_copy"))))
        df = df.withColumnRenamed("_copy", "_o1").withColumn("_o2", F.xxhash64(*[q(c) for c in plain]))
        order = ["_o0", "_o1", "_o2"]
        df = df.withColumn("_cell", hash_cell(q("_o0"), digits))
        if keep:  # bytes have the order of their hexadecimal digits
            df = written(df.drop("_o2").withColumn("_o0", F.unhex("_o0")), "ordered").withColumn("_o2", F.xxhash64(*[q(c) for c in plain]))
    else:
        key = [key] if isinstance(key, str) else list(key)
        columns = [q(k).alias(f"_o{i + (seed is not None)}") for i, k in enumerate(key)]
        if seed is not None:
            columns = [order_hash(seed, key).alias("_o0"), *columns]
        else:
            df = _by_key(df, key, rows_per_cell)
        order = [f"_o{i}" for i in range(len(columns))]
        df = df.select("*", *columns)
        if seed is not None:
            df = df.withColumn("_cell", hash_cell(q("_o0"), digits))
    group = []
    for i, b in enumerate(by):
        group += [f"_g{2 * i}", f"_g{2 * i + 1}"]
        df = df.withColumn(f"_g{2 * i}", F.coalesce(q(b).cast("string"), F.lit(""))).withColumn(f"_g{2 * i + 1}", q(b).isNull())
    return Ordered(df, group, order)


def _cells(o: Ordered) -> DataFrame:
    """Rows per (group, cell), rows before the cell and rows of the whole group.

    The window behind the running sum sees one row per cell of a group.
    """
    group = [q(g) for g in o.group]
    counts = o.df.groupBy(*group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    within = W.partitionBy(*group)
    upto = within.orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (counts.withColumn("_before", F.sum("_n").over(upto) - q("_n"))
            .withColumn("_total", F.sum("_n").over(within)))


def number_rows(df: DataFrame, by=(), key=None, seed=None, out: str = "rn", total: str | None = None,
                rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Adds the exact 1-based row number within ``by``; one full shuffle, spread over (group, cell).

    ``total`` names an additional column for the size of the group.
    """
    o = ordered(df, by, key, seed, rows_per_cell)
    place = [*o.group, "_cell"]
    inner = W.partitionBy(*[q(c) for c in place]).orderBy(*[q(c) for c in o.order])
    ranked = o.df.withColumn("_inner", F.row_number().over(inner))
    joined = ranked.join(_cells(o), place)
    joined = joined.withColumn(out, q("_before") + q("_inner"))
    if total:
        joined = joined.withColumn(total, q("_total"))
    return o.plain(joined).drop("_inner", "_before", "_total", "_n")


def _constant(row, dtype: T.StructType) -> Column:
    if row is None:
        return F.lit(None).cast(dtype)
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in dtype.fields])


def take_first(df: DataFrame, by, take: Column, key=None, seed=None, out: str = "taken",
               targets: DataFrame | None = None, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Adds the flag ``out``: True for exactly the first ``take`` rows of each group.

    ``take`` is an expression over ``_total``, the size of the group, and over the columns of ``targets``, an
    optional table with the columns of ``by``. Only rows of the one cell in which a group's limit falls are ranked;
    every other row is decided by comparing it with its group's last taken row, so the table itself is not shuffled.
    """
    o = ordered(df, by, key, seed, rows_per_cell, keep=True)
    by = [by] if isinstance(by, str) else list(by)
    cells = _cells(o)
    if targets is not None:
        keys = [F.coalesce(q(b).cast("string"), F.lit("")).alias(f"_g{2 * i}") for i, b in enumerate(by)]
        keys += [q(b).isNull().alias(f"_g{2 * i + 1}") for i, b in enumerate(by)]
        cells = cells.join(targets.select(*keys, *[q(c) for c in targets.columns if c not in by]), o.group)
    cells = cells.withColumn("_take", F.least(F.greatest(take.cast("bigint"), F.lit(0)), q("_total")))
    # The cell that holds the last taken row; groups that give nothing have none.
    last = cells.where((q("_take") > q("_before")) & (q("_take") <= q("_before") + q("_n")))
    last, _ = small_table(last.select(*o.group, "_cell", (q("_take") - q("_before")).alias("_need")))
    inner = W.partitionBy(*[q(g) for g in o.group]).orderBy(*[q(c) for c in o.order])
    order_row = F.struct(*[q(c) for c in o.order])
    edge = (o.df.select(*o.group, "_cell", *o.order).join(last, [*o.group, "_cell"])
            .withColumn("_r", F.row_number().over(inner)).where(q("_r") <= q("_need") + 1)
            .groupBy(*o.group).agg(F.max(F.when(q("_r") <= q("_need"), order_row)).alias("_edge"),
                                   F.max(F.when(q("_r") == q("_need") + 1, order_row)).alias("_next")))
    edge, rows = small_table(edge)
    torn = any(r["_edge"] == r["_next"] for r in rows) if rows is not None else bool(edge.where(q("_edge") == q("_next")).take(1))
    if torn:
        raise ValueError("the key does not tell rows apart; pass key=None to number equal rows")
    if o.group:
        joined = o.df.join(edge, o.group, "left")
    else:
        joined = o.df.withColumn("_edge", _constant(rows[0]["_edge"], edge.schema["_edge"].dataType))
    flagged = joined.withColumn(out, F.coalesce(order_row <= q("_edge"), F.lit(False)))
    return o.plain(flagged).drop("_edge", "_next")
