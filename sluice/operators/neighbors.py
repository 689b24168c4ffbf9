"""Exact k nearest neighbours without comparing everything with everything.

Base vectors are put into the cells of a tree: a cell with more vectors than a block is split by pivots, some of its own
vectors, each vector going to its nearest pivot, until all cells are small. The tree is a table with one row per split
cell, its pivots and how near and far their vectors lie; vectors and queries meet it level by level in joins on the cell,
in chunks of bounded size, and the driver sees only how many levels there are. Each group has a tree of its own.

Each query first descends to the cell of its nearest pivots, which bounds the distance of its k-th neighbour. Then it goes
down again into every cell that the triangle inequality and the planes between pivots do not rule out, and visits those
(after Lu, Shen, Chen, Ooi: "Efficient processing of k nearest neighbor joins using MapReduce", VLDB 2012). A visit is an
equi-join of query chunks and base blocks of bounded size; small cells share a task, so groups may be many.

In many dimensions without structure nearly every query visits nearly every cell, so what a visit carries decides what is
shuffled: blocks grow with their group (``_block_rows``), so that there are a few tens of cells whatever its size, a visit
gives one row with the keys and distances found within the query's bound, and vectors of neighbours are fetched at the end.

Equal vectors are collapsed first: of the copies of a base vector only the smallest k + 1 keys can be among anyone's k
nearest (ties go to the smaller key), and copies of a query share one search.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions import dtypes, q
from ..session import small_table, written
from .ranking import COPY_BLOCK

BLOCK_ROWS = 2048
BLOCKS = 16
FANOUT = 64
CHUNK_ROWS = 8192
MAX_LEVELS = 40
CELL = ["_g", "_cell"]
_WORK = 4_000_000


def vector_of(df: DataFrame, features: str | list[str]) -> Column:
    """The features as an array of doubles: one array column, or numeric columns in the given order."""
    if isinstance(features, str):
        return q(features).cast("array<double>")
    return F.array(*[q(c).cast("double") for c in features])


def _stored(df: DataFrame, features: str | list[str]) -> Column:
    """As :func:`vector_of`, but floats stay floats: they are half the bytes and are compared as doubles all the same."""
    floats = isinstance(features, str) and dtypes(df)[features].simpleString() == "array<float>"
    return q(features) if floats else vector_of(df, features)


def knn_join(queries: DataFrame, base: DataFrame, key: str, features: str | list[str], k: int = 5, within: str | None = None,
             label: str | None = None, block_rows: int | None = None, pivots: int | None = None, vectors: bool = True) -> DataFrame:
    """``(<key>, rank, neighbor, distance, neighbor_label, neighbor_vector)``: the k nearest base rows of each query row.

    Euclidean distance; a row is not its own neighbour; ties by key. ``within`` looks for neighbours in the same group
    only. Features must be numbers without NULL. ``key`` identifies a row in both tables. ``pivots`` is how many parts a
    cell is split into at most; ``block_rows`` follows from the data unless given. Without ``vectors`` there is no
    ``neighbor_vector``, and none is moved.
    """
    lists = knn_lists(queries, base, key, features, k, within, label, block_rows, pivots, vectors)
    vector = [F.col("_n.vector").alias("neighbor_vector")] if vectors else []
    return (lists.select(q(key), F.posexplode("neighbors").alias("_i", "_n"))
            .select(q(key), (F.col("_i") + 1).alias("rank"), F.col("_n.key").alias("neighbor"), F.col("_n.distance").alias("distance"),
                    F.col("_n.label").alias("neighbor_label"), *vector))


def knn_lists(queries: DataFrame, base: DataFrame, key: str, features: str | list[str], k: int = 5, within: str | None = None,
              label: str | None = None, block_rows: int | None = None, pivots: int | None = None, vectors: bool = True) -> DataFrame:
    """The query rows with their neighbours as an array of structs, nearest first, in ``neighbors``."""
    # Rows without a group are a group of their own, apart from the empty text.
    group = F.coalesce(F.concat(F.lit("="), q(within).cast("string")), F.lit("")) if within else F.lit("")
    same = _stored(queries, features), _stored(base, features)
    if dtypes(queries.select(same[0].alias("_v"))) != dtypes(base.select(same[1].alias("_v"))):
        same = vector_of(queries, features), vector_of(base, features)
    searched = queries.withColumn("_v", same[0]).withColumn("_g", group)
    searched = searched.withColumn("_id", _identity())
    tag = q(label).cast("string") if label else F.lit(None).cast("string")
    points = base.select(q(key).alias("_k"), tag.alias("_l"), group.alias("_g"), same[1].alias("_v"))
    distinct = searched.groupBy("_id").agg(F.first("_g").alias("_g"), F.first("_v").alias("_v"), F.count(F.lit(1)).alias("_copies"))
    distinct = written(distinct, "queries")
    found = _search(distinct.drop("_copies"), points, dtypes(base)[key], k, block_rows, pivots, vectors)
    # Copies of one query meet the same result: split them over salts so that no task gets them all.
    heavy, _ = small_table(distinct.where(q("_copies") > COPY_BLOCK).select("_id", F.ceil(q("_copies") / COPY_BLOCK).cast("int").alias("_salts")))
    left = searched.join(heavy, "_id", "left").withColumn("_salt", F.pmod(F.xxhash64(q(key)), F.coalesce(q("_salts"), F.lit(1))).cast("int"))
    right = found.join(heavy, "_id", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(q("_salts"), F.lit(1)) - 1)))
    joined = left.drop("_salts", "_g", "_v").join(right.drop("_salts"), ["_id", "_salt"], "left")
    others = F.slice(F.filter("_found", lambda n: n["key"] != q(key)), 1, k)
    return joined.withColumn("neighbors", F.coalesce(others, F.array())).drop("_id", "_salt", "_found")


def _identity() -> Column:
    """A text of 128 bits that stands for a (group, vector) pair."""
    return F.substring(F.sha2(F.to_json(F.struct("_g", "_v")), 256), 1, 32)


def _distinct_base(points: DataFrame, k: int) -> DataFrame:
    """One row per (group, vector) with its k + 1 smallest keys and their labels; limited per key before the shuffle."""
    identified = points.withColumn("_id", _identity())
    rank = F.row_number().over(W.partitionBy("_id").orderBy("_k"))
    kept = identified.withColumn("_r", rank).where(q("_r") <= k + 1)
    return (kept.groupBy("_id").agg(F.first("_g").alias("_g"), F.first("_v").alias("_v"),
                                    F.sort_array(F.collect_list(F.struct("_k", "_l"))).alias("_m"))
            .select("_id", "_g", "_v", F.transform("_m", lambda m: m["_k"]).alias("_ks"), F.transform("_m", lambda m: m["_l"]).alias("_ls")))


def _block_rows(base: DataFrame) -> int:
    """Rows of a cell that is not split any more: a share of the largest group, within bounds that follow from the width.

    Narrow vectors keep small cells, which the bounds rule out one by one; blocks of wide ones take some 30 MB at most.
    """
    first = base.select(F.size("_v")).first()
    width = max(1, first[0] if first else 1)
    most = base.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    low = max(BLOCK_ROWS, min(16_384, 256 * width, (1 << 20) // width))
    return max(low, min(most // BLOCKS, 65_536, 1024 * width, (1 << 22) // width))


def _search(queries: DataFrame, points: DataFrame, key_type: T.DataType, k: int, block_rows: int | None, pivots: int | None,
            vectors: bool = True) -> DataFrame:
    """``(_id, _found)``: the k + 1 nearest keys of each distinct query, itself included."""
    base = written(_distinct_base(points, k), "distinct")
    block_rows = block_rows or _block_rows(base)
    placed, levels = _tree(base, key_type, block_rows, max(2, pivots or FANOUT))
    schema = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_d", T.ArrayType(T.DoubleType())), T.StructField("_n", T.ArrayType(key_type)),
                           T.StructField("_nl", T.ArrayType(T.StringType())), T.StructField("_b", T.ArrayType(T.StringType()))])
    visit = lambda visits: _visit(visits, placed, schema, k, block_rows)
    vector = dtypes(base)["_v"].simpleString()
    own = queries.select("_id", "_g", "_v", F.lit("").alias("_cell"))
    for level in levels:
        own = _moved(own, level, _descend, f"_id string, _g string, _v {vector}, _cell string")
    near = visit(own.withColumn("_bound", F.lit(float("inf"))))
    if levels:
        near = written(near, "near")
        bound = near.groupBy("_id").agg(F.sum(F.size("_d")).alias("_c"), F.max(F.array_max("_d")).alias("_far"))
        bounded = own.withColumnRenamed("_cell", "_own").join(bound, "_id", "left").select(
            "_id", "_g", "_v", F.when(q("_c") > k, q("_far")).otherwise(float("inf")).alias("_bound"), "_own", F.lit("").alias("_cell"))
        for level in levels:
            bounded = _moved(bounded, level, _spread, f"_id string, _g string, _v {vector}, _bound double, _own string, _cell string")
        near = near.unionByName(visit(bounded.where(q("_cell") != q("_own")).drop("_own")))
    entry = lambda e: F.struct(e["_d"].alias("distance"), e["_n"].alias("key"), e["_nl"].alias("label"), e["_b"].alias("base"))
    parts = near.select("_id", F.transform(F.arrays_zip("_d", "_n", "_nl", "_b"), entry).alias("_found"))
    found = parts.groupBy("_id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("_found"))), 1, k + 1).alias("_found"))
    if not vectors:
        return found
    known = base.select(q("_id").alias("_b"), q("_v").cast("array<double>").alias("_v"))
    entries = found.select("_id", F.explode("_found").alias("_e")).withColumn("_b", F.col("_e.base")).join(known, "_b")
    full = F.struct(F.col("_e.distance").alias("distance"), F.col("_e.key").alias("key"), F.col("_e.label").alias("label"), q("_v").alias("vector"))
    return entries.groupBy("_id").agg(F.sort_array(F.collect_list(full)).alias("_found"))


def _at(rows: DataFrame, nodes: DataFrame, step: Callable, schema: str | T.StructType) -> DataFrame:
    """``step(rows, node)`` for the rows in each cell that has a row in ``nodes``, some ``CHUNK_ROWS`` at a time."""
    counts = rows.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).cast("int").alias("_chunks"))
    met = written(nodes.join(counts, CELL), "nodes")
    left = rows.join(met.select(*CELL, "_chunks"), CELL).withColumn("_chunk", F.pmod(F.xxhash64("_id"), q("_chunks")).cast("int")).drop("_chunks")
    right = met.withColumn("_chunk", F.explode(F.sequence(F.lit(0), q("_chunks") - 1)))
    return left.groupBy(*CELL, "_chunk").cogroup(right.groupBy(*CELL, "_chunk")).applyInPandas(step, schema)


def _moved(rows: DataFrame, level: DataFrame, step: Callable, schema: str) -> DataFrame:
    """Rows in split cells go on to parts of them, all others stay."""
    stay = rows.join(level.select(*CELL), CELL, "left_anti")
    return written(_at(rows, level, step, schema).unionByName(stay), "moved")


def _tree(points: DataFrame, key_type: T.DataType, block_rows: int, fanout: int) -> tuple[DataFrame, list[DataFrame]]:
    """The base with its cells, and for each level its split cells with ``_pivots``, ``_children``, ``_near`` and ``_far``.

    Pivots are the vectors of a cell with the smallest hashes, twice as many as blocks are needed, but no more than
    ``fanout``. They are distinct, so every split leaves smaller cells.
    """
    schema = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_g", T.StringType()), points.schema["_v"],
                           T.StructField("_ks", T.ArrayType(key_type)), T.StructField("_ls", T.ArrayType(T.StringType())), T.StructField("_cell", T.StringType()),
                           T.StructField("_parent", T.StringType()), T.StructField("_child", T.IntegerType()), T.StructField("_reach", T.DoubleType())])
    rest = written(points.withColumn("_cell", F.lit("")), "base")
    columns, done, levels = rest.columns, [], []
    while True:
        large = written(rest.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n")).where(q("_n") > block_rows), "large")
        if len(levels) == MAX_LEVELS or large.isEmpty():
            done.append(rest)
            break
        done.append(rest.join(large, CELL, "left_anti"))
        split = rest.join(large, CELL)
        first = F.row_number().over(W.partitionBy(*CELL).orderBy(F.xxhash64("_v"), "_id"))
        picked = split.select(*CELL, "_id", "_v", "_n").withColumn("_r", first).where(q("_r") <= fanout).where(q("_r") <= F.greatest(F.lit(2), F.ceil(2 * q("_n") / block_rows)))
        nodes = written(picked.groupBy(*CELL).agg(F.sort_array(F.collect_list(F.struct("_r", "_v")))["_v"].alias("_pivots")), "pivots")
        assigned = written(_at(split.drop("_n"), nodes, _assign, schema), "assigned")
        spans = assigned.groupBy("_g", q("_parent").alias("_cell"), "_child").agg(F.min("_reach").alias("_near"), F.max("_reach").alias("_far"))
        parts = spans.groupBy(*CELL).agg(F.sort_array(F.collect_list(F.struct("_child", "_near", "_far"))).alias("_parts"))
        levels.append(written(nodes.join(parts, CELL).select(*CELL, "_pivots", q("_parts")["_child"].alias("_children"), q("_parts")["_near"].alias("_near"), q("_parts")["_far"].alias("_far")), "level"))
        rest = assigned.select(*columns)
    placed = done[0]
    for part in done[1:]:
        placed = placed.unionByName(part)
    return placed, levels


def _below(cell: str, child: np.ndarray) -> list[str]:
    return [f"{cell}.{c}" for c in child.tolist()]


def _assign(rows: pd.DataFrame, node: pd.DataFrame) -> pd.DataFrame:
    """Each vector of a cell with its nearest pivot."""
    if not len(rows) or not len(node):
        return pd.DataFrame({c: [] for c in ("_id", "_g", "_v", "_ks", "_ls", "_cell", "_parent", "_child", "_reach")})
    centers, child, reach = np.stack(node["_pivots"].iloc[0]).astype(float), [], []
    for _, d in _distances(_matrix(rows["_v"]), centers):
        child.append(d.argmin(1))
        reach.append(d.min(1))
    child, cell = np.concatenate(child), rows["_cell"].iloc[0]
    return rows[["_id", "_g", "_v", "_ks", "_ls"]].assign(_cell=_below(cell, child), _parent=cell, _child=child.astype("int32"), _reach=np.concatenate(reach))


def _descend(rows: pd.DataFrame, node: pd.DataFrame) -> pd.DataFrame:
    """Each query goes to the part with the nearest pivot that has vectors; every pivot has itself."""
    if not len(rows) or not len(node):
        return pd.DataFrame({c: [] for c in ("_id", "_g", "_v", "_cell")})
    ids = np.asarray(node["_children"].iloc[0])
    centers = np.stack(node["_pivots"].iloc[0]).astype(float)[ids]
    child = np.concatenate([ids[d.argmin(1)] for _, d in _distances(_matrix(rows["_v"]), centers)])
    return rows[["_id", "_g", "_v"]].assign(_cell=_below(rows["_cell"].iloc[0], child))


def _spread(rows: pd.DataFrame, node: pd.DataFrame) -> pd.DataFrame:
    """Each query goes to every part that could hold a vector within its bound."""
    columns = ["_id", "_g", "_v", "_bound", "_own"]
    if not len(rows) or not len(node):
        return pd.DataFrame({c: [] for c in (*columns, "_cell")})
    ids, near, far = (np.asarray(node[c].iloc[0]) for c in ("_children", "_near", "_far"))
    centers = np.stack(node["_pivots"].iloc[0]).astype(float)[ids]
    gaps = np.sqrt(((centers[:, None, :] - centers[None, :, :]) ** 2).sum(-1))
    bounds, at, to = rows["_bound"].to_numpy(), [], []
    for start, d in _distances(_matrix(rows["_v"]), centers):
        home = d.argmin(1)
        least = np.maximum(np.maximum(d - far, near - d), 0)
        # Vectors of another part lie beyond the plane between its pivot and the query's nearest pivot.
        gap = gaps[home]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(gap > 0, (d ** 2 - d.min(1)[:, None] ** 2) / (2 * gap), 0)
        i, j = np.nonzero(np.maximum(least, plane) - 1e-9 * (1 + d) <= bounds[start:start + len(d), None])
        at.append(start + i)
        to.append(ids[j])
    found = rows.iloc[np.concatenate(at)][columns]
    return found.assign(_cell=_below(rows["_cell"].iloc[0], np.concatenate(to)))


def _visit(visits: DataFrame, placed: DataFrame, schema: T.StructType, k: int, block_rows: int) -> DataFrame:
    """Lets each (query, cell) pair see the cell's vectors, as an equi-join of bounded chunks and blocks.

    A cell that needs one chunk and one block shares a bucket with others.
    """
    parts = lambda df, name: df.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name), F.count(F.lit(1)).alias(f"{name}_n"))
    sides = written(parts(visits, "_chunks").join(parts(placed, "_blocks"), CELL), "sides")
    # Enough buckets for the rows of either side.
    rows = sides.where("_chunks = 1 and _blocks = 1").agg(F.greatest(F.sum("_chunks_n"), F.sum("_blocks_n"))).first()[0] or 0
    buckets, sides = max(1, -(-rows // block_rows)), sides.drop("_chunks_n", "_blocks_n")
    chunk = F.pmod(F.xxhash64("_id"), q("_chunks")).cast("int")
    block = F.pmod(F.xxhash64("_id"), q("_blocks")).cast("int")
    span = lambda c: F.sequence(F.lit(0), q(c) - 1)
    home = F.xxhash64(*CELL)
    tile = F.when((q("_chunks") == 1) & (q("_blocks") == 1), F.pmod(home, F.lit(buckets)).cast("string")).otherwise(F.concat_ws(":", home, "_chunk", "_block"))
    left = visits.join(sides, CELL).withColumn("_chunk", chunk).withColumn("_block", F.explode(span("_blocks"))).withColumn("_tile", tile)
    right = placed.join(sides, CELL).withColumn("_block", block).withColumn("_chunk", F.explode(span("_chunks"))).withColumn("_tile", tile)
    return (left.select("_tile", *CELL, "_id", "_v", "_bound").groupBy("_tile")
            .cogroup(right.select("_tile", *CELL, "_id", "_v", "_ks", "_ls").groupBy("_tile"))
            .applyInPandas(_cells(k), schema))


def _cells(k: int) -> Callable:
    """:func:`_tile` for each cell of a bucket."""
    tile = _tile(k)

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        asked, held = left.groupby(CELL, sort=False).indices, right.groupby(CELL, sort=False).indices
        found = [tile(left.iloc[asked[c]], right.iloc[held[c]]) for c in asked if c in held]
        return pd.concat(found, ignore_index=True) if found else tile(left.iloc[:0], right)
    return compare


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float) if len(vectors) else np.empty((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Distance rows of ``a`` against all of ``b``, some rows at a time, from plain differences."""
    step = max(1, _WORK // max(1, b.size))
    for start in range(0, len(a), step):
        yield start, np.sqrt(((a[start:start + step, None, :] - b[None, :, :]) ** 2).sum(-1))


def _tile(k: int) -> Callable:
    """The k + 1 nearest keys within one chunk x block, one row per query that has any within its bound.

    Squared distances come from a matrix product; pairs that could be among the nearest within its rounding error are
    measured again by plain differences.
    """
    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in ("_id", "_d", "_n", "_nl", "_b")}, dtype=object)
        base, ids, bases = _matrix(right["_v"]), left["_id"].to_numpy(), right["_id"].to_numpy()
        copies = right["_ks"].str.len().to_numpy()
        keys = np.concatenate([np.asarray(x) for x in right["_ks"]])
        labels = np.concatenate([np.asarray(x, dtype=object) for x in right["_ls"]])
        first = np.cumsum(copies) - copies
        place = np.unique(keys, return_inverse=True)[1]
        squares, parts = (base ** 2).sum(1), []
        queries, bounds = _matrix(left["_v"]), left["_bound"].to_numpy()
        step = max(1, _WORK // max(1, len(base)))
        for start in range(0, len(queries), step):
            a = queries[start:start + step]
            own = (a ** 2).sum(1)
            rough = own[:, None] + squares - 2 * (a @ base.T)
            slack = 1e-9 * (own + squares.max() + 1)
            edge = bounds[start:start + step] ** 2 + slack
            near = rough <= edge[:, None]
            many = np.flatnonzero(near.sum(1) > k + 1)
            if len(many):
                ranked = rough[many]
                near[many] = ranked <= np.minimum(edge[many], np.partition(ranked, k, axis=1)[:, k] + slack[many])[:, None]
            row, column = np.nonzero(near)
            d = np.sqrt(((a[row] - base[column]) ** 2).sum(-1))
            entry = np.repeat(first[column], copies[column]) + np.arange(copies[column].sum()) - np.repeat(np.cumsum(copies[column]) - copies[column], copies[column])
            row, column, d = (np.repeat(x, copies[column]) for x in (row, column, d))
            order = np.lexsort((place[entry], d, row))
            row, column, d, entry = row[order], column[order], d[order], entry[order]
            kept = np.arange(len(row)) - np.searchsorted(row, row) <= k
            row, column, d, entry = row[kept], column[kept], d[kept], entry[kept]
            if len(row):
                begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                split = lambda x: np.split(x, begins[1:])  # noqa: B023, E731
                parts.append(pd.DataFrame({"_id": ids[start + row[begins]], "_d": split(d), "_n": split(keys[entry]), "_nl": split(labels[entry]), "_b": split(bases[column])}))
        return pd.concat(parts, ignore_index=True) if parts else compare(left.iloc[:0], right)
    return compare
