"""Exact top-k inner products by norm buckets (after Teflioudi et al. 2015, "LEMP").

Vectors become integers, ``floor(scale * x)`` per component. Equal vectors are searched once: of a vector's ids only the
k + 1 smallest can be in anyone's result. Distinct vectors are put into buckets of similar length, longest first, and each
bucket into blocks of bounded size.

A query's k-th best score among the longest vectors is a first limit. With it a bucket has a local cosine threshold, the
limit over the product of the query's length and the bucket's longest. Above 1 the bucket is skipped. At ``COORDINATE_FROM``
or more the bucket is pruned by coordinates: only vectors whose components along the query's largest ones lie where that
cosine is possible. Below, it is pruned by length: the vectors of the bucket, sorted by length, up to the last that could
reach the limit. What is left is verified by integer products. Where the limit is not positive nothing can be pruned.

Blocks of queries meet blocks of vectors in tiles; each query sends on at most k + 1 candidates of a tile. The work is
quadratic at worst, as exact search is; the buckets save what the lengths allow.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import written

BLOCK = 2048
BUCKETS = 1024
HEAD = 4096
COORDINATE_FROM = 0.6
COORDINATES = 3
SLACK = 1e-9
EXACT = float(1 << 53)


def _matrix(column: pa.ChunkedArray | list, width: int) -> np.ndarray:
    """Rows of numbers as a matrix; shorter rows are filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.array(lists.value_lengths()).astype(np.int64)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows: by floating point where all partial sums are below 2^53, else by Python's
    integers; a result beyond a long is set to the nearest long."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)))
    if np.abs(a).max() * np.abs(b).max() * max(1, a.shape[1]) < EXACT:
        return a @ b.T
    whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    limit = (1 << 63) - 1
    return np.array([[max(-limit - 1, min(limit, sum(x * y for x, y in zip(p, q)))) for q in whole[1]] for p in whole[0]], dtype=object)


def _best(scores: np.ndarray, ids: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) over vectors with their ids; ties to smaller ids."""
    if len(scores) > 4 * k:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        scores, ids = scores[kept], [ids[i] for i in kept]
    s = np.repeat(scores, [len(x) for x in ids])
    i = np.concatenate(ids) if len(ids) else np.zeros(0, np.int64)
    order = np.lexsort((i, -s)) if s.dtype != object else np.array(sorted(range(len(s)), key=lambda x: (-s[x], i[x])), int)
    return s[order[:k]], i[order[:k]]


def _candidates(q: np.ndarray, length: float, limit: float, vectors: np.ndarray, units: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Rows of a block (sorted by falling length) that may reach the limit with one query."""
    if not len(norms) or limit <= 0 or length == 0:
        return np.arange(len(norms)) if limit <= 0 else np.zeros(0, np.int64)
    if norms[0] == 0:
        return np.zeros(0, np.int64)
    threshold = limit / (length * norms[0])
    if threshold > 1 + SLACK:
        return np.zeros(0, np.int64)
    if threshold < COORDINATE_FROM:
        return np.arange(np.searchsorted(-norms, -limit / length * (1 - SLACK), "right"))
    unit = q / length
    angle = np.arccos(min(1.0, threshold * (1 - SLACK)))
    ok = np.ones(len(norms), bool)
    for f in np.argsort(-np.abs(unit))[:COORDINATES]:
        own = np.arccos(np.clip(unit[f], -1, 1))
        low = np.cos(min(np.pi, own + angle))
        high = np.cos(max(0.0, own - angle))
        ok &= (units[:, f] >= low - SLACK) & (units[:, f] <= high + SLACK)
    return np.flatnonzero(ok)


def _packed(width: int):
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("vec"), width)
        norms = table.column("norm").to_numpy()
        order = np.argsort(-norms, kind="stable")
        ids = table.column("ids").combine_chunks().take(pa.array(order))
        counts = np.array(ids.value_lengths()).astype(np.int64)
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "vectors": [vectors[order].tobytes()], "norms": [norms[order].tobytes()],
                         "counts": [counts.tobytes()], "ids": [ids.flatten().to_numpy().astype(np.int64).tobytes()]})
    return pack


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for every row whose id is divisible by ``every``.

    Ranks from 1, ties to the smaller id. Rows with a NULL id, a NULL vector, or a component that is NULL, NaN or
    infinite take no part; equal rows count once. Vectors of different length are compared as if filled with zeros; an
    empty vector has product 0 with all. A query with fewer than k others gets all of them.
    """
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * F.lit(float(scale)))
    rounded = F.transform(scaled, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double") + F.lit(0.0)).otherwise(x))
    fine = F.col(vector_col).isNotNull() & F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = written(vectors.select(F.col(id_col).cast("long").alias("id"), F.when(fine, rounded).alias("vec")).where("id is not null and vec is not null").distinct(), "vectors")
    first = W.partitionBy("vec").orderBy("id")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    ranked = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    distinct = written(ranked.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("rep", F.col("ids")[0]).withColumn("norm", norm), "distinct")
    n, width, longest = distinct.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.max("norm")).first()
    width = width or 0

    parts = min(BUCKETS, -(-n // BLOCK)) if n else 1
    cuts = (distinct.agg(F.percentile_approx("norm", [i / parts for i in range(1, parts)], 20 * parts)).first()[0] or []) if parts > 1 else []
    bucket = F.aggregate(F.array(*[F.lit(float(c)) for c in cuts]), F.lit(0), lambda s, c: s + (F.col("norm") <= c).cast("int")) if cuts else F.lit(0)
    placed = distinct.withColumn("bucket", bucket)
    directory = [tuple(r) for r in placed.groupBy("bucket").agg(F.max("norm"), F.count(F.lit(1))).orderBy("bucket").collect()]
    blocks = {b: -(-c // BLOCK) for b, _, c in directory}
    of = F.get(F.array(*[F.lit(blocks.get(b, 1)) for b in range(max(blocks, default=0) + 1)]), F.col("bucket"))
    packed = (placed.withColumn("block", F.pmod(F.xxhash64("rep"), of).cast("int")).groupBy("bucket", "block")
              .applyInArrow(_packed(width), "bucket int, block int, vectors binary, norms binary, counts binary, ids binary"))
    packed = written(packed, "blocks")

    # The longest vectors, at most HEAD rows, are all that is broadcast: they give every query its first limit.
    head = distinct.orderBy(F.col("norm").desc(), "rep").limit(HEAD).select("vec", "ids").toArrow()
    shared = vectors.sparkSession.sparkContext.broadcast((_matrix(head.column("vec"), width) if len(head) else np.zeros((0, width)), head.column("ids").to_pylist()))

    queries = rows.where(F.pmod("id", F.lit(every)) == 0)
    asked = queries.select("vec").distinct().join(distinct.select("vec", "rep", "norm"), "vec")
    groups = -(-asked.count() // BLOCK) or 1

    def limits(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        q = _matrix(table.column("vec"), width)
        norms = table.column("norm").to_numpy()
        limit = np.full(len(q), -np.inf)
        base, ids = shared.value
        for lo in range(0, len(q), 256):
            scores = products(q[lo:lo + 256], base).astype(np.float64)
            for i, own in enumerate(scores):
                total, order = 0, np.argsort(-own, kind="stable")
                for j in order:
                    total += len(ids[j])
                    if total > k:
                        limit[lo + i] = own[j] - abs(own[j]) * SLACK
                        break
        with np.errstate(divide="ignore", invalid="ignore"):
            level = np.where((limit > 0) & (norms > 0), limit / norms, -np.inf)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "level": [float(max(level.min(), -1.0))], "queries": [q.tobytes()], "reps": [table.column("rep").to_numpy().tobytes()],
                         "lengths": [norms.tobytes()], "limits": [limit.tobytes()]})

    parts_ = written(asked.withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(groups)).cast("int")).groupBy("part").applyInArrow(
        limits, "part int, level double, queries binary, reps binary, lengths binary, limits binary"), "queries")
    known = F.array(*[F.struct(F.lit(b).alias("bucket"), F.lit(float(m) * (1 + SLACK)).alias("longest"), F.lit(blocks[b]).alias("blocks")) for b, m, _ in directory])
    kind = "array<struct<bucket:int,longest:double,blocks:int>>"
    reached = F.filter(known.cast(kind), lambda d: d["longest"] >= F.col("level"))
    tiles = (parts_.select("part", F.explode(reached).alias("d")).select("part", "d.bucket", F.explode(F.sequence(F.lit(0), F.col("d.blocks") - 1)).alias("block")))
    none = F.lit(None).cast("binary")
    left = tiles.join(parts_, "part").select("part", "bucket", "block", "queries", "reps", "lengths", "limits", *[none.alias(c) for c in ("vectors", "norms", "counts", "ids")])
    right = tiles.join(packed, ["bucket", "block"]).select("part", "bucket", "block", *[none.alias(c) for c in ("queries", "reps", "lengths", "limits")],
                                                          "vectors", "norms", "counts", "ids")

    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        held = {c: next((np.frombuffer(x.as_py(), np.int64 if c in ("reps", "counts", "ids") else np.float64) for x in table.column(c) if x.is_valid), None)
                for c in ("queries", "reps", "lengths", "limits", "vectors", "norms", "counts", "ids")}
        out_q, out_i, out_s = [], [], []
        if held["norms"] is not None and held["reps"] is not None:
            q, v = held["queries"].reshape(-1, width) if width else np.zeros((len(held["reps"]), 0)), held["vectors"].reshape(-1, width) if width else np.zeros((len(held["norms"]), 0))
            norms, ids = held["norms"], np.split(held["ids"], np.cumsum(held["counts"])[:-1])
            units = v / np.where(norms > 0, norms, 1)[:, None]
            for lo in range(0, len(q), 256):
                hi = min(len(q), lo + 256)
                found = [_candidates(q[i], held["lengths"][i], held["limits"][i], v, units, norms) for i in range(lo, hi)]
                # Queries that keep much of the block are verified together, the others on their own few rows.
                many = [i for i in range(lo, hi) if len(found[i - lo]) > len(v) // 8]
                together = dict(zip(many, products(q[many], v))) if many else {}
                for i in range(lo, hi):
                    some = found[i - lo]
                    scores = together[i][some] if i in together else products(q[i:i + 1], v[some])[0] if len(some) else np.zeros(0)
                    good = np.flatnonzero(scores >= held["limits"][i])
                    s, best = _best(scores[good], [ids[some[j]] for j in good], k + 1)
                    out_q.append(np.full(len(s), held["reps"][i]))
                    out_i.append(best)
                    out_s += [int(x) for x in s]
        return pa.table({"rep": pa.array(np.concatenate(out_q) if out_q else np.zeros(0, np.int64)), "vec_id": pa.array(np.concatenate(out_i) if out_i else np.zeros(0, np.int64)),
                         "score": pa.array(out_s, pa.int64())})

    met = left.unionByName(right).groupBy("part", "bucket", "block").applyInArrow(search, "rep long, vec_id long, score long")
    best = W.partitionBy("rep").orderBy(F.col("score").desc(), "vec_id")
    lists = (met.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).groupBy("rep")
             .agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("best")))
    own = queries.join(distinct.select("vec", "rep"), "vec").select("id", "rep").join(lists, "rep")
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("id")), 1, k)
    return own.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias(id_col), F.col("b.score").alias("score"))
