"""Hard negatives by exact inner products, scored with the method of the Four Russians.

Components become integers, ``floor(scale * x)``. The index keeps candidates as bit planes in two's complement: plane ``b``
of a group of eight dimensions is one byte per candidate, packed by slices of bounded size. For an anchor and a group the
256 sums of its components over all subsets of the eight dimensions are computed once. A score is then the sum over groups
of the table's entry at each plane's byte, doubled from plane to plane, the highest one counted negative: no
multiplication, and every score is the full inner product.

Blocks of anchors meet slices of candidates in tiles, which Spark deals out; a tile sends on a bounded number of rows for
each anchor. The first pass scores the candidates of the anchor's own label and finds its positives, the second the
others within the limits that the positives give. The work is quadratic, as exact search is; copied rows are dealt by the
hash of the whole row, so that a vector, an id or a label which fills a third of the table is spread over all slices.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import written

ANCHORS = 1024
SLICE = 32768
LEAST = 1024
TOGETHER = 128
STEP = 2048
LONG = (-(1 << 63), (1 << 63) - 1)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """Doubles that are whole numbers as int64, or as Python's integers where one is 2^62 or more."""
    if not values.size or np.abs(values).max() < float(1 << 62):
        return values.astype(np.int64)
    return np.array([[int(x) for x in row] for row in values], dtype=object).reshape(values.shape)


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """Bytes by (plane, group of eight dimensions, row), lowest plane first; the last plane counts negative."""
    n, width = vectors.shape
    groups = max(1, -(-width // 8))
    filled = np.zeros((n, groups * 8), vectors.dtype)
    filled[:, :width] = vectors
    low, high = (int(filled.min()), int(filled.max())) if n else (0, 0)
    bits = max(high.bit_length(), (~low).bit_length() if low < 0 else 0) + 1
    return np.stack([np.packbits(((filled >> b) & 1).astype(np.uint8).reshape(n, groups, 8), axis=2, bitorder="little")[:, :, 0].T for b in range(bits)])


def subset_sums(anchors: np.ndarray, groups: int, kind) -> np.ndarray:
    """Sums of the anchors' components over every subset of eight dimensions, by (group, subset, anchor)."""
    filled = np.zeros((len(anchors), groups * 8), kind)
    filled[:, :anchors.shape[1]] = anchors
    parts = filled.reshape(len(anchors), groups, 8).transpose(1, 2, 0)
    out = np.zeros((groups, 256, len(anchors)), kind)
    for i in range(8):
        out[:, 1 << i:2 << i] = out[:, :1 << i] + parts[:, i:i + 1]
    return out


def scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products by (anchor, candidate): tables of subset sums, looked up by the bytes of each plane."""
    bits, groups, n = planes.shape
    most = max((sum(abs(int(x)) for x in row) for row in anchors), default=0) << bits
    kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 62 else object
    found = np.zeros((len(anchors), n), kind if kind is not object else np.int64)
    for a in range(0, len(anchors), TOGETHER):
        table = subset_sums(anchors[a:a + TOGETHER], groups, kind)
        for lo in range(0, n, STEP):
            part = planes[:, :, lo:lo + STEP]
            total = np.zeros((part.shape[2], table.shape[2]), kind)
            for b in range(bits - 1, -1, -1):
                total += total
                for g in range(groups):
                    looked = table[g].take(part[b, g], axis=0)
                    total = total - looked if b == bits - 1 else np.add(total, looked, out=total)
            found[a:a + TOGETHER, lo:lo + STEP] = (np.clip(total, *LONG) if kind is object else total).T
    return found


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers; shorter rows are filled with zeros."""
    lists = column.combine_chunks()
    lengths = np.array(lists.value_lengths()).astype(np.int64)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = lists.flatten().to_numpy(zero_copy_only=False)
    return whole_numbers(out)


def _label_codes(column: pa.ChunkedArray) -> tuple[list[str], np.ndarray]:
    coded = column.combine_chunks().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _pack_slice(width: int):
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        labels, codes = _label_codes(table.column("label"))
        ids = table.column("id").to_numpy()
        order = np.lexsort((ids, codes))
        planes = bit_planes(_matrix(table.column("vec"), width)[order])
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([planes.shape[0]], pa.int32()), "planes": [planes.tobytes()], "ids": [ids[order].tobytes()],
                         "labels": pa.array([labels], pa.list_(pa.string())), "codes": [codes[order].tobytes()]})
    return pack


def _first(s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    kept = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k]) if len(s) > 4 * k else np.arange(len(s))
    return kept[np.lexsort((ids[kept], ~s[kept]))[:k]]


def _positives_of(anchors: dict, candidates: dict, k: int) -> list[tuple]:
    """(anchor number, candidate id, score): of each anchor the k first candidates of its label."""
    out = []
    for code, label in enumerate(anchors["labels"]):
        own = np.flatnonzero(anchors["codes"] == code)
        if label not in candidates["labels"]:
            continue
        lo, hi = np.searchsorted(candidates["codes"], candidates["labels"].index(label) + np.arange(2))
        ids = candidates["ids"][lo:hi]
        for a in range(0, len(own), TOGETHER):
            some = own[a:a + TOGETHER]
            for i, s in zip(some, scores(anchors["vectors"][some], candidates["planes"][:, :, lo:hi])):
                other = np.flatnonzero(ids != anchors["ids"][i])
                best = other[_first(s[other], ids[other], k)] if len(other) else other
                out += [(anchors["numbers"][i], int(ids[j]), int(s[j])) for j in best]
    return out


def limits_of(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole numbers x with low * score <= 100 * x <= high * score, as the first and the last."""
    return -(-low * score // 100), high * score // 100


def _negatives_of(anchors: dict, candidates: dict, k: int, low: int, high: int) -> list[tuple]:
    """(anchor number, position of the positive, candidate id, score): the k first candidates of other labels within the limits."""
    out = []
    ids, codes = candidates["ids"], candidates["codes"]
    for a in range(0, len(anchors["ids"]), TOGETHER):
        for i, s in enumerate(scores(anchors["vectors"][a:a + TOGETHER], candidates["planes"]), a):
            spans = [limits_of(p, low, high) for p in anchors["positives"][i]]
            least, most = min(x for x, _ in spans), max(y for _, y in spans)
            label = anchors["labels"][anchors["codes"][i]]
            ok = (s >= max(least, LONG[0])) & (s <= min(most, LONG[1]))
            if label in candidates["labels"]:
                ok &= codes != candidates["labels"].index(label)
            some = np.flatnonzero(ok)
            some = some[np.lexsort((ids[some], ~s[some]))]
            falling = ~s[some].astype(np.int64)
            for p, (x, y) in enumerate(spans):
                begin = np.searchsorted(falling, ~min(y, LONG[1]), "left")
                end = min(begin + k, np.searchsorted(falling, ~max(x, LONG[0]), "right"))
                out += [(anchors["numbers"][i], p, int(ids[j]), int(s[j])) for j in some[begin:end]]
    return out


def _held(table: pa.Table, width: int) -> tuple[dict, dict] | None:
    """The anchors and the candidates of a tile."""
    side = {bool(x): i for i, x in enumerate(table.column("is_anchor").to_pylist())}
    if len(side) < 2:
        return None
    a, c = ({n: table.column(n)[i].as_py() for n in table.column_names} for i in (side[True], side[False]))
    groups = max(1, -(-width // 8))
    anchors = {"vectors": whole_numbers(np.frombuffer(a["vectors"], np.float64).reshape(-1, width) if width else np.zeros((len(a["ids"]) // 8, 0))), "ids": np.frombuffer(a["ids"], np.int64),
               "numbers": np.frombuffer(a["numbers"], np.int64).tolist(), "labels": a["labels"], "codes": np.frombuffer(a["codes"], np.int64), "positives": a["positives"]}
    ids = np.frombuffer(c["ids"], np.int64)
    return anchors, {"planes": np.frombuffer(c["planes"], np.uint8).reshape(c["bits"], groups, len(ids)), "ids": ids, "labels": c["labels"], "codes": np.frombuffer(c["codes"], np.int64)}


ANCHOR_COLUMNS = "part int, vectors binary, numbers binary, ids binary, labels array<string>, codes binary, positives array<array<long>>"


def _pack_anchors(width: int):
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        labels, codes = _label_codes(table.column("label"))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "vectors": [_matrix(table.column("vec"), width).astype(np.float64).tobytes()], "numbers": [table.column("number").to_numpy().tobytes()],
                         "ids": [table.column("id").to_numpy().tobytes()], "labels": pa.array([labels], pa.list_(pa.string())), "codes": [codes.tobytes()],
                         "positives": pa.array([table.column("positives").to_pylist()], pa.list_(pa.list_(pa.int64())))})
    return pack


def _tiles(anchors: DataFrame, slices: DataFrame, parts: int, count: int, width: int, search, schema: str) -> DataFrame:
    """Every block of anchors with every slice of candidates, searched."""
    packed = anchors.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int")).groupBy("part").applyInArrow(_pack_anchors(width), ANCHOR_COLUMNS)
    left = written(packed, "anchors").withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).withColumn("is_anchor", F.lit(True))
    right = slices.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("is_anchor", F.lit(False))

    def meet(table: pa.Table) -> pa.Table:
        held = _held(table, width)
        found = search(*held) if held else []
        names = [c.split(" ")[0] for c in schema.split(", ")]
        columns = list(zip(*found)) if found else [()] * len(names)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, columns)})

    return left.unionByName(right, allowMissingColumns=True).groupBy("part", "slice").applyInArrow(meet, schema)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors, the rows whose id is
    divisible by ``every``.

    An anchor's positives are the first ``positives`` rows of its label with another id, by falling score, ties to the
    smaller id. For each the first ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the
    positive's are returned, ranked from 1; a positive without any, as one with a negative score, gives no row.

    Rows with a NULL id, label or vector, or a component that is NULL, NaN, infinite or overflows when scaled take no
    part; equal rows count once. Vectors of different length are compared as if filled with zeros. Scores beyond a long are
    set to the nearest long. Labels are compared as text. Other columns are not read; an empty table gives no rows.
    """
    spark = rows.sparkSession
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * F.lit(float(scale)))
    rounded = F.transform(scaled, lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double") + F.lit(0.0)).otherwise(x))
    fine = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    plain = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.when(fine, rounded).alias("vec"))
    taken = written(plain.where("id is not null and label is not null and vec is not null").distinct().withColumn("number", F.monotonically_increasing_id()), "rows")
    n, width, asked = taken.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.count_if(F.pmod("id", F.lit(every)) == 0)).first()
    width = width or 0
    parts = max(1, -(-asked // ANCHORS))
    # Slices as large as memory allows, but enough tiles for all cores.
    count = max(1, -(-n // SLICE), min(-(-n // LEAST), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) // parts))
    slices = taken.withColumn("slice", F.pmod(F.xxhash64("id", "label", "vec"), F.lit(count)).cast("int")).groupBy("slice").applyInArrow(
        _pack_slice(width), "slice int, bits int, planes binary, ids binary, labels array<string>, codes binary")
    slices = written(slices, "slices")

    anchors = taken.where(F.pmod("id", F.lit(every)) == 0)
    unknown = anchors.withColumn("positives", F.array().cast("array<long>"))
    near = _tiles(unknown, slices, parts, count, width, lambda a, c: _positives_of(a, c, positives), "number long, positive_id long, score long")
    best = W.partitionBy("number").orderBy(F.col("score").desc(), "positive_id")
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
    known = near.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("n", "positive_id", "score"))).alias("found"))
    known = written(anchors.join(known, "number").withColumn("positives", F.col("found.score")), "positives")

    far = _tiles(known.select("number", "id", "label", "vec", "positives"), slices, parts, count, width, lambda a, c: _negatives_of(a, c, negatives, low, high),
                 "number long, at long, negative_id long, negative_score long")
    best = W.partitionBy("number", "at").orderBy(F.col("negative_score").desc(), "negative_id")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    positive = F.get("found", F.col("at").cast("int"))
    return far.join(known.select("number", F.col("id").alias("anchor_id"), "found"), "number").select(
        "anchor_id", positive["positive_id"].alias("positive_id"), "rank", "negative_id", positive["score"].alias("positive_score"), "negative_score")
