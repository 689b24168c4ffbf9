"""Similarity join on sets of word n-grams by vertical partitioning, and the components of its links.

The set of a document is its distinct runs of ``width`` words (a shorter text is one run, a text without words is
empty). Two documents link if ``100 * |intersection| >= percent * |union|``.

1. Every text becomes a set of 64-bit run hashes. Equal sets have one *node* (a 64-bit sum over the set). A node leaves a
   piece of text once, however many copies the piece has.
2. The hashes go to range buckets as packed sorted lists with node numbers beside them. A bucket counts the nodes of
   each hash. This gives the global order: rare n-grams first, then by hash. N-grams of one node alone are counted and go
   no further; a node that shares fewer than ``percent`` of its n-grams has no partner at all and leaves.
   *Frequent* n-grams go to no range bucket, because one hash cannot be split: pieces count the nodes of each hash, the sums
   of these partial counts name the hashes, and their entries are dealt by node. The sum stands for the count in the
   order (a node counts once per piece there), which any fixed number would do.
3. Partners must share an n-gram of their prefixes. Each prefix n-gram links its nodes in a star, not pairwise;
   the components of these stars are the candidate groups. Large groups are divided by set size (partners differ by a
   bounded factor) and into cells of bounded size; small groups are put together. Two cells make a tile.
4. The global order is cut into fragments of equal weight. Each (tile, fragment) is a task's group that counts the
   overlaps inside its fragment alone, as a matrix product; the partial counts of a tile travel packed, are summed per
   pair, compared with the limit, and each tile keeps a spanning forest of its links. No link between different texts
   is lost: dropped ones join nodes that the forest joins.

Cost: within one candidate group all size-compatible tiles are counted, quadratic in a group whose members share rare
n-grams without being equal. Two different runs with one 64-bit hash would count as one.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import written
from .components import components
from .words import (SPACED, bucket_count, bucket_slices, lower_ascii, member, mix, order_pairs, pack, pack_small, pieces, run_starts, unpack,
                    unpack_small, whole, windows, word_hashes, words_of)

CELL = 256
SMALL_GROUP = 64
FRAGMENTS = 8
#: A piece reports hashes that at least so many of its nodes have; a hash whose reports reach the limit below is frequent.
REPORTED = 4
FREQUENT = 4096


def _sets(column: pa.Array, width: int, lower: bool) -> Iterator[tuple]:
    """Per piece: the piece, distinct (hash, row) sorted by hash, set sizes and set sums per row."""
    for piece in pieces(column):
        data = lower_ascii(piece.data) if lower else piece.data
        words = words_of(data, piece.offsets, SPACED)
        hashes = word_hashes(data, words)
        counts = np.diff(words.firsts)
        starts = whole(words, width)
        at, value = [starts], [windows(hashes, width)[starts]]
        for m in range(1, width):
            firsts = words.firsts[:-1][counts == m]
            at.append(firsts)
            value.append(mix(windows(hashes, m)[firsts] + np.uint64(m)))
        at, value = np.concatenate(at), np.concatenate(value)
        rows = words.rows()[at]
        order = order_pairs(value, rows)
        h, r = value[order], rows[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        h, r = h[keep], r[keep]
        n_rows = piece.hi - piece.lo
        sizes = np.bincount(r, minlength=n_rows)
        by_row = np.argsort(r, kind="stable")
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(h[by_row] + np.uint64(width)))])
        ends = np.cumsum(sizes)
        node = mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64))
        yield piece, h, r, sizes, node.view(np.int64)


def _by_node(h: np.ndarray, r: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A piece's (hash, row) pairs without copies: hashes ascending, the place of each one's node, the nodes ascending."""
    nodes, one, place = np.unique(node.view(np.uint64), return_index=True, return_inverse=True)
    first = one[place[r]] == r
    return h[first], place[r[first]], nodes


def shingle_stats(docs: DataFrame, id_col: str, text_col: str, width: int, lower: bool) -> DataFrame:
    """(id, n_shingles, node, common, times) of every row. A piece's first row carries the hashes that many of the piece's
    nodes have, and of how many; elsewhere these lists are NULL."""
    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, h, r, sizes, node in _sets(batch.column(1), width, lower):
                found, times = np.unique(_by_node(h, r, node)[0], return_counts=True)
                found, times = found[times >= REPORTED], times[times >= REPORTED]
                others = [None] * (len(sizes) - 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(piece.lo, piece.hi - piece.lo), pa.array(sizes.astype(np.int64)),
                                                  pa.array(node, mask=sizes == 0), pa.array([found.view(np.int64), *others], pa.list_(pa.int64())),
                                                  pa.array([times.astype(np.int32), *others], pa.list_(pa.int32()))], names=["id", "n_shingles", "node", "common", "times"])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_shingles", T.LongType()), T.StructField("node", T.LongType()),
                           T.StructField("common", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(stats, schema)


def frequent_hashes(stats: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes ascending that very many nodes have, and the sums of their reports.

    A hash that is not among them has fewer entries than the limit and ``REPORTED`` for each piece. As the reports add up
    to ``total`` at most, no more than 2^17 hashes (or ``total / FREQUENT``, if less) reach the limit.
    """
    n_pieces = stats.where("common is not null").count()
    limit = max(FREQUENT, REPORTED * n_pieces, total >> 17)
    reports = stats.where("common is not null").select(F.explode(F.arrays_zip("common", "times")).alias("x"))
    sums = reports.groupBy(F.col("x.common").alias("hash")).agg(F.sum("x.times").alias("n")).where(F.col("n") >= limit).toArrow()
    h, n = sums.column("hash").to_numpy().view(np.uint64), sums.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], np.minimum(n[order], 2**31 - 1).astype(np.int32)


def _hash_lists(docs: DataFrame, text_col: str, width: int, lower: bool, buckets: int, frequent: np.ndarray = np.zeros(0, np.uint64)) -> DataFrame:
    """Packed (hash, node) pairs: by ranges of hashes, and those of frequent hashes by ranges of nodes under negative buckets."""
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, h, r, _, node in _sets(batch.column(0), width, lower):
                out = {"bucket": [], "nodes": [], "hashes": [], "rows": []}
                h, place, nodes = _by_node(h, r, node)
                hot = member(h, frequent)
                hot_h, hot_place, h, place = h[hot], place[hot], h[~hot], place[~hot]
                groups = [(bucket, h[a:b], place[a:b]) for bucket, a, b in bucket_slices(h, buckets)]
                if len(hot_h):
                    of = (nodes[hot_place] % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(of, kind="stable")
                    cuts = np.flatnonzero(np.diff(of[order], prepend=-1))
                    groups += [(-1 - int(of[x[0]]), hot_h[x], hot_place[x]) for x in np.split(order, cuts[1:])]
                for bucket, hashes, at in groups:
                    used, local = np.unique(at, return_inverse=True)
                    out["bucket"].append(bucket)
                    out["nodes"].append(pack(nodes[used]))
                    out["hashes"].append(pack(hashes))
                    out["rows"].append(pack_small(local))
                yield pa.RecordBatch.from_pydict(out, pa.schema([("bucket", pa.int32()), ("nodes", pa.binary()), ("hashes", pa.binary()), ("rows", pa.binary())]))
    return docs.select(F.col(text_col).alias("text")).mapInArrow(lists, "bucket int, nodes binary, hashes binary, rows binary")


def _distinct(h: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((v, h))
    h, v = h[order], v[order]
    new = run_starts(h, v)
    return h[new], v[new]


def _shared_of(frequent: np.ndarray, times: np.ndarray):
    def shared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Of one bucket: for each node its hashes that other nodes have, too, and the number of nodes of each."""
        h = np.concatenate([unpack(x.as_py()) for x in table.column("hashes")])
        v = np.concatenate([unpack(n.as_py())[unpack_small(r.as_py())] for n, r in zip(table.column("nodes"), table.column("rows"))])
        if key[0].as_py() < 0:
            h, v = _distinct(h, v)
            df = times[np.searchsorted(frequent, h)]
        else:
            order = np.argsort(h)
            h, v = h[order], v[order]
            twice = np.zeros(len(h) + 1, bool)
            twice[1:-1] = h[1:] == h[:-1]
            twice = twice[1:] | twice[:-1]
            h, v = _distinct(h[twice], v[twice])
            df = np.diff(np.append(run_starts(h), len(h)))
            df = np.repeat(df, df)
            h, v, df = h[df > 1], v[df > 1], df[df > 1]
        order = np.argsort(v, kind="stable")
        h, v, df = h[order], v[order], df[order]
        cuts = run_starts(v)
        offsets = pa.array(np.append(cuts, len(v)).astype(np.int32))
        return pa.table({"node": pa.array(v[cuts].view(np.int64)), "hashes": pa.ListArray.from_arrays(offsets, pa.array(h.view(np.int64))),
                         "counts": pa.ListArray.from_arrays(offsets, pa.array(df.astype(np.int32)))})
    return shared


def least_overlap(n: Column, percent: int) -> Column:
    """The smallest overlap that any partner of a set of ``n`` must have."""
    return F.ceil(n * percent / F.lit(100.0) - 1e-9)


def _pair_counts(tokens: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common tokens of documents of one group: for pairs (i < j) with any, the number. One row per pair of equal tokens."""
    order = np.lexsort((doc, tokens, group))
    t, g, d = tokens[order], group[order], doc[order]
    if not len(t):
        none = np.zeros(0, np.int64)
        return none, none, none
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (g[1:] != g[:-1])])
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(t))
    last = np.repeat(ends, ends - begins)
    after = last - np.arange(len(t)) - 1
    left = np.repeat(np.arange(len(t)), after)
    right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
    pair, count = np.unique(d[left].astype(np.int64) << 32 | d[right], return_counts=True)
    return pair >> 32, pair & 0xFFFFFFFF, count


def _partial(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Overlaps of a unit's documents inside one fragment of the global order."""
    nodes, sizes = table.column("node").to_numpy(), table.column("n_shingles").to_numpy()
    side, group = table.column("side").to_numpy(), table.column("grp").to_numpy()
    order = np.lexsort((nodes, side))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    lists = table.column("segment").combine_chunks()
    tokens = lists.flatten().to_numpy()
    doc = np.repeat(rank, np.diff(lists.offsets.to_numpy()))
    if str(key[0]).startswith("s"):
        i, j, count = _pair_counts(tokens, group[order][doc], doc)
    else:
        # Columns of the indicator matrix in slices, so that it stays small however many tokens the fragment has.
        names, column = np.unique(tokens, return_inverse=True)
        left = int((side == 0).sum())
        two = left < len(order)
        total = np.zeros((left, len(order) - left if two else left), np.float32)
        for lo in range(0, len(names), 4096):
            here = (column >= lo) & (column < lo + 4096)
            m = np.zeros((len(order), 4096), np.float32)
            m[doc[here], column[here] - lo] = 1
            total += m[:left] @ (m[left:] if two else m).T
        if not two:
            total = np.triu(total, 1)
        i, j = np.nonzero(total)
        count = total[i, j]
        j = j + left if two else j
    return pa.table({"unit": [str(key[0])], "nodes": [nodes[order].tobytes()], "sizes": [sizes[order].tobytes()],
                     "i": [pack_small(i)], "j": [pack_small(j)], "k": [pack_small(count)]})


def _links_of(percent: int):
    def links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Sums a unit's partial counts per pair; a spanning forest of the pairs that reach the limit."""
        nodes = np.frombuffer(table.column("nodes")[0].as_py(), np.int64)
        sizes = np.frombuffer(table.column("sizes")[0].as_py(), np.int64)
        i, j, k = (np.concatenate([unpack_small(x.as_py()) for x in table.column(c)]).astype(np.int64) for c in "ijk")
        pair, where = np.unique(i << 32 | j, return_inverse=True)
        total = np.bincount(where, weights=k, minlength=len(pair)).astype(np.int64)
        i, j = pair >> 32, pair & 0xFFFFFFFF
        linked = 100 * total >= percent * (sizes[i] + sizes[j] - total)
        root = list(range(len(nodes)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        kept = []
        for x, y in zip(i[linked].tolist(), j[linked].tolist()):
            a, b = find(x), find(y)
            if a != b:
                root[max(a, b)] = min(a, b)
                kept.append((x, y))
        kept = np.array(kept, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(nodes[kept[:, 0]]), "b": pa.array(nodes[kept[:, 1]])})
    return links


def node_links(docs: DataFrame, stats: DataFrame, text_col: str, width: int, percent: int, lower: bool) -> DataFrame:
    """Links between nodes, a spanning set of them: columns a, b."""
    total = stats.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = bucket_count(total, 2 << 20, 48)
    frequent, times = frequent_hashes(stats, total)
    lists = _hash_lists(docs, text_col, width, lower, buckets, frequent).groupBy("bucket")
    shared = lists.applyInArrow(_shared_of(frequent, times), "node long, hashes array<long>, counts array<int>")
    sizes = stats.where("n_shingles > 0").groupBy("node").agg(F.first("n_shingles").alias("n_shingles"))
    own = (shared.groupBy("node").agg(F.sum(F.size("hashes")).alias("n_shared"), F.collect_list(F.arrays_zip("counts", "hashes")).alias("tokens"))
           .join(sizes, "node").where(F.col("n_shared") >= least_overlap(F.col("n_shingles"), percent))
           .select("node", "n_shingles", "n_shared", F.sort_array(F.flatten("tokens")).alias("tokens")))
    own = written(own, "shared-ngrams")

    prefix = F.col("n_shingles") - least_overlap(F.col("n_shingles"), percent) + 1 - (F.col("n_shingles") - F.col("n_shared"))
    rare = own.select("node", F.explode(F.slice("tokens", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int"))).alias("t")).select("node", F.col("t.hashes").alias("hash"))
    pivots = rare.groupBy("hash").agg(F.min("node").alias("b"))
    stars = rare.join(pivots, "hash").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    groups = components(stars).withColumnRenamed("root", "grp")
    units = _units(written(own.join(groups, "node"), "candidates"), percent)

    order = "cast(t.counts as double) + cast(t.hashes as double) / 18446744073709551616D"
    cuts = own.select(F.explode("tokens").alias("t")).agg(
        F.percentile_approx(F.expr(order), [i / FRAGMENTS for i in range(1, FRAGMENTS)], 10_000)).first()[0] or []
    bounds = [None, *cuts, None]

    def segment(lo, hi):
        def inside(t):
            at = t["counts"].cast("double") + t["hashes"].cast("double") / F.lit(18446744073709551616.0)
            return (at >= lo if lo is not None else F.lit(True)) & (at < hi if hi is not None else F.lit(True))
        return F.transform(F.filter("tokens", inside), lambda t: t["hashes"])

    segments = F.array(*[segment(a, b) for a, b in zip(bounds, bounds[1:])])
    pieces_ = units.select("unit", "grp", "side", "node", "n_shingles", F.posexplode(segments).alias("fragment", "segment"))
    partial = pieces_.groupBy("unit", "fragment").applyInArrow(_partial, "unit string, nodes binary, sizes binary, i binary, j binary, k binary")
    return written(partial.groupBy("unit").applyInArrow(_links_of(percent), "a long, b long"), "links")


def _units(members: DataFrame, percent: int) -> DataFrame:
    """Deals candidate groups into units: many small groups together, large groups as tiles of two cells each."""
    counts = members.groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    small_docs = counts.where(F.col("members") <= SMALL_GROUP).agg(F.sum("members")).first()[0] or 0
    bins = max(64, -(-small_docs // CELL))
    sized = members.join(counts, "grp")
    small = (sized.where(F.col("members") <= SMALL_GROUP)
             .withColumn("unit", F.concat(F.lit("s"), F.pmod(F.xxhash64("grp"), F.lit(bins)).cast("string"))).withColumn("side", F.lit(0)))
    step = math.log(1 / (percent / 100 - 0.001))
    banded = sized.where(F.col("members") > SMALL_GROUP).withColumn("band", F.floor(F.log(F.col("n_shingles").cast("double")) / step))
    bands = banded.groupBy("grp", "band").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("cells"))
    celled = banded.join(bands, ["grp", "band"]).withColumn("cell", F.pmod(F.xxhash64("node"), F.col("cells")))
    other = bands.select("grp", F.col("band").alias("band2"), F.col("cells").alias("cells2"))
    first = bands.withColumn("band2", F.explode(F.array(F.col("band"), F.col("band") + 1))).join(other, ["grp", "band2"])
    tiles = first.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1))).withColumn(
        "cell2", F.explode(F.sequence(F.when(F.col("band") == F.col("band2"), F.col("cell")).otherwise(F.lit(0).cast("long")), F.col("cells2") - 1)))
    name = F.concat_ws("-", F.lit("t"), "grp", "band", "cell", "band2", "cell2")
    sides = tiles.select("grp", name.alias("unit"), F.explode(F.when((F.col("band") == F.col("band2")) & (F.col("cell") == F.col("cell2")), F.array(
        F.struct(F.lit(0).alias("side"), "band", "cell"))).otherwise(F.array(F.struct(F.lit(0).alias("side"), "band", "cell"),
        F.struct(F.lit(1).alias("side"), F.col("band2").alias("band"), F.col("cell2").alias("cell"))))).alias("s")).select("grp", "unit", "s.*")
    large = celled.join(sides, ["grp", "band", "cell"])
    columns = ["unit", "grp", "side", "node", "n_shingles", "tokens"]
    return small.select(*columns).unionByName(large.select(*columns))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, lower: bool = True) -> DataFrame:
    """(id, n_shingles, component_id) for every row; component_id is the smallest id reachable by links.

    ``lower`` folds A-Z. A NULL or empty text has no n-grams: size 0, its own component. Rows with a NULL id take part;
    their component has the smallest id that is not NULL, or NULL. Repeated rows come back repeated. Other columns of
    ``docs`` are not looked at. An empty table gives an empty one.
    """
    stats = written(shingle_stats(docs, id_col, text_col, width, lower), "shingle-stats")
    roots = components(node_links(docs, stats, text_col, width, percent, lower))
    known = stats.select("id", "n_shingles", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.where("node is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    return (known.join(least, "root", "left").select(F.col("id").alias(id_col), "n_shingles",
            F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
