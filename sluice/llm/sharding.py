"""Shards of near equal size that keep linked documents together, by balanced label propagation.

Documents with equal texts are linked. Every linked document starts in a shard of its own choice (a hash of its id). In
each round a group's members are counted per shard, members elsewhere ask to move to the shard that has most of them,
and the requests are granted in the order of their gain until the shard's quota of bytes is used up (after Ugander and
Backstrom 2013). A group that is larger than a shard is thus spread over as few as possible. Documents without links,
and what the limits leave over, then fill every shard up to its target.

Counts per (group, shard) are at most as many rows per group as there are shards; members of a hot group are moved by a
join on the group, never gathered.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import local_table, written
from .running import running

STEPS = 16  # size classes for each doubling


def _share(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) / F.lit(float(1 << 20))


def _loads(df: DataFrame, shards: int) -> list[int]:
    found = dict(df.groupBy("shard").agg(F.sum("size")).collect())
    return [int(found.get(s) or 0) for s in range(shards)]


def _starts(amounts: list[int]) -> list[int]:
    out, total = [], 0
    for a in amounts:
        out.append(total)
        total += a
    return out


def _pick(values: list, index: Column, kind: str) -> Column:
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), index.cast("int"))


def propagate(linked: DataFrame, shards: int, capacity: int, rounds: int) -> DataFrame:
    """``linked`` (node, grp, size) with ``shard`` after balanced label propagation."""
    state = written(linked.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")), "labels")
    for round_ in range(rounds):
        counts = written(state.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")), "counts")
        loads = _loads(counts, shards)
        best = counts.groupBy("grp").agg(F.max(F.struct("n", F.xxhash64("grp", "shard").alias("h"), "shard")).alias("best")).select("grp", F.col("best.n").alias("most"), F.col("best.shard").alias("to"))
        asked = counts.join(best, "grp").where("shard <> to").withColumn("gain", F.col("most") - F.col("n"))
        queued = running(asked, [F.col("to"), -F.col("gain"), F.col("grp"), F.col("shard")], "size", "upto")
        wanted = dict(asked.groupBy("to").agg(F.sum("size")).collect())
        if not wanted:
            break
        starts = _starts([int(wanted.get(s) or 0) for s in range(shards)])
        quota = [max(0, capacity - load) for load in loads]
        before = F.col("upto") - F.col("size") - _pick(starts, F.col("to"), "long")
        granted = F.greatest(F.lit(0), F.least(F.col("size"), _pick(quota, F.col("to"), "long") - before)) / F.col("size")
        moves = queued.select("grp", "shard", "to", granted.alias("granted")).where("granted > 0")
        moved = state.join(moves, ["grp", "shard"], "left")
        goes = F.col("to").isNotNull() & (_share("node", F.lit(round_)) < F.col("granted"))
        state = written(moved.select("node", "grp", "size", F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard")), "labels")
    return state


def _cuts(counts: list[tuple[int, int]], shares: tuple[float, ...]) -> list[int]:
    """The steps up to which there are these shares of all rows, from (step, rows) in order."""
    total, upto, steps = sum(n for _, n in counts), 0, []
    for step, n in counts:
        upto += n
        steps += [step] * sum(upto >= share * total for share in shares[len(steps):])
    return steps or [0] * len(shares)


def _filled(pool: DataFrame, loads: list[int], total: int, shards: int) -> DataFrame:
    """Gives each row of ``pool`` (node, order, size) the shard whose gap holds the middle of its bytes in running order.

    Large documents go first, into gaps scaled to their share of the pool, and small ones last, so that what is left
    uneven at the borders of the gaps is about the size of a small document.
    """
    pool = pool.withColumn("step", F.floor(F.log2("size") * STEPS).cast("int"))
    cuts = _cuts(sorted(map(tuple, pool.groupBy("step").count().collect())), (0.3, 0.9))
    bounds = [total * (s + 1) // shards - total * s // shards for s in range(shards)]
    loads, parts = list(loads), []
    classes = [F.col("step") > cuts[1], F.col("step").between(cuts[0] + 1, cuts[1]), F.col("step") <= cuts[0]]
    sums = pool.agg(*[F.coalesce(F.sum(F.when(c, F.col("size"))), F.lit(0)) for c in classes]).first()
    for k, chosen in enumerate(classes):
        gaps = [max(0, b - load) for b, load in zip(bounds, loads)]
        room = sum(gaps) or 1
        ends = [(a + g) * sums[k] / room for a, g in zip(_starts(gaps), gaps)]
        placed = running(pool.where(chosen), [F.col("order"), F.col("node")], "size", "upto")
        middle = F.col("upto") - F.col("size") / 2
        found = F.aggregate(F.array(*[F.lit(float(e)) for e in ends[:-1]]), F.lit(0), lambda s, e: s + (middle > e).cast("int"))
        parts.append(written(placed.select("node", "size", found.alias("shard")), "filled"))
        loads = [a + b for a, b in zip(loads, _loads(parts[-1], shards))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("node", "shard")


def balanced_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, rounds: int = 6) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    ``size`` is the text's bytes in UTF-8, none for NULL, plus 1. Law ``bytes``: shards differ by about one document.
    ``slot`` counts a shard's rows from 0 in the order of ids, NULL last. Rows with NULL texts have no links and a NULL
    checksum; empty texts are equal texts. Repeated rows are rows like others. ``grown_shard`` is always NULL. The result
    depends on ids and texts only, not on partitions.
    """
    plain = docs.select(F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
                        F.crc32(F.encode(text_col, "UTF-8")).alias("text_crc32"), F.sha2(F.encode(text_col, "UTF-8"), 256).alias("grp"))
    # Rows are numbered by id and text; only rows equal in both, which may change places, are told apart by where they stand.
    order = [F.xxhash64(F.col("id").cast("string"), "grp"), F.col("id"), F.col("grp"), F.monotonically_increasing_id()]
    nodes = written(running(plain.withColumn("one", F.lit(1).cast("long")), order, "one", "node").drop("one"), "nodes")
    total = int(nodes.agg(F.sum("size")).first()[0] or 0)
    capacity = total // shards
    groups = nodes.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("grp")
    linked = propagate(nodes.join(groups, "grp").select("node", "grp", "size"), shards, capacity, rounds)

    # What stands beyond a shard's share joins the documents without links; a group's members stay neighbours there.
    ordered = running(linked, [F.col("shard"), F.col("grp"), F.col("node")], "size", "upto")
    starts = _starts(_loads(linked, shards))
    over = (F.col("upto") - _pick(starts, F.col("shard"), "long")) > capacity
    settled = written(ordered.select("node", "grp", "size", F.when(over, None).otherwise(F.col("shard")).alias("shard")), "settled")
    kept = settled.where("shard is not null")
    pool = nodes.join(kept, "node", "left_anti").join(groups.withColumn("linked", F.lit(1)), "grp", "left")
    order = F.when(F.col("linked").isNull(), F.concat(F.lit("1"), F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))).otherwise(F.concat(F.lit("0"), F.col("grp")))
    rest = _filled(pool.select("node", "size", order.alias("order")), _loads(kept, shards), total, shards)
    placed = written(nodes.join(kept.select("node", "shard").unionByName(rest), "node").withColumn("one", F.lit(1).cast("long")), "placed")
    rows = dict(placed.groupBy("shard").count().collect())
    slotted = running(placed, [F.col("shard"), F.col("id"), F.col("node")], "one", "rank")
    first = _starts([rows.get(s, 0) for s in range(shards)])
    return slotted.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                          (F.col("rank") - 1 - _pick(first, F.col("shard"), "long")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
