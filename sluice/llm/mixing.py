"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in seeded order, repeated ``max_epochs`` times. A document's virtual finish time
is the source's words up to and including it, divided by the source's weight. Taking documents in the order of finish
times until the budget is spent gives every source words in proportion to its weight; a source that runs dry leaves its
share to the others, which is what the targets say.

Sources, documents and finish times are sorted by range over all tasks (:mod:`running`); the driver sees one sum per range,
the water level's two sums per step, and the last document taken.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .running import running

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def _level(sources: DataFrame, budget: int, max_epochs: int) -> float:
    """The level v at which the sources' min(weight * v, max_epochs * size) add up to the budget."""
    level = -1.0
    cap = F.col("source_size") * max_epochs
    while True:
        full = F.col("weight") * F.lit(level) > cap
        spent, weight = sources.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if not weight:
            return level
        new = float(budget - spent) / float(weight)
        if new <= level:
            return level
        level = new


def mixing_plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", cycle: tuple[int, ...] = (1, 2, 3),
                max_epochs: int = 3, seed: int = 6) -> DataFrame:
    """(id, source, text_md5, size, source_size, target, epochs, taken) for every row of ``docs``.

    ``size`` is the number of words, 0 for NULL. Sources are weighted by ``cycle`` in the order of code points, NULL last.
    The budget is the sum of all sizes. ``target`` is the source's share, at most ``max_epochs`` times its size, with the
    excess shared out again by weight. ``epochs`` says how often the document is taken. The order depends on seed and id
    alone, so reruns agree; rows with one id are ordered by size, and only rows equal in id, source and size may
    swap their counts. An empty table gives an empty one.
    """
    sized = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.md5(text_col).alias("text_md5"),
                                word_count(text_col).alias("size")).withColumn("tie", F.monotonically_increasing_id()), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    ranked = written(running(running(sources, [F.col("source")], "one", "rank"), [F.col("source")], "source_size", "source_end"), "sources")
    weights = F.array(*[F.lit(w) for w in cycle])
    ranked = ranked.withColumn("weight", F.get(weights, F.pmod(F.col("rank") - 1, F.lit(len(cycle))).cast("int")))
    budget = sized.agg(F.sum("size")).first()[0] or 0
    level = _level(ranked, budget, max_epochs)
    ranked = ranked.select(F.col("source").alias("_source"), "source_size", "weight", (F.col("source_end") - F.col("source_size")).alias("source_start"),
                           F.least(F.col("weight") * F.lit(level), (F.col("source_size") * max_epochs).cast("double")).alias("target"))

    shuffled = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
    queued = running(sized, [F.col("source"), shuffled, F.col("id"), F.col("size"), F.col("tie")], "size", "upto")
    queued = written(queued.join(ranked, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "queues")
    upto = F.col("upto") - F.col("source_start")

    def finish(epoch: Column) -> Column:
        return (upto + epoch * F.col("source_size")) / F.col("weight")

    turn = F.struct(F.col("finish"), F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"), F.col("epoch"),
                    F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.col("size"), F.col("tie"))
    epochs = queued.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(max_epochs)]))).withColumn("finish", finish(F.col("epoch")))
    turns = running(epochs.select("size", turn.alias("turn")), [F.col("turn")], "size", "spent")
    last = turns.where(F.col("spent") <= budget).agg(F.max("turn")).first()[0]
    if last is None:
        taken = F.lit(0)
    else:
        limit = F.struct(F.lit(last["finish"]), F.lit(last["no_source"]), F.lit(last["source"]), F.lit(last["epoch"]), F.lit(last["id"]), F.lit(last["size"]).cast("long"), F.lit(last["tie"]).cast("long"))
        taken = sum((_turn_at(e, finish) <= limit).cast("int") for e in range(max_epochs))
    return queued.select("id", "source", "text_md5", "size", "source_size", "target", taken.alias("epochs")).withColumn("taken", F.col("size") * F.col("epochs"))


def _turn_at(epoch: int, finish) -> Column:
    return F.struct(finish(F.lit(epoch)), F.col("source").isNull(), F.coalesce("source", F.lit("")), F.lit(epoch), F.coalesce(F.col("id").cast("string"), F.lit("")),
                    F.col("size"), F.col("tie"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **plan) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document as often as the plan takes it.

    Rows equal in id, source and text count as copies of one document.
    """
    times = (mixing_plan(docs, id_col, source_col, text_col, **plan).groupBy("id", "source", "text_md5").agg(F.sum("epochs").alias("times")).where("times > 0")
             .select(F.struct("id", "source", "text_md5").alias("_key"), "times"))
    key = F.struct(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.md5(text_col).alias("text_md5"))
    once = docs.select(key.alias("key"), F.struct("*").alias("row")).dropDuplicates(["key"])
    joined = once.join(times, F.col("key").eqNullSafe(F.col("_key"))).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return joined.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
