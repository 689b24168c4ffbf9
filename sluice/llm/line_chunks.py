"""Line dedup by content-defined chunks, in SQL functions only.

A text is cut into lines at ``\\n``, each with a 32-bit hash (of its md5). Two rolling hashes combine neighbours: one a line with
the line before, one the two lines that follow it. Each bit of either is a chunking of its own: a chunk ends after a line
whose bit is 0, and at the end of the text. A border depends on two or three lines only, so insertions shift no borders
beyond the next ones, and shared passages have the same chunks wherever they stand. Several chunkings are judged together, because
one alone leaves what lies between its last border and the edge of a passage; looking back finds the ends of passages,
looking ahead their beginnings.

A chunk of at least ``min_lines`` lines that any chunking also has elsewhere is removed, all but the first occurrence by
(id, line); a line goes with any of its chunks. Its content is kept where it stands first: each removal points to a
smaller (id, line). Chunks are found by two 64-bit hashes over their lines, and the lines of all that repeat are compared
by bytes: different lines that share their hashes stay.

Cost: two chunks a line, 48 bytes each, cross the network; texts cross it once, and the lines of repeated chunks once more.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

FACTOR = 31
PACK = 1 << 31  # first line and number of lines of a chunk in one number


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def line_keys(line: Column) -> Column:
    """Two hashes that stand for a line until its bytes are compared."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def chunks_of(text: Column, chunkings: int, min_lines: int) -> Column:
    """array<struct<at:int, n:int, k1:bigint, k2:bigint>>: the chunks of all chunkings from ``min_lines`` lines on, each place once."""
    def at(hashes: Column, i: Column) -> Column:
        return F.coalesce(F.get(hashes, i), F.lit(0))

    def rolled(hashes: Column) -> Column:
        back = F.transform(hashes, lambda h, i: h + at(hashes, i - 1) * FACTOR)
        ahead = F.transform(hashes, lambda h, i: at(hashes, i + 1) + at(hashes, i + 2) * FACTOR)
        return F.array(back, ahead)

    def spans(rolls: Column, c: Column) -> Column:
        last = F.size(rolls[0]) - 1
        values = F.get(rolls, c % 2)
        inner = F.filter(F.sequence(F.lit(0), last), lambda i: (i < last) & (F.getbit(F.get(values, i), F.floor(c / 2).cast("int")) == 0))
        return _let(F.concat(inner, F.array(last)), lambda ends: F.filter(
            F.transform(ends, lambda end, j: _let(F.coalesce(F.get(ends, j - 1), F.lit(-1)), lambda before: (before + 1).cast("long") * PACK + (end - before))),
            lambda s: s % PACK >= min_lines))

    def keyed(keys: Column, rolls: Column) -> Column:
        def one(at: Column, n: Column) -> Column:
            return F.struct(at.alias("at"), n.alias("n"), *[F.xxhash64(F.slice(keys[part], at + 1, n)).alias(name) for part, name in (("a", "k1"), ("b", "k2"))])
        places = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(chunkings - 1)), lambda c: spans(rolls, c))))
        return F.transform(places, lambda s: one(F.shiftright(s, 31).cast("int"), (s % PACK).cast("int")))

    # One array for each hash: a field of an array of structs would be a new array for every chunk.
    def keys_of(pairs: Column) -> Column:
        return F.struct(*[F.transform(pairs, lambda k: k[part]).alias(part) for part in ("a", "b")])  # noqa: B023

    return _let(lines_of(text), lambda lines: _let(_let(F.transform(lines, line_keys), keys_of), lambda keys: _let(
        _let(F.transform(lines, line_hash), rolled), lambda rolls: keyed(keys, rolls))))


def lines_deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunkings: int = 12, min_lines: int = 2) -> DataFrame:
    """(id, n_lines, n_removed, text) for every row, without the lines of repeated chunks.

    What is left of a text is joined by line ends. A NULL text has no lines and stays NULL; an empty one has one empty
    line. Rows with one id count as one document: a chunk is its own first occurrence there. Rows with a NULL id are left
    as they are and remove nothing. Ids need an order. ``chunkings`` (up to 64) alternate between looking back and ahead.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version"))
    key, place = ["k1", "k2"], F.struct("id", "at")
    seen = written(plain.where("id is not null and text is not null").select("id", "version", F.explode(chunks_of(F.col("text"), chunkings, min_lines)).alias("c"))
                   .select("id", "version", "c.*"), "chunks")
    again = written(seen.groupBy(*key).agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first")).where("times > 1").select(*key, "first"), "again")
    spans = (seen.join(again, key).groupBy("id", "version").agg(
        F.collect_set(F.struct("at", "n", (place != F.col("first")).alias("later"))).alias("spans")))

    def covered(found: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(found, lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1))))

    spans = spans.select("id", "version", covered(F.col("spans")).alias("shared"), covered(F.filter("spans", lambda s: s["later"])).alias("gone"))
    joined = written(plain.join(spans, ["id", "version"], "left"), "joined")

    # Equal hashes stand for equal lines unless two texts are found for them.
    lines = joined.where("shared is not null").select(F.explode(F.array(lines_of(F.col("text")))).alias("lines"), "shared").select(
        F.explode(F.transform("shared", lambda i: F.get("lines", i))).alias("line"))
    unlike = written(lines.distinct().select(line_keys(F.col("line")).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "unlike")
    if unlike.count():
        at = joined.where("gone is not null").select("id", "version", F.explode(F.array(lines_of(F.col("text")))).alias("lines"), "gone").select(
            "id", "version", F.explode(F.transform("gone", lambda i: F.struct(i.alias("at"), line_keys(F.get("lines", i)).alias("k")))).alias("x"))
        sure = at.select("id", "version", "x.*").join(unlike, "k", "left_anti").groupBy("id", "version").agg(F.collect_set("at").alias("gone"))
        joined = joined.drop("gone").join(sure, ["id", "version"], "left")

    def left(all_lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n")

    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines_of(F.col("text")))).cast("long")
    some = F.col("gone").isNotNull() & (F.size("gone") > 0)
    return joined.select(F.col("id").alias(id_col), n_lines.alias("n_lines"), F.when(some, F.size("gone")).otherwise(0).cast("long").alias("n_removed"),
                         F.when(some, _let(lines_of(F.col("text")), left)).otherwise(F.col("text")).alias(text_col))
