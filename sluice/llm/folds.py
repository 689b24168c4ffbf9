"""What the two classifiers share: the fold of a row, and a bounded sample of labelled rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(id_col: str) -> Column:
    """Rows that no training sees: crc32 of the id as text, modulo 5, is 0. A NULL id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents outside the held-out fold, drawn by the hash of their ids.

    The drawn ids are at most ``rows`` rows and the only thing broadcast. Rows without a label are no candidates; of an
    id with several labels the larger counts.
    """
    known = labels.where(~held_out(id_col) & F.col(label).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label"))
    drawn = known.orderBy(F.xxhash64("_id"), F.col("_id"), F.col("label").desc()).limit(rows).groupBy("_id").agg(F.max("label").alias("label"))
    return docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).join(F.broadcast(drawn), F.col("_doc") == F.col("_id")).select("text", "label")
