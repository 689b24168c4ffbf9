"""One query per operator with its production parameters, over whole tables, and SQL where SQL can say it."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import configure
from .alignment import token_alignment
from .block_anchors import repeats_removed
from .byte_cnn import quality
from .decontaminate import contamination
from .four_russians import hard_negatives
from .line_chunks import lines_deduplicated
from .mixing import mixing_plan
from .multiset_hash import edited_fingerprints
from .ngram_join import similar_components
from .norm_buckets import top_k
from .sharding import balanced_shards
from .toxic_segments import toxicity
from .training_order import training_order


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def op1_training_order(spark: SparkSession, sf: str) -> DataFrame:
    return training_order(table(spark, sf, "documents"), length=2048, key=1)


def op2_norm_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"), k=20, every=20, scale=64)


def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10)


def op4_byte_cnn(spark: SparkSession, sf: str) -> DataFrame:
    return quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_line_chunks(spark: SparkSession, sf: str) -> DataFrame:
    found = lines_deduplicated(table(spark, sf, "documents"), chunkings=12, min_lines=2)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing_plan(table(spark, sf, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op7_block_anchors(spark: SparkSession, sf: str) -> DataFrame:
    return repeats_removed(table(spark, sf, "documents"), width=13, digest=True)


def op8_label_propagation(spark: SparkSession, sf: str) -> DataFrame:
    return balanced_shards(table(spark, sf, "documents"), shards=16)


def op9_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return similar_components(table(spark, sf, "documents"), width=4, percent=85)


def op10_toxic_segments(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")).drop("passages")


def op11_multiset_hash(spark: SparkSession, sf: str) -> DataFrame:
    found = edited_fingerprints(table(spark, sf, "documents"))
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op12_four_russians(spark: SparkSession, sf: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf, "embeddings").withColumn("label", shifted), every=100, positives=5, negatives=10, low=30, high=90, scale=256)


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return token_alignment(table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (op1_training_order, op2_norm_buckets, op3_decontaminate, op4_byte_cnn, op5_line_chunks, op6_mixing, op7_block_anchors, op8_label_propagation, op9_ngram_join, op10_toxic_segments,
                                  op11_multiset_hash, op12_four_russians, op13_alignment)}
