"""From raw documents to a sharded training mix: five stages, each one operator of ``sluice.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the documents are written as Parquet and
read again. All but the last stage return the columns of ``docs``. Stages accept NULLs in any column, empty texts, repeated
rows and empty tables; what each does with them stands with its function.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm.byte_cnn import good_documents
from sluice.llm.decontaminate import decontaminate
from sluice.llm.mixing import mixed
from sluice.llm.ngram_join import similar_components
from sluice.llm.sharding import balanced_shards
from sluice.session import configure, written

SHARDS = 16


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier scores below 0.3. It is fitted on labelled rows of these documents
    outside the held-out fold; without any, all documents stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return good_documents(docs, labels, threshold=0.3)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more on runs of five words, the one with the smallest id.

    Texts without words are similar to nothing and stay. Rows equal in id and text stay once. Rows with a NULL id are
    nobody's first and cannot be told apart: they stay, once per text.
    """
    found = similar_components(docs, width=5, percent=80)
    first = found.where(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).select(F.col("doc_id").alias("_first")).distinct()
    kept = docs.join(first, F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi").withColumn("_md5", F.md5("text"))
    return kept.dropDuplicates(["doc_id", "_md5"]).drop("_md5")


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts runs of ten or more words that benchmark items have (and whole shorter items) out of the texts; a document that
    is mostly such runs goes. ``n_chars`` follows the text."""
    clean = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10, max_span=0, max_coverage=0.5)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in clean.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of sources with weights 1, 2, 3 says, from never to three times."""
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the rows into shards of near equal bytes, equal texts together as far as that allows."""
    return balanced_shards(docs, shards=SHARDS)


STAGES = [("quality", keep_good), ("near_duplicates", keep_one_of_similar), ("decontamination", cut_benchmark), ("mixing", mix), ("sharding", shard)]

#: A fitted network decides the first stage, which SQL cannot say; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
