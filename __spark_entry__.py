from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from sluice.functions import class_of, classify_value, dtypes, numeric, q, safe_name
from sluice.operators import balance, columns, explain, models, profile, repair, rules, sampling, setops
from sluice.operators.neighbors import knn_join as nearest
from sluice.plans import clean_table
from sluice.session import configure, scratch_path
from sluice.sources import (header_inventory as headers, read_checked, read_folder, read_table, rejected_rows,
                            schema_conformance as conformance, unreadable_files as unreadable, with_source, write_parts_by_group, write_table)

# A table with the usual dirt, made from the orders by one text that both engines understand: missing labels and
# values, ports out of range, negative durations, infinities, sentinel texts, a constant and a dominated column, and a
# column of mixed types.
FLOWS = """
SELECT o_orderkey AS row_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'BENIGN'
       WHEN o_orderpriority = '1-URGENT' THEN 'Bot' ELSE CONCAT('DoS-', o_orderstatus) END AS label,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE CAST((o_orderkey * 7919) % 70000 AS DOUBLE) END AS src_port,
  CASE WHEN o_orderkey % 53 = 0 THEN -o_totalprice ELSE o_totalprice END AS flow_duration,
  CASE WHEN o_orderkey % 17 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN o_orderkey % 19 = 0 THEN NULL
       ELSE o_totalprice / 8 END AS bytes_rate,
  CASE WHEN o_orderkey % 5 < 2 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(o_custkey AS DOUBLE) END AS idle_max,
  o_totalprice - 250000 AS fwd_skew,
  CASE WHEN o_orderkey % 11 = 0 THEN 'not a complete handshake' WHEN o_orderkey % 13 = 0 THEN NULL
       ELSE CAST(o_orderkey % 1000 AS STRING) END AS delta_start,
  CASE WHEN o_orderkey % 22 = 0 THEN 'Not a Complete Handshake' WHEN o_orderkey % 7 = 0 THEN 'not a complete handshake'
       ELSE CAST(o_custkey % 500 AS STRING) END AS handshake_duration,
  'tcp' AS proto,
  CASE WHEN o_orderkey % 100 < 97 THEN '0' ELSE '1' END AS flag_count,
  CASE WHEN o_orderkey % 5 = 0 THEN 'abc' WHEN o_orderkey % 5 = 1 THEN 'inf' WHEN o_orderkey % 5 = 2 THEN '1.5'
       WHEN o_orderkey % 5 = 3 THEN '7' ELSE NULL END AS mixed_val
FROM {orders}
"""
NOTE = """CASE row_id % 6 WHEN 0 THEN '  outer spaces ' WHEN 1 THEN 'a "quoted" word, and a comma' WHEN 2 THEN concat('two', chr(10), 'lines')
  WHEN 3 THEN '' WHEN 4 THEN NULL ELSE ' ' END"""
TEXT = ["label", "delta_start", "handshake_duration", "proto", "flag_count", "mixed_val"]
DOUBLES = ["src_port", "flow_duration", "bytes_rate", "idle_max", "fwd_skew"]
HANDSHAKE = ["delta_start", "handshake_duration"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FLAGS = ["A", "N", "R"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def flows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(FLOWS, orders=table(spark, sf, "orders"))


def flows_dup(spark: SparkSession, sf: str) -> DataFrame:
    """The dirty table with all rows of one label twice."""
    df = flows(spark, sf)
    return df.unionByName(df.where(q("label") == "Bot"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").withColumn("label", q("label").cast("string"))


def measured(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *MEASURES, "l_linestatus",
                                               q("l_returnflag").alias("label"))


def ruled(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a prediction by a fixed rule, so that the metrics can be checked in SQL."""
    guess = F.when(q("l_quantity") < 17, "A").when(q("l_quantity") < 34, "N").otherwise("R")
    return measured(spark, sf).withColumn("predicted_label", guess)


def staged(spark: SparkSession, sf: str, names: list[str]) -> str:
    """The tables as CSV, one folder each, below one new folder."""
    root = scratch_path(spark, "folder")
    for name in names:
        write_table(table(spark, sf, name), f"{root}/{name}")
    return root


# ---------------------------------------------------------------- sources and sinks

def scan_all_string(spark, sf):
    path = write_table(table(spark, sf, "customer"), scratch_path(spark, "customer.csv"))
    return read_table(spark, path).withColumn("c_acctbal", q("c_acctbal").cast("double"))


def scan_typed(spark, sf):
    path = write_table(table(spark, sf, "lineitem"), scratch_path(spark, "lineitem.csv"))
    return read_table(spark, path, table(spark, sf, "lineitem").schema)


def merge_parts(spark, sf):
    """One file with one header, joined from ten parts, and read back."""
    path = write_table(table(spark, sf, "lineitem"), scratch_path(spark, "whole") + "/lineitem.csv", partitions=10, single_file=True)
    return read_table(spark, path, table(spark, sf, "lineitem").schema, fmt="csv")


def scan_folder_counts(spark, sf):
    root = staged(spark, sf, ["customer", "supplier", "part"])
    df = read_table(spark, root, recursiveFileLookup=True, pathGlobFilter="*.csv", fmt="csv")
    return with_source(df, "source", folder=True).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def scan_folder_by_name(spark, sf):
    root = staged(spark, sf, ["customer", "supplier"])
    df = read_folder(spark, root, source_col=None)
    return df.withColumns({c: q(c).cast("double") for c in ("c_acctbal", "s_acctbal")})


def unreadable_files(spark, sf):
    """Two whole tables and, beside them, a file whose name says that it is compressed, though it is not."""
    root = staged(spark, sf, ["region", "nation"])
    table(spark, sf, "nation").select("n_name").coalesce(1).write.text(f"{root}/cut", lineSep="\n")
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{root}/cut").select("path").collect()
    hadoop = spark._jvm.org.apache.hadoop.fs
    for k, row in enumerate(parts):
        old, new = hadoop.Path(row["path"]), hadoop.Path(f"{root}/cut/broken-{k}.csv.gz")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new)
    bad = unreadable(spark, root, include_glob="*.csv*").select("filename")
    return bad.withColumn("n_rows_left", F.lit(read_folder(spark, root, include_glob="*.csv*").count()))


def header_inventory(spark, sf):
    return headers(spark, staged(spark, sf, ["region", "nation", "customer", "supplier", "part", "orders"]), name_from="folder")


def schema_conformance(spark, sf):
    root, orders = scratch_path(spark, "folder"), table(spark, sf, "orders")
    write_table(orders, f"{root}/same")
    write_table(orders.select(*reversed(orders.columns)), f"{root}/reversed")
    write_table(orders.drop("o_orderpriority"), f"{root}/shorter")
    found = conformance(spark, orders.columns, root, name_from="folder")
    return found.select("filename", F.array_join("names", ",").alias("header"))


def scan_pruned(spark, sf):
    return read_table(spark, f"{sf}/lineitem.parquet", "infer", columns=["l_orderkey", "l_returnflag"])


def normalize_nulls(spark, sf):
    tokens = F.when(q("c_mktsegment") == "BUILDING", "NA").when(q("c_mktsegment") == "MACHINERY", "nan").otherwise(q("c_mktsegment"))
    balance_ = F.when(q("c_acctbal") < 0, float("nan")).otherwise(q("c_acctbal"))
    return columns.normalize_nulls(table(spark, sf, "customer").withColumn("c_mktsegment", tokens).withColumn("c_acctbal", balance_))


def sink_roundtrip(spark, sf):
    """As CSV, with a column of texts that CSV tends to spoil."""
    df = flows(spark, sf).withColumn("note", F.expr(NOTE))
    path = write_table(df, scratch_path(spark, "flows"))
    return read_table(spark, path, df.schema, multiLine=True, nullValue="\0")


def sink_n_parts(spark, sf):
    orders = table(spark, sf, "orders")
    return read_table(spark, write_table(orders, scratch_path(spark, "orders"), partitions=20), orders.schema)


def bad_record_counts(spark, sf):
    events = table(spark, sf, "events")
    broken = events.withColumn("value", F.when(q("event_type") == "purchase", q("event_type")).otherwise(q("value").cast("string")))
    path = write_table(broken, scratch_path(spark, "events.csv"))
    good, bad = rejected_rows(read_checked(spark, path, events.schema))
    return good.agg(F.count("event_id").alias("n")).withColumn("kind", F.lit("good")).unionByName(
        bad.agg(F.count("event_id").alias("n")).withColumn("kind", F.lit("bad")))


def bounded_parts(spark, sf):
    parts = sampling.bounded_parts(flows(spark, sf), benign_rows=1000, attack_rows=700, shuffle_seed=42, key="row_id")
    return parts.select("row_id", "class", "status", "label_name", "part")


def bounded_part_files(spark, sf):
    parts = sampling.bounded_parts(flows(spark, sf), benign_rows=1000, attack_rows=700, separate="benign", key="row_id")
    groups = ["status", "class", "label_name", "part"]
    path = write_parts_by_group(parts.select("row_id", *groups), scratch_path(spark, "parts"), groups)
    back = with_source(read_table(spark, path), "file")
    return back.groupBy(*groups[:3], q("part").cast("bigint").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files"))


# ---------------------------------------------------------------- columns and scalars

def drop_columns(spark, sf):
    return columns.drop_columns(flows(spark, sf), ["label", "proto", "no_such_column", *DOUBLES])


def dedupe_columns(spark, sf):
    df = flows(spark, sf).select("row_id", "label", "src_port", "flow_duration").toDF("a", "a.1", "x.y", "x.z")
    return columns.dedupe_columns(df)


def resolve_label(spark, sf):
    df = flows(spark, sf).select("row_id", q("label").alias(" Label"))
    return columns.resolve_label(df)


def normalize_names(spark, sf):
    df = table(spark, sf, "nation")
    return columns.normalize_names(df.toDF(*[f" {c.upper()} " for c in df.columns]))


def align_schema(spark, sf):
    df = flows(spark, sf).select("proto", "label", "flow_duration", "row_id")
    return columns.align_to(df, ["row_id", "src_port", "flow_duration", "new_feature"])


def align_report(spark, sf):
    return columns.align_report(table(spark, sf, "customer"), table(spark, sf, "orders"))


def incomplete_flag(spark, sf):
    df = flows(spark, sf).select("row_id", *HANDSHAKE)
    a, b = rules.sentinel_tests(HANDSHAKE)
    return columns.add_flag(df, a | b, "handshake_incomplete", after="handshake_duration")


def safe_label(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", safe_name(F.concat("o_orderpriority", F.lit("/ "), "o_orderstatus")).alias("safe"))


def to_numeric(spark, sf):
    df = flows(spark, sf)
    return df.select("row_id", *[numeric(c, dtypes(df)[c]).alias(c) for c in (*HANDSHAKE, "mixed_val")])


def classify(spark, sf):
    df = flows(spark, sf)
    return df.select("row_id", *[classify_value(c, dtypes(df)[c]).alias(c) for c in (*HANDSHAKE, "mixed_val", "bytes_rate")])


def encode_label(spark, sf):
    return columns.encode_label(flows(spark, sf).select("row_id", "label"))


def drop_constant_lowvar(spark, sf):
    df = flows(spark, sf)
    found = profile.constant_columns(df).select("column").union(profile.low_variance_columns(df, 3).select("column"))
    return profile.drop_by_profile(df, found)


def drop_dominant(spark, sf):
    df = flows(spark, sf).select("row_id", *TEXT)
    return profile.drop_by_profile(df, profile.dominant_columns(df, 0.9, 0.99))


# ---------------------------------------------------------------- rules

def rule_non_negative(spark, sf):
    df = flows(spark, sf)
    return rules.rule_report(df, rules.rule_non_negative(df))


def rule_port_range(spark, sf):
    df = flows(spark, sf)
    return rules.rule_report(df, rules.rule_range(df), "label")


def _all_rules(df):
    return [*rules.rule_non_negative(df), *rules.rule_range(df)]


def rule_report(spark, sf):
    df = flows(spark, sf)
    return rules.rule_report(df, _all_rules(df), "label")


def count_invalid(spark, sf):
    df = flows(spark, sf)
    return rules.count_invalid(df, _all_rules(df))


def drop_invalid_rows(spark, sf):
    df = flows(spark, sf)
    return rules.apply_rules(df, _all_rules(df)).select("row_id", "label", "flow_duration", "src_port")


def quarantine_rows(spark, sf):
    df = flows(spark, sf)
    bad = rules.apply_rules(df, _all_rules(df), "quarantine")
    return bad.select("row_id", F.array_join("violations", ",").alias("violations"))


def sentinel_status(spark, sf):
    return rules.sentinel_status(flows(spark, sf), HANDSHAKE).select("row_id", "status")


def sentinel_by_label(spark, sf):
    return rules.sentinel_by_label(flows(spark, sf), HANDSHAKE)


def drop_sentinel_rows(spark, sf):
    return rules.drop_sentinel_rows(flows(spark, sf), HANDSHAKE).select("row_id", *HANDSHAKE)


def drop_missing_for_labels(spark, sf):
    return rules.drop_missing_for_labels(flows(spark, sf), ["BENIGN", "Bot"]).select("row_id", "label")


def split_by_missing(spark, sf):
    return rules.split_by_missing(flows(spark, sf)).select("row_id", "label", "status")


def route_files(spark, sf):
    routed = rules.route_by_group(table(spark, sf, "orders"), "o_custkey", class_of(q("o_orderstatus"), "f") == "benign")
    return routed.select("o_orderkey", "o_custkey", "route")


def exclude_keys(spark, sf):
    bad = flows(spark, sf).where(q("flow_duration") < 0).select(q("row_id").alias("o_orderkey"))
    return rules.exclude_keys(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), bad, "o_orderkey")


# ---------------------------------------------------------------- profiles

def table_shape(spark, sf):
    return profile.shape(table(spark, sf, "lineitem"))


def shape_by_label(spark, sf):
    return profile.shape(flows(spark, sf).where(q("label").isNotNull()), "label")


def missing_report(spark, sf):
    return profile.missing_report(flows(spark, sf))


def inf_report(spark, sf):
    return profile.inf_report(flows(spark, sf))


def mixed_type_report(spark, sf):
    return profile.mixed_type_report(flows(spark, sf))


def constant_columns(spark, sf):
    return profile.constant_columns(flows(spark, sf))


def low_variance_columns(spark, sf):
    found = profile.low_variance_columns(flows(spark, sf), 5)
    return found.select("column", "n_unique", F.array_join("values", "|").alias("value_list"))


def dominance(spark, sf):
    return profile.dominance(flows(spark, sf), TEXT)


def dominance_report(spark, sf):
    return profile.dominance_report(flows(spark, sf), TEXT)


def value_label_breakdown(spark, sf):
    return profile.value_label_breakdown(flows(spark, sf), columns=TEXT[1:])


def dominant_columns(spark, sf):
    return profile.dominant_columns(flows(spark, sf), 0.2, 0.99, TEXT)


def label_distribution(spark, sf):
    return profile.label_distribution(flows(spark, sf))


def label_distribution_by(spark, sf):
    return profile.label_distribution(table(spark, sf, "events"), "event_type", by="user_id")


def class_summary(spark, sf):
    return profile.class_summary(flows(spark, sf))


def missing_by_label(spark, sf):
    return profile.missing_by_label(flows(spark, sf))


def medians(spark, sf):
    found = profile.medians(flows(spark, sf), ["flow_duration", "bytes_rate", "idle_max", "delta_start"])
    return found.withColumn("median", F.round("median", 4))


def quartiles(spark, sf):
    found = profile.quartiles(table(spark, sf, "lineitem"), MEASURES)
    return found.select("column", F.round("q1", 4).alias("q1"), F.round("q3", 4).alias("q3"))


OUTLIERS = ["flow_duration", "fwd_skew", "src_port", "bytes_rate"]


def iqr_outlier_rows(spark, sf):
    found = profile.iqr_outliers(flows(spark, sf), ["flow_duration", "fwd_skew"])
    return found.select("row_id", F.array_join("outlier_columns", ",").alias("outlier_columns"))


def outlier_report(spark, sf):
    return profile.outlier_report(flows(spark, sf), OUTLIERS)


def outlier_by_label(spark, sf):
    return profile.outlier_report(flows(spark, sf), OUTLIERS, label_col="label")


def histogram(spark, sf):
    found = profile.histogram(table(spark, sf, "events"), "value")
    return found.select(F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "n")


def histogram_values(spark, sf):
    return profile.histogram(table(spark, sf, "lineitem"), "l_discount")


def duplicate_count(spark, sf):
    return profile.duplicate_count(flows_dup(spark, sf))


def duplicate_count_by(spark, sf):
    return profile.duplicate_count(flows_dup(spark, sf).where(q("label").isNotNull()), "label")


def preview_affected(spark, sf):
    a, b = rules.sentinel_tests(HANDSHAKE)
    return profile.preview(flows(spark, sf).select("row_id", *HANDSHAKE), a | b, 5, "row_id")


def top_k_orders(spark, sf):
    return profile.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 20, "o_orderkey")


# ---------------------------------------------------------------- repairs

def impute_inf(spark, sf):
    return repair.impute_inf(flows(spark, sf)).select("row_id", "bytes_rate", "idle_max", "mixed_val")


def drop_inf_columns(spark, sf):
    return repair.drop_inf_columns(flows(spark, sf).select("row_id", *DOUBLES))


def fill_sentinel_with_median(spark, sf):
    fixed = repair.fill_sentinel_with_median(flows(spark, sf).select("row_id", *HANDSHAKE), HANDSHAKE)
    return fixed.select("row_id", "handshake_incomplete", *[F.round(c, 4).alias(c) for c in HANDSHAKE])


def inf_remediation(spark, sf):
    fixed, _ = repair.remediate_inf(flows(spark, sf).select("row_id", *DOUBLES))
    return fixed


def inf_remaining(spark, sf):
    _, report = repair.remediate_inf(flows(spark, sf).select("row_id", *DOUBLES))
    return report


def clean_and_profile(spark, sf):
    return profile.label_distribution(clean_table(flows(spark, sf), HANDSHAKE, ["proto"]))


# ---------------------------------------------------------------- set operations

def dedupe_rows(spark, sf):
    return setops.dedupe_rows(flows_dup(spark, sf).select("row_id", *TEXT))


def dedupe_by_key(spark, sf):
    return setops.dedupe_rows(table(spark, sf, "lineitem"), ["l_partkey"], ["l_orderkey", "l_linenumber"])


def distinct_rows(spark, sf):
    return setops.distinct_rows(flows_dup(spark, sf))


def _compared(spark, sf):
    names = ["row_id", "label", *HANDSHAKE]
    raw = flows_dup(spark, sf).select(*names)
    done = rules.drop_sentinel_rows(flows(spark, sf), HANDSHAKE).select(*names)
    return raw, done.withColumn("label", F.when(q("label") == "Bot", "bot").otherwise(q("label")))


def compare_missing(spark, sf):
    return setops.missing_rows(*_compared(spark, sf))


def compare_extra(spark, sf):
    return setops.extra_rows(*_compared(spark, sf))


def compare_summary(spark, sf):
    return setops.compare_tables(*_compared(spark, sf))


def union_positional(spark, sf):
    named = ["id", "name", "nation", "balance"]
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal").toDF(*named)
    return setops.union_positional([customers, table(spark, sf, "supplier").toDF(*named)])


def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(q("c_custkey").alias("id"), q("c_mktsegment").alias("segment"))
    return setops.union_by_name([customers, table(spark, sf, "supplier").select(q("s_name").alias("name"), q("s_suppkey").alias("id"))])


# ---------------------------------------------------------------- sampling

def shuffle_rows(spark, sf):
    return sampling.shuffle(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 42, "position")


def interleave_by(spark, sf):
    return sampling.interleave(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey")


def shuffle_by_label(spark, sf):
    return sampling.shuffle_by_label(flows(spark, sf).select("row_id", "label"), key="row_id")


def stratified_split(spark, sf):
    return sampling.stratified_split(flows(spark, sf).select("row_id", "label"), 0.6, key="row_id")


def split_counts(spark, sf):
    return sampling.split_counts(stratified_split(spark, sf))


def random_split(spark, sf):
    return sampling.stratified_split(table(spark, sf, "events").select("event_id", "event_type"), 0.8, "event_type", "event_id", seed=42)


def _labelled_orders(spark, sf):
    label = F.when(q("o_orderstatus") == "F", "Benign").otherwise(q("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", label.alias("label"))


def downscale(spark, sf):
    return sampling.downscale(_labelled_orders(spark, sf), 0.1, by="o_orderpriority", key="o_orderkey")


def downscale_counts(spark, sf):
    return profile.label_distribution(downscale(spark, sf), by="o_orderpriority").select("o_orderpriority", "label", "n")


def class_split_counts(spark, sf):
    return profile.class_summary(stratified_split(spark, sf), by="split")


# ---------------------------------------------------------------- neighbours and balancing

def map_labels(spark, sf):
    known = models.label_mapping(flows(spark, sf).where(q("label") != "Bot"))
    return models.map_labels(flows(spark, sf).select("row_id", "label"), known)


def knn_join(spark, sf):
    df = vectors(spark, sf)
    found = nearest(df, df, "vec_id", "embedding", 5, within="label", vectors=False)
    return found.select("vec_id", "rank", "neighbor", F.round("distance", 4).alias("distance"))


def balance_targets(spark, sf):
    return balance.balance_targets(flows(spark, sf), 0.8)


def undersample(spark, sf):
    df = flows(spark, sf).select("row_id", "label")
    counts = df.where(q("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return balance.undersample(df, counts.withColumn("target", F.floor(q("n") / 3)), key="row_id")


def _oversampled(spark, sf, method):
    df = vectors(spark, sf)
    return balance.oversample(df, balance.balance_targets(df, 1.0), "embedding", key="vec_id", method=method)


def smote_counts(spark, sf):
    return _oversampled(spark, sf, "smote").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("n_new"))


def smote_rows(spark, sf):
    """Every new row: some of its numbers and their sum."""
    at = lambda i: F.round(F.get("embedding", F.lit(i)).cast("double"), 4).alias(f"x{i}")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return _oversampled(spark, sf, "smote").where("synthetic").select("label", at(0), at(31), at(63), F.round(total, 3).alias("total"))


def borderline_counts(spark, sf):
    return _oversampled(spark, sf, "borderline").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("n_new"))


def adasyn_counts(spark, sf):
    return _oversampled(spark, sf, "adasyn").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("n_new"))


def _minor(df):
    return [r["label"] for r in balance.balance_targets(df, 1.0).where(q("n") < q("target")).collect()]


def borderline_candidates(spark, sf):
    df = vectors(spark, sf)
    return balance.borderline_candidates(df, _minor(df), "embedding", key="vec_id").select("vec_id", "label")


def adasyn_weights(spark, sf):
    df = vectors(spark, sf)
    found = balance.adasyn_weights(df, _minor(df), "embedding", key="vec_id")
    return found.select("vec_id", "label", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------- models

# Line items labelled by how many of three conditions hold, each on a feature of its own, beside two features that say
# nothing, one of them with missing values. No single feature tells the labels apart; a model of the usual size that uses
# all three predicts them exactly, on rows it has not seen, too.
LABELLED = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS item, l_discount AS discount, l_tax AS tax, CAST(l_linenumber AS DOUBLE) AS line,
  l_extendedprice AS price, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END AS quantity,
  CASE CAST(l_discount > 0.055 AS INT) + CAST(l_tax > 0.045 AS INT) + CAST(l_linenumber > 3 AS INT) WHEN 3 THEN 'R' WHEN 2 THEN 'N' ELSE 'A' END AS label
FROM {lineitem}
"""
FEATURES = ["discount", "tax", "line", "price", "quantity"]


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(LABELLED, lineitem=table(spark, sf, "lineitem"))


def _forest(spark: SparkSession, sf: str):
    return models.train_forest(labelled(spark, sf), features=FEATURES)


def label_mapping(spark, sf):
    return models.label_mapping(flows(spark, sf))


def mapping_file(spark, sf):
    labels = [r["label"] for r in models.label_mapping(flows(spark, sf)).orderBy("label_index").collect()]
    return models.read_mapping(spark, models.write_mapping(labels, scratch_path(spark, "mapping")))


def encode_features(spark, sf):
    return models.encode_features(flows(spark, sf).select("row_id", *TEXT))


def forest_predictions(spark, sf):
    """All rows by a model that has seen four fifths of them."""
    df = labelled(spark, sf)
    model, _ = models.train_and_hold_out(df, models.train_forest, features=FEATURES)
    return models.score_batch(model, df)


def boosted_predictions(spark, sf):
    """All rows by a model of three labels that has seen four fifths of them."""
    df = labelled(spark, sf)
    model, _ = models.train_and_hold_out(df, models.train_boosted, features=FEATURES)
    return models.score_batch(model, df)


def hold_out_counts(spark, sf):
    """What a saved and loaded boosted model says about the rows that it was not trained on."""
    model, _ = models.train_and_hold_out(labelled(spark, sf), models.train_boosted, features=FEATURES, rounds=20)
    saved = models.load_model(models.save_model(model, scratch_path(spark, "boosted")))
    test = sampling.stratified_split(labelled(spark, sf), 0.8, "label", None, 42).where(q("split") == "test").drop("split")
    return models.score_batch(saved, test).groupBy("label", "predicted_label").agg(F.count(F.lit(1)).alias("n"))


def feature_importance(spark, sf):
    """Whether each feature matters, and the sum over all."""
    found = models.feature_importance(_forest(spark, sf))
    total = F.round(F.sum("importance_pct").over(W.partitionBy()), 6)
    return found.select("feature", (q("importance_pct") >= 5).alias("matters"), total.alias("total_pct"))


def top_k_features(spark, sf):
    return profile.top_k(models.feature_importance(_forest(spark, sf)), "importance_pct", 3, "feature").select("feature")


def boosted_importance(spark, sf):
    found = models.feature_importance(models.train_boosted(labelled(spark, sf), features=FEATURES, rounds=20))
    return found.select("feature", (q("importance_pct") >= 5).alias("matters"))


def prune_features(spark, sf):
    return models.prune_features(labelled(spark, sf), models.feature_importance(_forest(spark, sf)), 5)


def score_batch(spark, sf):
    """By a model that was saved and loaded, on a table with other spelling, without one feature, and without labels."""
    saved = models.load_model(models.save_model(_forest(spark, sf), scratch_path(spark, "model")))
    batch = labelled(spark, sf).drop("price", "label").withColumnRenamed("tax", " Tax ")
    return models.score_batch(saved, columns.normalize_names(batch))


def prediction_counts(spark, sf):
    return models.prediction_counts(score_batch(spark, sf))


def _reasons(found: DataFrame) -> DataFrame:
    """The reasons of each sentence by name; their order follows from the data."""
    said = F.split_part("explanation", F.lit(" because: "), F.lit(1)), F.split_part("explanation", F.lit(" because: "), F.lit(2))
    return found.select("predicted_label", "item", F.concat(said[0], F.lit(" because: "), F.array_join(F.array_sort(F.split(said[1], ", ")), ", ")).alias("explanation"))


def explain_predictions(spark, sf):
    return _reasons(explain.explain_predictions(_forest(spark, sf), labelled(spark, sf), "item"))


def explain_boosted(spark, sf):
    """Two labels, two conditions or more against fewer, so that each condition speaks for one label and against the other."""
    df = labelled(spark, sf).withColumn("label", F.when(q("label") == "A", "few").otherwise("most"))
    return _reasons(explain.explain_predictions(models.train_boosted(df, features=FEATURES), df, "item"))


def decode_label(spark, sf):
    """Labels to indices and back."""
    df = flows(spark, sf).select("row_id", "label")
    coded = columns.encode_label(df).drop("label")
    return columns.decode_label(coded, columns.label_index(df)).select("row_id", "decoded")


def split_xy(spark, sf):
    """The features of the line items by the split of features and label, and the label apart."""
    features, label = columns.split_xy(measured(spark, sf), "label")
    return measured(spark, sf).select(*features, q(label).alias("target"))


def keep_labels(spark, sf):
    return rules.keep_labels(flows(spark, sf), ["Bot", "BENIGN"])


def evaluate_report(spark, sf):
    """The metrics behind the guard: here all labels are known."""
    _, report = models.evaluate(ruled(spark, sf), FLAGS)
    return report.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


def merge_folder(spark, sf):
    """Rows per table of a folder of files that differ in their columns."""
    merged = read_folder(spark, staged(spark, sf, ["customer", "supplier", "part", "nation"]))
    known = [c for c in merged.columns if c.endswith("key") and c[0] in "cspn" and c not in ("c_nationkey", "s_nationkey", "n_regionkey")]
    return merged.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(q(c)).alias(f"n_{c}") for c in known])


def confusion_matrix(spark, sf):
    return models.confusion_matrix(ruled(spark, sf), FLAGS)


def classification_report(spark, sf):
    found = models.classification_report(ruled(spark, sf), FLAGS)
    return found.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


def rule_prediction_counts(spark, sf):
    return models.prediction_counts(ruled(spark, sf))


def evaluate_guard(spark, sf):
    return models.evaluation_guard(ruled(spark, sf), FLAGS[:2])


QUERIES = [
    scan_all_string, scan_typed, merge_parts, scan_folder_counts, scan_folder_by_name, unreadable_files, decode_label, split_xy, keep_labels, evaluate_report, merge_folder, header_inventory, schema_conformance, scan_pruned, normalize_nulls,
    sink_roundtrip, sink_n_parts, bad_record_counts, bounded_parts, bounded_part_files, drop_columns, dedupe_columns, resolve_label,
    normalize_names, align_schema, align_report, incomplete_flag, safe_label, to_numeric, classify, encode_label, drop_constant_lowvar,
    drop_dominant, rule_non_negative, rule_port_range, rule_report, count_invalid, drop_invalid_rows, quarantine_rows, sentinel_status,
    sentinel_by_label, drop_sentinel_rows, drop_missing_for_labels, split_by_missing, route_files, exclude_keys, table_shape, shape_by_label,
    missing_report, inf_report, mixed_type_report, constant_columns, low_variance_columns, dominance, dominance_report,
    value_label_breakdown, dominant_columns, label_distribution, label_distribution_by, class_summary, missing_by_label, medians, quartiles,
    iqr_outlier_rows, outlier_report, outlier_by_label, histogram, histogram_values, duplicate_count, duplicate_count_by, preview_affected, top_k_orders,
    impute_inf, drop_inf_columns, fill_sentinel_with_median, inf_remediation, inf_remaining, clean_and_profile, dedupe_rows, dedupe_by_key,
    distinct_rows, compare_missing, compare_extra, compare_summary, union_positional, union_by_name, shuffle_rows, interleave_by,
    shuffle_by_label, stratified_split, split_counts, random_split, downscale, downscale_counts, class_split_counts, map_labels, knn_join,
    balance_targets, undersample, smote_counts, smote_rows, borderline_counts, adasyn_counts, borderline_candidates, adasyn_weights,
    label_mapping, mapping_file, encode_features, forest_predictions, boosted_predictions, hold_out_counts, feature_importance, boosted_importance, explain_boosted, top_k_features, prune_features, score_batch,
    prediction_counts, explain_predictions, confusion_matrix, classification_report, rule_prediction_counts, evaluate_guard,
]


def entry(spark: SparkSession) -> DataFrame:
    """The flagship: the dirty table cleaned by rule and repaired, then its labels counted."""
    return clean_and_profile(spark, "/root/testdata/sf0.001")


# The training-data operators and their pipeline are optional: everything else works without their folders.
try:
    from sluice.llm.queries import QUERIES as LLM_QUERIES
    from sluice.llm.oracle import ORACLE as LLM_ORACLE
except ModuleNotFoundError as missing:
    if not str(missing.name).startswith("sluice.llm"):
        raise
    LLM_QUERIES, LLM_ORACLE = {}, {}
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not str(missing.name).startswith("sluice.llm"):
        raise
    corpus_pipeline = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {f.__name__: f for f in QUERIES} | LLM_QUERIES
    named["classify_value"] = named.pop("classify")
    if corpus_pipeline:
        named["pipeline"] = corpus_pipeline.run
    return named


def oracle_sql() -> dict[str, str]:
    from oracle import ORACLE
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}
    return ORACLE | LLM_ORACLE | whole
