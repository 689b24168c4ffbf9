"""Profiles: reports about the columns, labels and duplicates of a table, as long DataFrames.

Wide profiles put one aggregate per column into a single map-side aggregation and turn the one-row result into
rows. Long profiles count (column, value) pairs and are restricted to the columns that can appear in the report.
"""
from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import any_null, bucket_ratio, class_of, classify_value, columns_of, digest_columns, dtypes, is_inf, numeric, q, quoted
from ..session import local_table
from .quantiles import exact_quantiles



def _names(df: DataFrame, columns: Iterable[str] | None, without: Iterable[str] = ()) -> list[str]:
    skip = set(without)
    return [c for c in (df.columns if columns is None else columns) if c not in skip]


def per_column(aggregated: DataFrame, columns: list[str], fields: dict[str, str], keep: Iterable[str] = ()) -> DataFrame:
    """Rows ``(*keep, column, *fields)`` from an aggregate whose fields are called ``<prefix><position>``."""
    entries = [F.struct(F.lit(c).alias("column"), *[q(f"{prefix}{i}").alias(field) for field, prefix in fields.items()])
               for i, c in enumerate(columns)]
    return aggregated.select(*[q(k) for k in keep], F.inline(F.array(*entries)))


def long_values(df: DataFrame, columns: list[str], keep: Iterable[str] = ()) -> DataFrame:
    """Rows ``(*keep, column, value)`` with the values as text, NULLs included."""
    entries = [F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in columns]
    return df.select(*[q(k) for k in keep], F.inline(F.array(*entries)))


def shape(df: DataFrame, by: str | None = None) -> DataFrame:
    """Row and column count, per value of ``by`` if given."""
    grouped = df.groupBy(q(by)) if by else df.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns) - bool(by)))


def missing_report(df: DataFrame, columns: Iterable[str] | None = None, all_columns: bool = False) -> DataFrame:
    """Missing count, share and percent per column; columns without missing values only on request."""
    columns = _names(df, columns)
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(q(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)])
    out = per_column(row, columns, {"n_missing": "m"}, ["n_rows"])
    out = out if all_columns else out.where(q("n_missing") > 0)
    return (out.withColumn("share", F.try_divide(q("n_missing"), q("n_rows")))
            .withColumn("pct", F.round(q("share") * 100, 2)).select("column", "n_missing", "n_rows", "share", "pct"))


def inf_report(df: DataFrame, columns: Iterable[str] | None = None, all_columns: bool = False) -> DataFrame:
    """Count and share (of all rows) of +-infinity per column; text is read as a number where it is one."""
    columns, types = _names(df, columns), dtypes(df)
    row = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(is_inf(numeric(c, types[c]))).alias(f"m{i}") for i, c in enumerate(columns)])
    out = per_column(row, columns, {"n_inf": "m"}, ["n_rows"])
    out = out if all_columns else out.where(q("n_inf") > 0)
    return (out.withColumn("share", F.try_divide(q("n_inf"), q("n_rows")))
            .withColumn("pct", F.round(q("share") * 100, 2)).select("column", "n_inf", "n_rows", "share", "pct"))


def mixed_type_report(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Count per value class, for the columns that hold text or infinity.

    One count per (column, class) in a single aggregation: five classes times the columns, no row blow-up.
    """
    columns, types = _names(df, columns), dtypes(df)
    classes = ("NaN", "inf", "integer", "float", "string")
    read = df.select(*[q(c) for c in columns], *[numeric(c, types[c]).alias(f"_x{i}") for i, c in enumerate(columns)])
    kinds = read.select(*[classify_value(c, types[c], q(f"_x{i}")).alias(f"k{i}") for i, c in enumerate(columns)])
    row = kinds.agg(*[F.count_if(q(f"k{i}") == k).alias(f"{k}{i}") for i in range(len(columns)) for k in classes])
    wide = per_column(row, columns, {k: k for k in classes}).where((q("string") > 0) | (q("inf") > 0))
    return (wide.select("column", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), q(k).alias("n")) for k in classes])))
            .where(q("n") > 0))


def constant_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Columns with exactly one distinct non-null value, and that value."""
    columns = _names(df, columns)
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.min(q(c).cast("string")).alias(f"lo{i}"), F.max(q(c).cast("string")).alias(f"hi{i}"))])
    return per_column(row, columns, {"value": "lo", "_hi": "hi"}).where(q("value") == q("_hi")).drop("_hi")


def low_variance_columns(df: DataFrame, max_unique: int = 5, columns: Iterable[str] | None = None) -> DataFrame:
    """Columns with 2..``max_unique`` distinct non-null values, and the sorted values.

    A sketch with 5 % error first rules out columns with far more values (a wide margin keeps every real hit), so
    that only a few columns are counted exactly.
    """
    columns = _names(df, columns)
    rough = df.agg(*[F.approx_count_distinct(q(c).cast("string")).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    few = [c for i, c in enumerate(columns) if rough[f"d{i}"] <= 2 * max_unique + 64]
    if not few:
        return local_table(df.sparkSession, [], "`column` string, n_unique bigint, `values` array<string>")
    distinct = long_values(df, few).where(q("value").isNotNull()).distinct()
    return (distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"), F.array_sort(F.collect_list("value")).alias("values"))
            .where(q("n_unique").between(2, max_unique)))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, n)`` of the non-null values."""
    return long_values(df, columns).where(q("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def dominance(df: DataFrame, columns: Iterable[str] | None = None, min_ratio: float = 0.0) -> DataFrame:
    """Most frequent non-null value per column, with count and ratio over non-null rows; ties go to the smaller value.

    With ``min_ratio`` at or above 1 % only columns that reach it are reported, and no (column, value) pairs are
    shuffled: a frequent-items sketch names every value that can reach the ratio, a second scan counts those exactly.
    """
    columns = _names(df, columns)
    if min_ratio >= 0.01:
        top = _frequent(df, columns, min_ratio)
    else:
        counts = value_counts(df, columns)
        best = F.min(F.struct((-q("n")).alias("minus_n"), q("value"))).alias("best")
        top = (counts.groupBy("column").agg(best, F.sum("n").alias("n_values"))
               .select("column", q("best").getField("value").alias("value"), (-q("best").getField("minus_n")).alias("n"), "n_values"))
    return top.withColumn("ratio", q("n") / q("n_values")).where(q("ratio") >= min_ratio)


def _frequent(df: DataFrame, columns: list[str], min_ratio: float) -> DataFrame:
    # A sketch of so many items overrates a count by at most 2.7 / items of the rows: values at min_ratio rank within k.
    items = max(100, math.ceil(50 / min_ratio))
    k = math.floor(1 / (min_ratio - 2.7 / items)) + 1
    texts = df.select(*[q(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    row = texts.agg(*[F.expr(f"approx_top_k(c{i}, {k}, {items})").alias(f"t{i}") for i in range(len(columns))],
                    *[F.count(f"c{i}").alias(f"n{i}") for i in range(len(columns))]).first()
    picks = [(i, x["item"]) for i in range(len(columns)) for x in (row[f"t{i}"] or [])
             if x["item"] is not None and x["count"] >= min_ratio * row[f"n{i}"]]
    if not picks:
        return local_table(df.sparkSession, [], "`column` string, value string, n bigint, n_values bigint")
    exact = texts.agg(*[F.count(f"c{i}").alias(f"n{i}") for i in range(len(columns))],
                      *[F.count_if(q(f"c{i}") == F.lit(v)).alias(f"v{j}") for j, (i, v) in enumerate(picks)])
    entries = [F.struct(F.lit(columns[i]).alias("column"), F.lit(v).alias("value"), q(f"v{j}").alias("n"), q(f"n{i}").alias("n_values"))
               for j, (i, v) in enumerate(picks)]
    best = F.min(F.struct((-q("n")).alias("minus_n"), q("value"), q("n_values"))).alias("best")
    return (exact.select(F.inline(F.array(*entries))).groupBy("column").agg(best)
            .select("column", q("best").getField("value").alias("value"), (-q("best").getField("minus_n")).alias("n"),
                    q("best").getField("n_values").alias("n_values")))


def dominance_report(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """All values of every column whose top value holds at least half of the non-null rows, with the ratio's range."""
    found = {r["column"]: r for r in dominance(df, columns, min_ratio=0.5).collect()}
    if not found:
        return local_table(df.sparkSession, [], "`column` string, bucket string, value string, n bigint, ratio double")
    info = F.create_map(*[F.lit(x) for c, r in found.items() for x in (c, r["ratio"])])
    total = F.create_map(*[F.lit(x) for c, r in found.items() for x in (c, r["n_values"])])
    return value_counts(df, list(found)).select(
        "column", bucket_ratio(info[q("column")]).alias("bucket"), "value", "n", (q("n") / total[q("column")]).alias("ratio"))


def value_label_breakdown(df: DataFrame, label_col: str = "label", columns: Iterable[str] | None = None) -> DataFrame:
    """``(column, value, label, n)`` for the columns of the dominance report; NULL values and labels are left out."""
    found = [r["column"] for r in dominance(df, _names(df, columns, [label_col]), min_ratio=0.5).collect()]
    if not found:
        return local_table(df.sparkSession, [], "`column` string, value string, label string, n bigint")
    labelled = df.where(q(label_col).isNotNull()).withColumn("_label", q(label_col).cast("string"))
    return (long_values(labelled, found, ["_label"]).where(q("value").isNotNull())
            .groupBy("column", "value", q("_label").alias("label")).agg(F.count(F.lit(1)).alias("n")))


def dominant_columns(df: DataFrame, low: float, high: float = 1.0, columns: Iterable[str] | None = None) -> DataFrame:
    """Columns whose top ratio lies in [low, high], with the number of distinct values."""
    found = {r["column"]: r for r in dominance(df, columns, min_ratio=low).where(q("ratio") <= high).collect()}
    if not found:
        return local_table(df.sparkSession, [], "`column` string, value string, n bigint, ratio double, n_unique bigint")
    fields = [F.create_map(*[F.lit(x) for c, r in found.items() for x in (c, r[f])])[q("column")].alias(f) for f in ("value", "n", "ratio")]
    distinct = long_values(df, list(found)).where(q("value").isNotNull()).distinct()
    unique = distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    return unique.select("column", *fields, "n_unique")


def drop_by_profile(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Drops the columns named in a profile's ``column``; the profile runs first, because it decides the schema."""
    doomed = {r[0] for r in profile.select("column").distinct().collect()}
    return df.select(*[q(c) for c in df.columns if c not in doomed])


def label_distribution(df: DataFrame, label_col: str = "label", by: str | None = None) -> DataFrame:
    """Rows per label (per ``by``) with share and percent of the labelled rows."""
    labelled = df.where(q(label_col).isNotNull())
    keys = [by] if by else []
    counts = labelled.groupBy(*[q(k) for k in keys], q(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    if by:
        totals = counts.groupBy(q(by)).agg(F.sum("n").alias("_total"))
        shared = counts.join(totals, by).withColumn("share", q("n") / q("_total")).drop("_total")
    else:
        shared = counts.withColumn("share", q("n") / counts.agg(F.sum("n")).scalar())
    return shared.withColumn("pct", F.round(q("share") * 100, 2)).orderBy(*[q(k) for k in keys], F.desc("n"), "label")


def class_summary(df: DataFrame, label_col: str = "label", benign: str = "benign", by: str | None = None) -> DataFrame:
    """Total, benign and attack rows; rows without a label count as attack, as everything that is not benign does."""
    grouped = df.groupBy(q(by)) if by else df.groupBy()
    return (grouped.agg(F.count(F.lit(1)).alias("total"), F.count_if(class_of(q(label_col), benign) == "benign").alias("benign"))
            .withColumn("attack", q("total") - q("benign")))


def missing_by_label(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows and rows with any missing value, per label."""
    return (df.where(q(label_col).isNotNull()).groupBy(q(label_col).alias("label"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(any_null(df.columns)).alias("n_missing")))


def medians(df: DataFrame, columns: Iterable[str], exclude_inf: bool = True) -> DataFrame:
    """Exact median per column of the values that are numbers."""
    values = median_values(df, columns, exclude_inf)
    return local_table(df.sparkSession, list(values.items()), "`column` string, median double")


def median_values(df: DataFrame, columns: Iterable[str], exclude_inf: bool = True) -> dict[str, float | None]:
    types, wanted = dtypes(df), {}
    for c in columns:
        value = numeric(c, types[c])
        wanted[c] = F.when(~is_inf(value), value) if exclude_inf else value
    return {c: v[0] for c, v in exact_quantiles(df, wanted, [0.5]).items()}


def quartile_values(df: DataFrame, columns: Iterable[str] | None = None) -> dict[str, list[float | None]]:
    columns, types = columns_of(df, "numeric") if columns is None else list(columns), dtypes(df)
    return exact_quantiles(df, {c: numeric(c, types[c]) for c in columns}, [0.25, 0.75])


def quartiles(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """First and third quartile with linear interpolation, per numeric column."""
    rows = [(c, *v) for c, v in quartile_values(df, columns).items()]
    return local_table(df.sparkSession, rows, "`column` string, q1 double, q3 double")


def outlier_tests(df: DataFrame, columns: Iterable[str] | None = None, k: float = 1.5) -> dict[str, Column]:
    """Per column the test for values beyond ``k`` interquartile ranges from the quartiles; False for NULL."""
    types, tests = dtypes(df), {}
    for c, (q1, q3) in quartile_values(df, columns).items():
        if q1 is not None and math.isfinite(q3 - q1):
            value, reach = numeric(c, types[c]), k * (q3 - q1)
            tests[c] = F.coalesce((value < q1 - reach) | (value > q3 + reach), F.lit(False))
    return tests


def iqr_outliers(df: DataFrame, columns: Iterable[str] | None = None, k: float = 1.5) -> DataFrame:
    """The rows with at least one outlier, and the names of its outlying columns in ``outlier_columns``."""
    tests = outlier_tests(df, columns, k)
    names = F.filter(F.array(*[F.when(t, F.lit(c)) for c, t in tests.items()]), lambda x: x.isNotNull()) if tests else F.array()
    return df.withColumn("outlier_columns", names).where(F.size("outlier_columns") > 0)


def outlier_report(df: DataFrame, columns: Iterable[str] | None = None, k: float = 1.5, label_col: str | None = None) -> DataFrame:
    """Outliers per numeric column that has any, by label on request. A column with one value has none."""
    tests = outlier_tests(df, columns, k)
    keep = ["label"] if label_col else []
    grouped = df.groupBy(q(label_col).alias("label")) if label_col else df.groupBy()
    if not tests:
        return local_table(df.sparkSession, [], "label string, `column` string, n bigint").select(*keep, "column", "n")
    row = grouped.agg(*[F.count_if(t).alias(f"m{i}") for i, t in enumerate(tests.values())])
    return per_column(row, list(tests), {"n": "m"}, keep).where(q("n") > 0)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Up to ``bins`` distinct values: rows per value. Beyond that: rows in equal-width bins, the last one
    closed, all of them, empty ones with 0."""
    values = df.select(numeric(column, dtypes(df)[column]).alias("x")).where(q("x").isNotNull() & ~is_inf(q("x")))
    row = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.approx_count_distinct("x").alias("d")).first()
    many = row["d"] > 2 * bins + 64 or (row["d"] > 0 and values.distinct().limit(bins + 1).count() > bins)
    if not many:
        return values.groupBy(q("x").alias("low")).agg(F.count(F.lit(1)).alias("n")).select("low", q("low").alias("high"), "n")
    width = (row["hi"] - row["lo"]) / bins
    slot = F.least(F.floor((q("x") - row["lo"]) / width), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return (local_table(df.sparkSession, [(i,) for i in range(bins)], "bin int").join(counts, "bin", "left")
            .select((q("bin") * width + row["lo"]).alias("low"), ((q("bin") + 1) * width + row["lo"]).alias("high"), F.coalesce("n", F.lit(0)).alias("n")))


def duplicate_count(df: DataFrame, by: str | None = None) -> DataFrame:
    """Rows, and rows that repeat an earlier row; within each value of ``by`` if given.

    Rows are counted by their 128-bit digests; only those, the counts and the values of ``by`` are shuffled.
    """
    plain = df.select(*digest_columns(df), *([q(by)] if by else []))
    copies = plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("_n"))
    grouped = copies.groupBy(q(by)) if by else copies.groupBy()
    return grouped.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                       F.coalesce(F.sum(q("_n") - 1), F.lit(0)).alias("n_duplicates"))


def preview(df: DataFrame, condition: Column, n: int = 5, key: str | list[str] | None = None) -> DataFrame:
    """The first ``n`` rows that meet the condition, in key order."""
    keys = [key] if isinstance(key, str) else key or df.columns
    return df.where(condition).orderBy(*[q(k) for k in keys]).limit(n)


def top_k(df: DataFrame, by: str, k: int = 20, ties: str | None = None) -> DataFrame:
    """The ``k`` rows with the largest ``by``."""
    return df.orderBy(F.desc(quoted(by)), *([q(ties)] if ties else [])).limit(k)
