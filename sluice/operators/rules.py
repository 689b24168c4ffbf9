"""Row rules: predicates that name the rows that are invalid, and the operators that count, drop or set them aside."""
from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import any_null, contains_text, dtypes, numeric, q
from ..session import small_table
from .profile import per_column

# Parts of column names whose values cannot be negative, and the exempting parts.
NEVER_NEGATIVE = ("port", "duration", "count", "bytes", "size", "rate", "percentage", "variance", "std", "total", "max",
                  "min", "median", "mode", "mean", "iat", "active", "idle", "bulk", "handshake", "subflow")
MAY_BE_NEGATIVE = ("skew", "cov", "delta")
PORTS = ("src_port", "dst_port")
SENTINEL = "not a complete handshake"


@dataclass
class Rule:
    """A named test of one column; ``violated`` is True or False, never NULL."""
    name: str
    column: str
    violated: Column


def rule_non_negative(df: DataFrame, never: Iterable[str] = NEVER_NEGATIVE, allow: Iterable[str] = MAY_BE_NEGATIVE) -> list[Rule]:
    """One rule per column whose name says that its values cannot be negative."""
    rules = []
    for name, dtype in dtypes(df).items():
        low = name.lower()
        if any(w in low for w in never) and not any(w in low for w in allow):
            rules.append(Rule("non_negative", name, F.coalesce(numeric(name, dtype) < 0, F.lit(False))))
    return rules


def rule_range(df: DataFrame, columns: Iterable[str] = PORTS, low: float = 0, high: float = 65535,
               null_is_invalid: bool = True) -> list[Rule]:
    """Values outside [low, high]; missing values and text are invalid unless told otherwise."""
    types = dtypes(df)
    return [Rule("range", c, ~F.coalesce(numeric(c, types[c]).between(low, high), F.lit(not null_is_invalid)))
            for c in columns if c in types]


def any_violated(rules: list[Rule]) -> Column:
    return reduce(or_, [r.violated for r in rules], F.lit(False))


def apply_rules(df: DataFrame, rules: list[Rule], mode: str = "drop") -> DataFrame:
    """``drop`` keeps the valid rows; ``quarantine`` gives the invalid ones with the broken rules in ``violations``."""
    if mode == "drop":
        return df.where(~any_violated(rules))
    if mode != "quarantine":
        raise ValueError(mode)
    names = F.filter(F.array(*[F.when(r.violated, F.lit(f"{r.name}:{r.column}")) for r in rules]), lambda x: x.isNotNull())
    return df.where(any_violated(rules)).withColumn("violations", names)


def rule_report(df: DataFrame, rules: list[Rule], label_col: str | None = None) -> DataFrame:
    """Violations per rule and column, by label on request; zero counts are left out."""
    keep = ["label"] if label_col else []
    grouped = df.groupBy(q(label_col).alias("label")) if label_col else df.groupBy()
    row = grouped.agg(*[F.count_if(r.violated).alias(f"m{i}") for i, r in enumerate(rules)])
    long = per_column(row, [f"{r.name}:{r.column}" for r in rules], {"n": "m"}, keep).where(q("n") > 0)
    return long.select(*keep, F.substring_index("column", ":", 1).alias("rule"),
                       F.expr("substring(column, locate(':', column) + 1)").alias("column"), "n")


def count_invalid(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rows and the rows that break at least one rule."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(any_violated(rules)).alias("n_invalid"))


def sentinel_tests(columns: Iterable[str], text: str = SENTINEL, ignore_case: bool = True) -> list[Column]:
    return [contains_text(q(c), text, ignore_case) for c in columns]


def sentinel_status(df: DataFrame, columns: Iterable[str], text: str = SENTINEL, ignore_case: bool = True,
                    out: str = "status") -> DataFrame:
    """Adds ``all_invalid``, ``all_valid`` or ``some_invalid``: how many of the columns hold the text."""
    tests = sentinel_tests(columns, text, ignore_case)
    every, some = reduce(and_, tests), reduce(or_, tests)
    return df.withColumn(out, F.when(every, "all_invalid").when(~some, "all_valid").otherwise("some_invalid"))


def sentinel_by_label(df: DataFrame, columns: Iterable[str], label_col: str = "label", text: str = SENTINEL) -> DataFrame:
    """Rows per status and label."""
    return (sentinel_status(df, columns, text).groupBy("status", q(label_col).alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))


def drop_sentinel_rows(df: DataFrame, columns: Iterable[str], text: str = SENTINEL, how: str = "all",
                       ignore_case: bool = True) -> DataFrame:
    """Drops rows in which all (or ``any``) of the columns hold the text."""
    return df.where(~reduce({"all": and_, "any": or_}[how], sentinel_tests(columns, text, ignore_case)))


def drop_missing_for_labels(df: DataFrame, labels: Iterable[str] | str, label_col: str = "label") -> DataFrame:
    """Drops rows with a missing value if their label is listed; ``all`` lists every label, ``none`` no label."""
    if labels == "none":
        return df
    listed = q(label_col).isNotNull() if labels == "all" else F.coalesce(q(label_col).isin(list(labels)), F.lit(False))
    return df.where(~(listed & any_null(df.columns)))


def split_by_missing(df: DataFrame, label_col: str = "label", out: str = "status") -> DataFrame:
    """Adds ``Missing`` or ``NoMissing``; rows without a label are left out."""
    return df.where(q(label_col).isNotNull()).withColumn(out, F.when(any_null(df.columns), "Missing").otherwise("NoMissing"))


def exclude_keys(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Drops the rows whose key is listed."""
    return df.join(keys, on, "left_anti")


def keep_labels(df: DataFrame, labels: Iterable[str], label_col: str = "label") -> DataFrame:
    return df.where(q(label_col).isin(list(labels)))


def route_by_group(df: DataFrame, group_col: str, predicate: Column, out: str = "route", hit: str = "benign",
                   miss: str = "attack") -> DataFrame:
    """Sends whole groups (files) to ``hit`` if any of their rows meets the predicate, else to ``miss``.

    The groups that are hit are found with partial aggregation. Up to a checked number they are a broadcast table,
    so that the rows stay where they are; beyond it they are joined like any other table.
    """
    hits, _ = small_table(df.where(F.coalesce(predicate, F.lit(False))).select(q(group_col).alias("_group")).distinct())
    joined = df.join(hits.withColumn("_hit", F.lit(True)), q(group_col).eqNullSafe(q("_group")), "left")
    return joined.withColumn(out, F.when(q("_hit"), hit).otherwise(miss)).drop("_hit", "_group")
