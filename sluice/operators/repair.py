"""Repairs. Each runs one profile first, because its constants or its schema depend on the data."""
from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from ..functions import dtypes, is_inf, numeric, q
from .columns import add_flag
from .profile import inf_report, median_values
from .rules import SENTINEL, sentinel_tests


def inf_shares(df: DataFrame) -> dict[str, float]:
    """The columns that hold infinity, and their share of it."""
    return {r["column"]: r["share"] for r in inf_report(df).collect()}


def impute_inf(df: DataFrame, columns: Iterable[str] | None = None, middle: dict[str, float | None] | None = None) -> DataFrame:
    """Replaces +-infinity by the median of the column's finite numbers.

    Only columns that hold infinity are touched; text in them that is no number becomes NULL, and NULL stays NULL.
    A column without any finite number gets NULL. Columns and medians may be passed in to spare their jobs.
    """
    if middle is None:
        middle = median_values(df, inf_shares(df) if columns is None else columns)
    affected, types = list(middle if columns is None else columns), dtypes(df)
    # Reading the numbers is a step of its own, so that the text of a value is parsed once.
    read = df.select(*[numeric(c, types[c]).alias(c) if c in affected else q(c) for c in df.columns])
    fixed = {c: F.when(is_inf(q(c)), F.lit(middle[c]).cast("double")).otherwise(q(c)).alias(c) for c in affected}
    return read.select(*[fixed.get(c, q(c)) for c in df.columns])


def drop_inf_columns(df: DataFrame, threshold: float = 0.30) -> DataFrame:
    """Drops columns in which more than ``threshold`` of all rows are +-infinity."""
    shares = inf_shares(df)
    return df.select(*[q(c) for c in df.columns if shares.get(c, 0) <= threshold])


def remediate_inf(df: DataFrame, threshold: float = 0.30) -> tuple[DataFrame, DataFrame]:
    """Drops the worst columns and imputes the others: ``(repaired table, report of what remained after dropping)``."""
    shares = inf_shares(df)
    kept = df.select(*[q(c) for c in df.columns if shares.get(c, 0) <= threshold])
    left = [c for c in kept.columns if c in shares]
    return impute_inf(kept, left), inf_report(kept)


def fill_sentinel_with_median(df: DataFrame, columns: Iterable[str], text: str = SENTINEL, flag: str = "handshake_incomplete",
                              ignore_case: bool = True, middle: dict[str, float | None] | None = None) -> DataFrame:
    """Flags rows in which any of the columns holds the text, then fills everything that is no number with the median."""
    columns, types = list(columns), dtypes(df)
    middle = median_values(df, columns, exclude_inf=False) if middle is None else middle
    condition = reduce(or_, sentinel_tests(columns, text, ignore_case))
    flagged = add_flag(df, condition, flag, after=columns[-1])
    filled = {c: F.coalesce(numeric(c, types[c]), F.lit(middle[c]).cast("double")).alias(c) for c in columns}
    return flagged.select(*[filled.get(c, q(c)) for c in flagged.columns])


def repair_numbers(df: DataFrame, sentinel_columns: Iterable[str] = (), inf_threshold: float = 0.30, text: str = SENTINEL) -> DataFrame:
    """Drops the columns with too much infinity, imputes the rest and fills sentinel texts, with one report and one median job.

    A sentinel column that holds infinity needs no second median: adding copies of a median leaves it where it is. Its
    flag is taken before its text is read as numbers.
    """
    shares = inf_shares(df)
    kept = df.select(*[q(c) for c in df.columns if shares.get(c, 0) <= inf_threshold])
    sentinels = [c for c in sentinel_columns if c in kept.columns]
    affected = [c for c in kept.columns if c in shares]
    middle = median_values(kept, dict.fromkeys([*affected, *sentinels]))
    if sentinels:
        flag = add_flag(kept, reduce(or_, sentinel_tests(sentinels, text)), "handshake_incomplete", after=sentinels[-1])
        kept = impute_inf(flag, affected, middle)
        types = dtypes(kept)
        filled = {c: F.coalesce(numeric(c, types[c]), F.lit(middle[c]).cast("double")).alias(c) for c in sentinels}
        return kept.select(*[filled.get(c, q(c)) for c in kept.columns])
    return impute_inf(kept, affected, middle)
