"""Row-wise preparation of a stream with the same operators as a table.

These operators look at one row at a time and run no job of their own, so a streaming DataFrame can take them as it is.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..operators.columns import drop_columns, normalize_names, normalize_nulls, resolve_label
from ..operators.rules import PORTS, apply_rules, drop_sentinel_rows, rule_non_negative, rule_range


def prepare_stream(df: DataFrame, label_col: str = "label", drop: Iterable[str] = (), sentinel_columns: Iterable[str] = (),
                   ports: Iterable[str] = PORTS) -> DataFrame:
    """Normalised names and NULLs, the label under its name, invalid rows and rows with sentinel text only dropped."""
    df = resolve_label(normalize_names(drop_columns(df, drop)), label_col, missing="unknown")
    df = normalize_nulls(df)
    df = apply_rules(df, [*rule_non_negative(df), *rule_range(df, ports)])
    columns = [c for c in sentinel_columns if c in df.columns]
    return drop_sentinel_rows(df, columns) if columns else df
