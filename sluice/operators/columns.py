"""Operators on columns and column names."""
from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import NA_TOKENS, dtypes, q, quoted
from ..session import local_table, small_table


def normalize_nulls(df: DataFrame, tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Turns missing-value texts and NaN into NULL."""
    tokens = list(tokens)
    out = []
    for name, dtype in dtypes(df).items():
        c = q(name)
        if isinstance(dtype, T.StringType):
            c = F.when(~c.isin(tokens), c)
        elif isinstance(dtype, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(name))
    return df.select(*out)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drops columns by exact name; unknown names are ignored."""
    names = set(names)
    return df.select(*[q(c) for c in df.columns if c not in names])


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case column names without outer spaces."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def numbered_repeats(header: Iterable[str]) -> list[str]:
    """Gives repeated names a running suffix: ``a, a`` becomes ``a, a.1``."""
    taken: set[str] = set()
    repeats: dict[str, int] = {}
    out = []
    for name in header:
        new = name
        while new in taken:
            repeats[name] = repeats.get(name, 0) + 1
            new = f"{name}.{repeats[name]}"
        taken.add(new)
        out.append(new)
    return out


def base_name(name: str, legacy: bool = False) -> str:
    """The name without its repeat suffix; ``legacy`` cuts at the first dot, whatever follows."""
    return name.split(".", 1)[0] if legacy else re.sub(r"\.\d+$", "", name)


def duplicate_column_names(columns: Iterable[str], legacy: bool = False) -> dict[str, list[str]]:
    """Base name -> column names, for the base names that occur more than once."""
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault(base_name(c, legacy), []).append(c)
    return {base: names for base, names in groups.items() if len(names) > 1}


def dedupe_columns(df: DataFrame, legacy: bool = False, base_fn: Callable[[str], str] | None = None) -> DataFrame:
    """Keeps the first column of each base name."""
    base_fn = base_fn or (lambda c: base_name(c, legacy))
    first: dict[str, str] = {}
    for c in df.columns:
        first.setdefault(base_fn(c), c)
    return df.select(*[q(c) for c in first.values()])


def resolve_label(df: DataFrame, label_col: str = "label", missing: str = "error") -> DataFrame | None:
    """Renames the first column that matches ``label_col`` (ignoring case and outer spaces).

    Without such a column: ``error`` raises, ``skip`` returns None, ``unknown`` adds the constant ``Unknown``.
    """
    hit = next((c for c in df.columns if c.strip().lower() == label_col.lower()), None)
    if hit is not None:
        return df.toDF(*[label_col if c == hit else c for c in df.columns])
    if missing == "skip":
        return None
    if missing == "unknown":
        return df.withColumn(label_col, F.lit("Unknown"))
    raise ValueError(f"no column {label_col!r} in {df.columns}")


def align_to(df: DataFrame, reference: DataFrame | Iterable[str], fill=0, label_col: str = "label",
             keep_label: bool = True) -> DataFrame:
    """Gives ``df`` the feature columns of ``reference`` in that order; missing ones are filled.

    The label is no feature. With ``keep_label`` it is appended when ``df`` has it.
    """
    wanted = reference.columns if isinstance(reference, DataFrame) else list(reference)
    wanted = [c for c in wanted if c != label_col]
    have = set(df.columns)
    out = [q(c) if c in have else F.lit(fill).alias(c) for c in wanted]
    if keep_label and label_col in have:
        out.append(q(label_col))
    return df.select(*out)


def align_report(df: DataFrame, reference: DataFrame | Iterable[str], label_col: str = "label") -> DataFrame:
    """One row per column that :func:`align_to` adds or removes."""
    wanted = reference.columns if isinstance(reference, DataFrame) else list(reference)
    wanted = [c for c in wanted if c != label_col]
    have = [c for c in df.columns if c != label_col]
    rows = ([(c, "added") for c in wanted if c not in set(have)]
            + [(c, "removed") for c in have if c not in set(wanted)])
    return local_table(df.sparkSession, rows, "`column` string, action string")


def add_flag(df: DataFrame, condition: Column, name: str, after: str | None = None) -> DataFrame:
    """Adds ``condition`` as 0/1, right behind the column ``after`` (or last)."""
    flag = F.coalesce(condition, F.lit(False)).cast("int").alias(name)
    out: list[Column] = []
    for c in df.columns:
        out.append(q(c))
        if c == after:
            out.append(flag)
    return df.select(*out, *([] if after in df.columns else [flag]))


def split_xy(df: DataFrame, label_col: str = "label") -> tuple[list[str], str]:
    """Feature names and label name."""
    return [c for c in df.columns if c != label_col], label_col


def encode_label(df: DataFrame, label_col: str = "label", out: str = "label_index") -> DataFrame:
    """Adds the 0-based position of the label among the sorted distinct labels; NULL stays NULL."""
    return df.join(label_index(df, label_col, out), q(label_col) == q("_label"), "left").drop("_label")


def decode_label(df: DataFrame, index: DataFrame, index_col: str = "label_index", out: str = "decoded") -> DataFrame:
    """Adds the label that belongs to an index of :func:`label_index`."""
    names = index.select(q("_label").alias(out), q("label_index").alias("_index"))
    return df.join(names, q(index_col) == q("_index"), "left").drop("_index")


def label_index(df: DataFrame, label_col: str = "label", out: str = "label_index") -> DataFrame:
    """``(_label, index)``: the sorted distinct labels. A few are fetched, numbered and broadcast; many stay a table."""
    labels = df.where(q(label_col).isNotNull()).select(q(label_col).cast("string").alias("_label")).distinct()
    _, rows = small_table(labels)
    if rows is None:
        from .ranking import number_rows
        return number_rows(labels, (), "_label", out="_rn").select("_label", (q("_rn") - 1).cast("int").alias(out))
    numbered = [(v, i) for i, v in enumerate(sorted((r[0] for r in rows), key=lambda v: v.encode()))]
    return F.broadcast(local_table(df.sparkSession, numbered, f"_label string, {quoted(out)} int"))
