"""The usual orders in which the operators are put together."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..functions import q
from ..operators.balance import balance_targets, oversample
from ..operators.columns import align_to, drop_columns, normalize_names, normalize_nulls, resolve_label
from ..operators.models import TrainedModel, score_batch, train_forest
from ..operators.profile import (constant_columns, dominance, inf_report, label_distribution, low_variance_columns,
                                 missing_report, mixed_type_report)
from ..operators.repair import repair_numbers
from ..operators.rules import PORTS, apply_rules, drop_missing_for_labels, rule_non_negative, rule_range, rule_report
from ..operators.sampling import bounded_parts, shuffle
from ..sources import read_folder, write_parts_by_group, write_table


def merge_folder(spark: SparkSession, folder: str, out: str, seed: int = 42, partitions: int | None = None, fmt: str = "csv") -> DataFrame:
    """Reads every file below a folder by name, shuffles the rows and writes them as one table."""
    merged = read_folder(spark, folder, source_col=None)
    shuffled = shuffle(merged, key=None, seed=seed)
    write_table(shuffled, out, fmt, partitions)
    return merged


def audit(df: DataFrame, label_col: str = "label", max_unique: int = 5, min_ratio: float = 0.5) -> dict[str, DataFrame]:
    """The reports on a table that come before cleaning it."""
    df = normalize_nulls(resolve_label(df, label_col, missing="unknown"))
    rules = [*rule_non_negative(df), *rule_range(df)]
    return {"labels": label_distribution(df, label_col), "missing": missing_report(df), "infinite": inf_report(df),
            "mixed": mixed_type_report(df), "constant": constant_columns(df), "low_variance": low_variance_columns(df, max_unique),
            "dominance": dominance(df, min_ratio=min_ratio), "rules": rule_report(df, rules, label_col)}


def clean_table(df: DataFrame, sentinel_columns: Iterable[str] = (), drop: Iterable[str] = (), inf_threshold: float = 0.30,
                ports: Iterable[str] = PORTS) -> DataFrame:
    """Missing values to NULL, invalid rows out, infinite columns out, remaining infinities and sentinel texts to the median."""
    df = normalize_nulls(drop_columns(df, drop))
    df = apply_rules(df, [*rule_non_negative(df), *rule_range(df, ports)])
    return repair_numbers(df, sentinel_columns, inf_threshold)


def missing_parts(df: DataFrame, path: str, label_col: str = "label", delete_for: Iterable[str] | str = "none", key=None,
                  seed: int | None = 42, fmt: str = "csv", **limits) -> DataFrame:
    """Separates complete from incomplete rows and writes part files of bounded size per class and label."""
    kept = drop_missing_for_labels(df, delete_for, label_col)
    parts = bounded_parts(kept, label_col, shuffle_seed=seed, key=key, **limits)
    write_parts_by_group(parts, path, ["status", "class", "label_name", "part"], fmt)
    return parts


def balance_train_score(train: DataFrame, test: DataFrame, features: list[str], key: str, label_col: str = "label", ratio: float = 1.0,
                        method: str = "smote", **options) -> tuple[TrainedModel, DataFrame]:
    """Balances the training table, trains a forest on it, and scores the test table aligned to its features."""
    train, test = normalize_names(train), normalize_names(test)
    targets = balance_targets(train, ratio, label_col)
    balanced = oversample(train, targets, features, label_col, key, method).drop("synthetic")
    model = train_forest(balanced.select(*[q(c) for c in features], q(label_col)), label_col, features, **options)
    return model, score_batch(model, align_to(test, features, label_col=label_col))
