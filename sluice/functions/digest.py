"""128-bit digests of rows, so that counting and comparing rows moves 16 bytes for each and not the row."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .names import q

DIGEST = ("_d1", "_d2")


def digest_columns(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """Two 64-bit hashes of the columns as ``_d1`` and ``_d2``: equal for equal rows, where NULL equals NULL, NaN equals NaN
    and 0.0 equals -0.0. Different rows share both with a probability of 2^-128 per pair."""
    parts = [e for c in (df.columns if columns is None else columns) for e in (F.isnull(q(c)), q(c))]
    return [F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in enumerate(DIGEST)]
