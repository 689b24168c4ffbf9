"""Seeded row order that depends on the row's key only, never on partitioning."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from .names import q

# At most 16^4 equally likely prefixes of the hash: the unit in which large groups are divided.
MAX_DIGITS = 4
CELLS = 16 ** MAX_DIGITS


def order_hash(seed: int | str, key: list[str]) -> Column:
    """md5 of the seed and the key texts, joined by ``:``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[q(k).cast("string") for k in key]))


def cell_digits(partitions: int) -> int:
    """Hash digits for at least 16 cells per shuffle partition, so that one group fills all partitions evenly."""
    return next((d for d in range(2, MAX_DIGITS) if 16 ** d >= 16 * partitions), MAX_DIGITS)


def hash_cell(digest: Column, digits: int = MAX_DIGITS) -> Column:
    """Number of the cell of an md5 text, which grows with the text."""
    return F.coalesce(F.conv(F.substring(digest, 1, digits), 16, 10).cast("int"), F.lit(0))
