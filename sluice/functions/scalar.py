"""Scalar expressions. Everything here is a native column expression without UDFs."""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F, types as T

from .names import is_numeric, q

# The texts that count as a missing value.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Number syntax. Spark alone would also accept "1d" and "1f", other engines "1_0".
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INF_WORDS = ("inf", "+inf", "infinity", "+infinity")
MINUS_INF_WORDS = ("-inf", "-infinity")
NAN_WORDS = ("nan", "+nan", "-nan")

# Half-open dominance ranges (low, high, name); the last one takes 1.0 in.
DOMINANCE_RANGES = ((0.50, 0.60, "50-60%"), (0.60, 0.70, "60-70%"), (0.70, 0.80, "70-80%"),
                    (0.80, 0.90, "80-90%"), (0.90, 0.95, "90-95%"), (0.95, 1.01, "95-100%"))

_INF = float("inf")


def numeric(name: str, dtype: T.DataType) -> Column:
    """The column as a double; NaN and text that is no number become NULL."""
    c = q(name)
    if is_numeric(dtype):
        value = c.cast("double")
        return F.when(~F.isnan(value), value) if isinstance(dtype, (T.DoubleType, T.FloatType)) else value
    if isinstance(dtype, T.BooleanType):
        return c.cast("double")
    text = c.cast("string")
    # Casting the words would work, too, but by way of a costly exception per row.
    word = F.lower(F.trim(text))
    return (F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
            .when(word.isin(*INF_WORDS), F.lit(_INF)).when(word.isin(*MINUS_INF_WORDS), F.lit(-_INF)))


def is_inf(value: Column) -> Column:
    """True for +-infinity, never NULL."""
    return F.coalesce(F.abs(value) == F.lit(_INF), F.lit(False))


def classify_value(name: str, dtype: T.DataType, value: Column | None = None) -> Column:
    """``NaN``, ``inf``, ``integer`` (any whole number), ``float`` or ``string``.

    ``value`` is the column as a number, if an earlier step has read it; the test needs it more than once.
    """
    value = numeric(name, dtype) if value is None else value
    c = q(name)
    kind = F.when(c.isNull(), "NaN")
    if is_numeric(dtype):
        kind = kind.when(value.isNull(), "NaN")
    else:
        kind = kind.when(value.isNull(), F.when(F.lower(F.trim(c.cast("string"))).isin(*NAN_WORDS), "float").otherwise("string"))
    return kind.when(is_inf(value), "inf").when(value % 1 == 0, "integer").otherwise("float")


def class_of(label: Column, benign: str = "benign") -> Column:
    """``benign`` or ``attack``, ignoring case and outer spaces; NULL stays NULL."""
    return F.when(label.isNull(), F.lit(None)).when(F.lower(F.trim(label)) == benign.lower(), "benign").otherwise("attack")


def safe_name(label: Column) -> Column:
    """Keeps letters, digits, ``-`` and ``_``, so the text can be part of a file name."""
    return F.regexp_replace(label, r"[^\p{L}\p{N}_-]", "")


def bucket_ratio(ratio: Column) -> Column:
    """Name of the dominance range, NULL below the first."""
    kind = None
    for low, high, name in DOMINANCE_RANGES:
        hit = (ratio >= low) & (ratio < high)
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    return kind


def contains_text(c: Column, text: str, ignore_case: bool = True) -> Column:
    """Substring test that is False for NULL."""
    c = c.cast("string")
    hit = F.lower(c).contains(text.lower()) if ignore_case else c.contains(text)
    return F.coalesce(hit, F.lit(False))


def any_null(columns: list[str]) -> Column:
    """True where at least one of the columns is NULL."""
    return reduce(or_, [q(c).isNull() for c in columns], F.lit(False))


def half_even(value: Column) -> Column:
    """Rounds to a whole number, halves to the even neighbour."""
    return F.bround(value, 0).cast("bigint")


def direction(value: Column) -> Column:
    return F.when(value > 0, "high").otherwise("low")


def explain_text(label: Column, features: Column, signs: Column) -> Column:
    """One sentence from two arrays of equal length. Fixed format: ``<label> predicted because: a was high, b was low``."""
    parts = F.zip_with(features, signs, lambda f, s: F.concat(f, F.lit(" was "), s))
    return F.concat(label, F.lit(" predicted because: "), F.array_join(parts, ", "))
