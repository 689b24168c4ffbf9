"""Column names and types."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quoted(name: str) -> str:
    """The name in backticks, so dots and spaces in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def q(name: str) -> Column:
    return F.col(quoted(name))


def dtypes(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``numeric`` or ``string`` columns, in table order."""
    test = {"numeric": is_numeric, "string": lambda t: isinstance(t, T.StringType)}[kind]
    return [name for name, dtype in dtypes(df).items() if test(dtype)]
