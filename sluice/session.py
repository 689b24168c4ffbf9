"""Session for tests and the bench, and the shared folder for intermediate tables."""
from __future__ import annotations

import os
import tempfile
import uuid
from datetime import timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_session(cpus: int | str = 8, app: str = "sluice") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "12g"))
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Settings for wide tables and for names as they stand.

    Rules and profiles over many columns make large generated methods, and HotSpot leaves methods above 8000 bytes
    uncompiled. With this limit Spark runs such stages operator by operator, in methods small enough to be compiled.
    """
    # Names that differ in case only are different columns, as in the files they come from.
    spark.conf.set("spark.sql.caseSensitive", "true")
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    named = tempfile.mkdtemp(prefix="sluice-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/sluice-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: short lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> tuple[DataFrame, list | None]:
    """Fetches a table that is expected to be small, after checking that it is.

    Up to ``max_rows`` rows and about ``max_bytes`` of texts the result is a local table with a broadcast hint and the rows
    themselves. A larger one stays distributed, without a hint, and the rows are ``None``.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows or sum(len(v) for r in rows for v in r if isinstance(v, (str, bytes, bytearray))) > max_bytes:
        return df, None
    return F.broadcast(local_table(df.sparkSession, rows, df.schema)), rows


def _arrow_value(value, dtype: T.DataType):
    """The value as Arrow takes it; collected timestamps are local times without a zone."""
    if value is None:
        return None
    if isinstance(dtype, T.StructType):
        return {f.name: _arrow_value(value[f.name], f.dataType) for f in dtype.fields}
    if isinstance(dtype, T.ArrayType):
        return [_arrow_value(v, dtype.elementType) for v in value]
    if isinstance(dtype, T.TimestampType):
        return value.astimezone(timezone.utc)
    return value


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A table of a few rows that are at hand; Spark knows its size and needs no tasks to read it."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema.fields)
    arrays = [pa.array([_arrow_value(v, f.dataType) for v in c], type=a.type) for c, f, a in zip(columns, schema.fields, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)
