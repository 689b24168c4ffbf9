"""Writing tables."""
from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import partial
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..functions import q
from ..session import local_table, scratch_path

COPY_BYTES = 64 << 20
CHUNK = 4 << 20
LINES = ("csv", "text", "json")
#: Outer spaces belong to the values. Texts with line breaks are quoted; read them with ``multiLine=True``. An empty text is
#: written as quotes; reading takes it for NULL, too, unless told ``nullValue="\\0"``.
CSV_STYLE = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_table(df: DataFrame, path: str, fmt: str = "csv", partitions: int | None = None, single_file: bool = False,
                partition_by: list[str] | None = None) -> str:
    """Writes a table, replacing what is there; gives back the path.

    ``partitions`` writes that many parts. ``single_file`` writes one file called ``path`` itself: files of lines are joined
    from parts (:func:`merge_parts`); for other formats all rows pass through one task, which is meant for reports.
    """
    if single_file and fmt in LINES:
        return merge_parts(df, path, fmt, partitions)
    if single_file:
        folder = scratch_path(df.sparkSession, "single")
        write_table(df.coalesce(1), folder, fmt)
        _promote(df, folder, path)
        return path
    if partitions:
        df = df.repartition(partitions)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, **CSV_STYLE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def _promote(df: DataFrame, folder: str, path: str) -> None:
    """Moves the only part file of a folder to ``path`` in the file system that holds it."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(path)
    system = source.getFileSystem(conf)
    part = next(s.getPath() for s in system.listStatus(source) if s.getPath().getName().startswith("part-"))
    jvm.org.apache.hadoop.fs.FileUtil.copy(system, part, target.getFileSystem(conf), target, True, True, conf)


def merge_parts(df: DataFrame, path: str, fmt: str = "csv", parts: int | None = None) -> str:
    """Writes one file ``path`` of lines, under one header for CSV, without passing all rows through one task.

    Tasks write parts without headers beside it. Where the store is a file system that all machines mount, tasks then copy
    byte ranges of the parts to their places in the file; a repeated task writes the same bytes again. Elsewhere the store
    joins the parts itself if it can (as HDFS does); if not, the driver copies them one after the other through a buffer.
    The file appears under its name when it is whole, and replaces what was there.
    """
    if fmt not in LINES:
        raise ValueError(f"parts of {fmt} cannot be joined")
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    folder = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    style = CSV_STYLE if fmt == "csv" else {}
    (df.repartition(parts) if parts else df).write.format(fmt).options(**({"header": False} | style)).save(f"{folder}/rows")
    if fmt == "csv":
        df.limit(0).coalesce(1).write.format(fmt).options(header=True, **style).save(f"{folder}/header")
    system = hadoop.Path(folder).getFileSystem(conf)
    pieces = []  # one per written part: path and bytes
    for kind in ("header", "rows") if fmt == "csv" else ("rows",):
        found = [(s.getPath(), s.getLen()) for s in system.listStatus(hadoop.Path(f"{folder}/{kind}")) if s.getPath().getName().startswith("part-")]
        pieces += sorted((p for p in found if p[1]), key=lambda p: p[0].getName())
    whole = hadoop.Path(f"{folder}/whole")
    if system.resolvePath(hadoop.Path(folder)).toUri().getScheme() == "file":
        _copied(spark, system, hadoop, pieces, whole)
    else:
        _joined(spark, system, [p for p, _ in pieces], whole)
    target = hadoop.Path(path)
    if system.exists(target):
        system.delete(target, True)
    if not system.rename(whole, target):
        raise OSError(f"cannot rename {whole} to {target}")
    system.delete(hadoop.Path(folder), True)
    return path


def _copied(spark: SparkSession, system, hadoop, pieces: list, whole) -> None:
    """The pieces at their places in a new file, copied side by side."""
    local = lambda p: unquote(system.resolvePath(p).toUri().getRawPath())
    system.create(whole).close()
    place, ranges, total = local(whole), [], 0
    for p, size in pieces:
        source = local(p)
        ranges += [(source, at, total + at, min(COPY_BYTES, size - at)) for at in range(0, size, COPY_BYTES)]
        total += size
    system.delete(whole, False)  # with its checksums, which would not fit
    with open(place, "wb") as file:
        file.truncate(total)
    if not ranges:
        return
    table = local_table(spark, ranges, "source string, at long, place long, size long").repartition(len(ranges))
    copied = table.mapInPandas(partial(_copy, place), "size long").groupBy().sum("size").first()[0]
    if copied != total or os.path.getsize(place) != total:
        raise OSError(f"{copied} of {total} bytes were copied")


def _copy(place: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            with open(row.source, "rb") as source, open(place, "r+b") as target:
                source.seek(row.at)
                target.seek(row.place)
                left = row.size
                while left and (some := source.read(min(CHUNK, left))):
                    target.write(some)
                    left -= len(some)
                target.flush()
                os.fsync(target.fileno())
            yield pd.DataFrame({"size": [row.size - left]})


def _joined(spark: SparkSession, system, pieces: list, whole) -> None:
    """The pieces as one file, by the store itself or through the driver's buffer."""
    gateway, hadoop = spark.sparkContext._gateway, spark._jvm.org.apache.hadoop
    if pieces and system.hasPathCapability(pieces[0], "fs.capability.paths.concat"):
        rest = gateway.new_array(hadoop.fs.Path, len(pieces) - 1)
        for i, p in enumerate(pieces[1:]):
            rest[i] = p
        if len(pieces) > 1:
            system.concat(pieces[0], rest)
        system.rename(pieces[0], whole)
        return
    out = system.create(whole, True)
    try:
        for p in pieces:
            stream = system.open(p)
            try:
                hadoop.io.IOUtils.copyBytes(stream, out, CHUNK, False)
            finally:
                stream.close()
    finally:
        out.close()


def write_parts_by_group(df: DataFrame, path: str, groups: list[str], fmt: str = "csv") -> str:
    """Writes one folder per combination of ``groups`` with exactly one file in it.

    Meant for groups of bounded size, such as the numbered parts of ``bounded_parts``.
    """
    return write_table(df.repartition(*[q(g) for g in groups]), path, fmt, partition_by=groups)
