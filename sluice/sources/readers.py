"""Reading tables and folders of files, and looking at their headers."""
from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby, repeat
from operator import itemgetter, or_
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import q
from ..operators.columns import numbered_repeats
from ..session import local_table, written

CSV_OPTIONS = {"header": True, "escape": '"'}
FIELD_LIMIT = 1 << 30
CORRUPT = "_corrupt_record"
HEADERS = "path string, filename string, names array<string>, reason string"
CODECS = {"gz": "gzip", "bz2": "bz2", "zst": "zstd", "zstd": "zstd", "lz4": "lz4"}
WHOLE_BYTES = 256 << 20
BROADCAST_FILES = 2_000_000  # 12 bytes each


def read_table(spark: SparkSession, path: str | list[str], types: str | T.StructType = "string", columns: Iterable[str] | None = None,
               fmt: str | None = None, **options) -> DataFrame:
    """Reads one table: every column as text (``string``), with types found in the data (``infer``) or by a schema.

    The format follows the file name unless given. ``columns`` selects, so that other columns are not read.
    """
    first = path if isinstance(path, str) else path[0]
    fmt = fmt or next((f for f in ("parquet", "orc", "json") if first.rstrip("/").endswith(f)), "csv")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**{**CSV_OPTIONS, **options}).option("inferSchema", types == "infer")
    else:
        reader = reader.options(**options)
    if not isinstance(types, str):
        reader = reader.schema(types)
    df = reader.load(path)
    if columns is not None:
        df = df.select(*[q(c) for c in columns])
    if types == "string":
        df = df.select(*[q(c).cast("string").alias(c) for c in df.columns])
    return df


def with_source(df: DataFrame, out: str = "source_file", folder: bool = False) -> DataFrame:
    """Adds the name of the file (or of its folder) each row was read from."""
    place = _decoded(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)) if folder else _file_name()
    return df.select("*", place.alias(out))


def read_folder(spark: SparkSession, path: str, recursive: bool = True, include_glob: str = "*.csv", align: str = "name",
                types: str | T.StructType = "string", source_col: str | None = "source_file", exclude: str | None = None,
                on_error: str = "skip", **options) -> DataFrame:
    """Reads the files of a folder as one table.

    ``align="name"`` gives each value the name that its file's header has at that place, so that files may differ in
    columns and their order; ``position`` takes the first header for all, as does a schema in ``types``. There is one scan
    for all files: a table of files and layouts is joined to its rows, and the driver holds the distinct headers and the
    paths of files left out (and all paths where ``mode`` refuses rows and headers differ in width). ``exclude`` is a pattern of file names
    to leave out, such as earlier outputs. ``on_error="skip"`` leaves out files that cannot be read, each as a whole
    (:func:`unreadable_files` names them); ``"fail"`` raises. Further CSV options hold for rows and headers alike.
    """
    headers = header_list(spark, path, recursive, include_glob, **options)
    if exclude:
        headers = headers.where(~q("filename").rlike(exclude))
    headers = written(headers, "headers")
    if on_error == "fail" and (some := headers.where(q("reason").isNotNull()).take(5)):
        raise OSError("cannot read " + "; ".join(f"{r['path']}: {r['reason']}" for r in some))
    usable = headers.where(F.size("names") > 0)
    layouts = [r["names"] for r in usable.groupBy("names").agg(F.min("path").alias("first")).orderBy("first").collect()]
    if not layouts:
        raise FileNotFoundError(f"no readable file with a header matches {include_glob!r} below {path}")
    if align == "position" or not isinstance(types, str):
        layouts = layouts[:1]
    named = [numbered_repeats(names) for names in layouts]
    out = list(dict.fromkeys(n for names in named for n in names)) if isinstance(types, str) else types.names
    places = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(max(map(len, named)))])
    options = {"enforceSchema": True, "ignoreCorruptFiles": False, **options, "recursiveFileLookup": recursive, "pathGlobFilter": include_glob}

    # One scan by position, whatever the number of files and layouts; files are left out while Spark lists them.
    df = read_table(spark, path, places if isinstance(types, str) else types, fmt="csv", **options)
    file = F.col("_metadata.file_path")
    if exclude:
        df = df.where(~_file_name().rlike(exclude))
    if left_out := [r["path"] for r in headers.where(F.size("names") == 0).select("path").collect()]:
        df = df.where(~file.isin(left_out))
    fields = df.columns
    strict = next((str(v).upper() for k, v in options.items() if k.lower() == "mode"), "PERMISSIVE") != "PERMISSIVE"
    if len(layouts) > 1 and strict and len(set(map(len, layouts))) > 1:
        # Rows are judged by the width of their own file's header, so each layout is parsed by itself.
        parts = []
        for names, header in zip(named, layouts):
            paths = [r["path"] for r in usable.where(q("names") == F.array(*[F.lit(c) for c in header])).select("path").toLocalIterator()]
            schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
            part = read_table(spark, [unquote(p) for p in paths], schema, fmt="csv", **options)
            parts.append(with_source(part, source_col) if source_col else part)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if len(layouts) > 1:
        numbers = local_table(spark, [(names, i) for i, names in enumerate(layouts)], "names array<string>, _layout int")
        layout_of = written(usable.join(F.broadcast(numbers), "names").select(F.xxhash64("path").alias("_file"), "_layout"), "layouts")
        n, distinct = layout_of.agg(F.count(F.lit(1)), F.count_distinct("_file")).first()
        if n != distinct:
            raise RuntimeError("two files share a 64-bit hash; read them in two calls")
        df = df.select("*", F.xxhash64(file).alias("_file"), _file_name().alias("_name"))
        df = df.join(F.broadcast(layout_of) if n <= BROADCAST_FILES else layout_of, "_file")
        columns = [_by_layout(name, named) for name in out]
    else:
        df = df.select("*", _file_name().alias("_name"))
        columns = [q(f).alias(name) for f, name in zip(fields, out)]
    return df.select(*columns, *([q("_name").alias(source_col)] if source_col else []))


def _decoded(place: Column) -> Column:
    return F.url_decode(F.replace(place, F.lit("+"), F.lit("%2B")))


def _file_name() -> Column:
    return _decoded(F.col("_metadata.file_name"))


def _by_layout(name: str, layouts: list[list[str]]) -> Column:
    """The column called ``name`` from its place in each layout; NULL in the layouts without it."""
    at: dict[int, list[int]] = {}
    for number, names in enumerate(layouts):
        if name in names:
            at.setdefault(names.index(name), []).append(number)
    return F.coalesce(*[F.when(q("_layout").isin(numbers), q(f"_c{place}")) for place, numbers in at.items()]).alias(name)


def unreadable_files(spark: SparkSession, path: str, recursive: bool = True, include_glob: str = "*.csv", **options) -> DataFrame:
    """``(path, filename, reason)``: the files that :func:`read_folder` leaves out because they cannot be read to their end."""
    return header_list(spark, path, recursive, include_glob, **options).where(q("reason").isNotNull()).select("path", "filename", "reason")


def read_checked(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Reads CSV by schema and keeps the text of lines that do not fit it in ``_corrupt_record``.

    A line does not fit if it has too few or too many fields, or a text that its type cannot take.
    """
    texts = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields], T.StructField(CORRUPT, T.StringType())])
    raw = read_table(spark, path, texts, fmt="csv", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options)
    typed = {f.name: q(f.name).try_cast(f.dataType) for f in schema.fields}
    bad = reduce(or_, [q(c).isNotNull() & value.isNull() for c, value in typed.items()], q(CORRUPT).isNotNull())
    line = F.coalesce(q(CORRUPT), F.concat_ws(",", *[F.coalesce(q(c), F.lit("")) for c in typed]))
    return raw.select(*[value.alias(c) for c, value in typed.items()], F.when(bad, line).alias(CORRUPT))


def rejected_rows(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows and the bad ones of :func:`read_checked`."""
    return checked.where(q(CORRUPT).isNull()).drop(CORRUPT), checked.where(q(CORRUPT).isNotNull())


def header_list(spark: SparkSession, path: str, recursive: bool = True, include_glob: str = "*.csv", **options) -> DataFrame:
    """``(path, filename, names, reason)``: the header of each file, up to the end of its first record.

    The listing comes from Spark. Files in a store that Arrow opens are opened by the tasks; in any other store Spark's text
    reader gives the lines of each file's first split. Compressed files are read to their end, because a cut one shows only
    there (in other stores up to ``WHOLE_BYTES``; a larger one fails when its rows are read). A file that cannot be read
    has a ``reason`` and no names. ``sep``, ``quote`` and ``encoding`` are taken from the CSV options.
    """
    def load(fmt: str, **more) -> DataFrame:
        return (spark.read.format(fmt).options(recursiveFileLookup=recursive, pathGlobFilter=include_glob, **more).load(path)
                .withColumn("_path", F.col("_metadata.file_path")))

    known = {k.lower(): v for k, v in options.items()}
    style = (known.get("sep") or known.get("delimiter") or ",", known.get("quote") or '"', known.get("encoding") or known.get("charset") or "utf-8-sig")
    files = load("binaryFile").select(F.col("_path").alias("path"), "length")
    some = files.select("path").first()
    if some is None or _arrow_opens(some["path"]):
        return files.select("path").mapInPandas(_header_reader(*style), HEADERS)
    packed = F.lower(F.element_at(F.split("_path", "[.]"), -1)).isin(list(CODECS)) & (F.col("_metadata.file_size") <= WHOLE_BYTES)
    lines = load("text", lineSep="\n").where(~packed & (F.col("_metadata.file_block_start") == 0))
    plain = lines.select(F.col("_path").alias("path"), F.col("value").cast("binary").alias("line")).mapInArrow(_first_records(*style), "path string, names array<string>, reason string")
    whole = load("binaryFile").where(packed).select(F.col("_path").alias("path"), "content").mapInPandas(_header_reader(*style), HEADERS)
    found = plain.unionByName(whole.select("path", "names", "reason"))
    return (files.select("path").join(found, "path", "left")
            .select("path", _decoded(F.element_at(F.split("path", "/"), -1)).alias("filename"), F.coalesce("names", F.array().cast("array<string>")).alias("names"), "reason"))


def _arrow_opens(path: str) -> bool:
    """Whether Arrow knows the store: always for local files, else by opening one file."""
    if path.startswith("file:"):
        return True
    try:
        _open(path)[0].close()
        return True
    except (OSError, ValueError, NotImplementedError):
        return False


def _first_records(sep: str, quote: str, encoding: str):
    """The first record of each file, from its lines in order; the other lines are passed over batch by batch."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(FIELD_LIMIT)
        done = None

        def lines():
            for batch in batches:
                if batch.num_rows and not batch["path"][0].as_py() == batch["path"][-1].as_py() == done:
                    yield from zip(batch["path"].to_pylist(), batch["line"].to_pylist())

        for path, group in groupby(lines(), itemgetter(0)):
            names, reason = [], None
            try:
                texts = (line.decode(encoding if i == 0 else encoding.removesuffix("-sig"), "replace") + "\n" for i, (_, line) in enumerate(group))
                names = next(csv.reader(texts, delimiter=sep, quotechar=quote), [])
            except (LookupError, csv.Error) as error:
                reason = str(error)
            done = path
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([names], pa.list_(pa.string())), pa.array([reason], pa.string())], ["path", "names", "reason"])
    return read


def _open(path: str, content: bytes | None = None):
    """The file's bytes (or the given ones), decompressed by its suffix, and whether they are compressed."""
    if content is not None:
        system, inner = None, path
    elif path.startswith("file:"):
        system, inner = fs.LocalFileSystem(), "/" + unquote(path[5:]).lstrip("/")
    else:
        # The same store, by the name that Arrow knows it under.
        system, inner = fs.FileSystem.from_uri(unquote(path).replace("s3a://", "s3://", 1))
    suffix = inner.rsplit(".", 1)[-1].lower()
    codec = CODECS.get(suffix)
    stream = system.open_input_stream(inner, compression=None) if content is None else pa.BufferReader(content)
    return (pa.CompressedInputStream(stream, codec) if codec else stream), bool(codec)


def _header_reader(sep: str, quote: str, encoding: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(FIELD_LIMIT)
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"] if "content" in batch else repeat(None)):
                names, reason = [], None
                try:
                    stream, compressed = _open(path, content)
                    with stream:
                        text = io.TextIOWrapper(stream, encoding=encoding, errors="replace", newline="")
                        names = next(csv.reader(text, delimiter=sep, quotechar=quote), [])
                        while compressed and text.read(1 << 20):
                            pass
                except (OSError, ValueError, EOFError, NotImplementedError, csv.Error) as error:
                    names, reason = [], str(error) or type(error).__name__
                rows.append((path, unquote(path.rsplit("/", 1)[-1]), names, reason))
            yield pd.DataFrame(rows, columns=["path", "filename", "names", "reason"])
    return read


def header_inventory(spark: SparkSession, path: str, recursive: bool = True, include_glob: str = "*.csv", name_from: str = "file") -> DataFrame:
    """One row per file: its name and ``title_1..n``, padded with empty text to the longest header.

    ``name_from="folder"`` names the part files of one written table after their folder and lists each once.
    """
    headers = header_list(spark, path, recursive, include_glob).where(F.size("names") > 0)
    if name_from == "folder":
        headers = headers.select(F.element_at(F.split("path", "/"), -2).alias("filename"), "names").distinct()
    width = headers.agg(F.max(F.size("names"))).first()[0] or 0
    return headers.select("filename", *[F.coalesce(F.get("names", F.lit(i)), F.lit("")).alias(f"title_{i + 1}") for i in range(width)])


def schema_conformance(spark: SparkSession, reference: Iterable[str], path: str, recursive: bool = True, include_glob: str = "*.csv",
                       name_from: str = "file") -> DataFrame:
    """The files whose header differs from ``reference`` in names or order, with that header."""
    headers = header_list(spark, path, recursive, include_glob)
    if name_from == "folder":
        headers = headers.select(F.element_at(F.split("path", "/"), -2).alias("filename"), "names").distinct()
    return headers.where(q("names") != F.array(*[F.lit(c) for c in reference])).select("filename", "names")
