"""Training-order materialisation: token sequences at global slots of a keyed permutation, in shards of fixed stride.

1. Every task of the scan encodes its documents with a byte-pair vocabulary, joins them with the end token and cuts the
   stream into sequences of ``length`` tokens, the last one filled with end tokens. A token is at least one byte, so the
   bytes of a task bound its sequences; these bounds, added up, number all sequences without encoding anything twice.
2. A Feistel network of four keyed rounds on the smallest even number of bits that holds the numbers, walked until the
   result is a number again, permutes them. This assigns every sequence its place in the global order.
3. Places are cut into equal ranges, one shard each; the permutation makes them even. A task sorts its ranges and writes
   each as records of ``length`` tokens, little-endian, without headers: record ``i`` of a shard begins at byte ``i * stride``.
   Places that the bounds left unused are skipped, so slots count records without gaps; the index says where each shard
   begins. A shard appears under its name when it is whole, and a repeated task writes the same bytes.

The documents must be a table scan, whose tasks are the same on every reading; ``written_first`` makes one of anything else.
"""
from __future__ import annotations

import base64
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import local_table, scratch_path, written
from .words import mix

#: Fixed value: the pattern that cuts text before the merges of the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as the pattern has it, in runs that are too long for its search: what is left of such a run is one piece.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ROUNDS = 4


class Encoder:
    """Byte-pair encoding by a rank file; the end token is the first free id."""

    def __init__(self, ranks_path: str):
        import tiktoken
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.end = len(ranks)
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind = np.dtype("<u2") if self.end < 1 << 16 else np.dtype("<u4")

    def __call__(self, text: str) -> np.ndarray:
        """The text's tokens and the end token."""
        return np.append(np.concatenate(list(self._parts(text))), self.end).astype(self.kind)

    def _parts(self, text: str) -> Iterator[np.ndarray]:
        """The tokens between long runs of white space and those of the runs. Of a run before something else the last sign
        belongs to what follows."""
        begin = 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            if begin < run.start():
                yield self.encoding.encode_to_numpy(text[begin:run.start()])
            yield np.array(self.encoding._encode_single_piece(text[run.start():end]))
            begin = end
        yield self.encoding.encode_to_numpy(text[begin:])


_encoders: dict[tuple, Encoder] = {}


def encoder(ranks_path: str) -> Encoder:
    """The process's encoder for a rank file."""
    if ranks_path not in _encoders:
        _encoders[ranks_path] = Encoder(ranks_path)
    return _encoders[ranks_path]


def permuted(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """The keyed permutation of 0 .. size - 1 at ``numbers``: a Feistel network with cycle walking."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key) * np.uint64(ROUNDS + 1))
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        x = out[walking]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[walking] = left << np.uint64(half) | right
        walking = walking[out[walking] >= np.uint64(size)]
    return out


def _squeezed(tokens: np.ndarray) -> bytes:
    """Tokens for the shuffle: byte planes, compressed."""
    planes = np.ascontiguousarray(tokens.view(np.uint8).reshape(len(tokens), -1).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _restored(squeezed: bytes, length: int, kind: np.dtype) -> bytes:
    planes = np.frombuffer(pa.decompress(squeezed, length * kind.itemsize, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, length).T).tobytes()


def _sequences(docs: DataFrame, bases: dict[int, tuple[int, int]], size: int, length: int, key: int, ranks_path: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(bases)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = encoder(ranks_path)
        task = TaskContext.get().partitionId()
        number, behind = shared.value.get(task, (None, None))
        waiting, held = [np.zeros(0, encode_text.kind)], 0
        begun: list[tuple[int, object]] = []  # where documents begin in what waits
        open_doc = None

        def flush(whole: bool) -> pa.RecordBatch:
            nonlocal waiting, held, begun, number, open_doc
            count = held // length if not whole else -(-held // length)
            if number + count > behind:
                raise RuntimeError(f"task {task} has more text than when tasks were numbered; the scan was dealt out anew")
            stream = np.concatenate(waiting)
            tokens = np.full(count * length, encode_text.end, encode_text.kind)
            used = min(held, count * length)
            tokens[:used] = stream[:used]
            rows, at = [], 0
            for i in range(count):
                first, starts = open_doc, 0
                while at < len(begun) and begun[at][0] < (i + 1) * length:
                    open_doc = begun[at][1]
                    if begun[at][0] == i * length:
                        first = open_doc
                    starts, at = starts + 1, at + 1
                rows.append((first, starts, min(length, used - i * length)))
            begun, waiting, held = [(p - used, d) for p, d in begun[at:]], [stream[used:]], held - used
            places = permuted(np.arange(number, number + count), size, key)
            number += count
            payload = [_squeezed(tokens[i * length:(i + 1) * length]) for i in range(count)]
            return pa.RecordBatch.from_arrays([pa.array(places.astype(np.int64)), pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int32()),
                                               pa.array([r[2] for r in rows], pa.int32()), pa.array(payload, pa.binary())], names=["place", "first_doc", "n_docs", "n_tokens", "payload"])

        kind = None
        for batch in batches:
            if number is None and batch.num_rows:
                raise RuntimeError(f"task {task} had no rows when tasks were numbered; the scan was dealt out anew")
            kind = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if text:
                    begun.append((held, doc))
                    waiting.append(encode_text(text))
                    held += len(waiting[-1])
                if held > 256 * length:
                    yield flush(False)
        if kind is not None and held:
            yield flush(True)

    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("first_doc", docs.schema["id"].dataType),
                           *T.StructType.fromDDL("n_docs int, n_tokens int, payload binary").fields])
    return docs.mapInArrow(encode, schema)


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, key: int = 1, places_per_shard: int = 16384,
                 ranks_path: str = RANKS, written_first: bool = False) -> DataFrame:
    """Writes the shards below ``path`` and returns their index: (slot, shard, byte_offset, n_tokens, n_docs, first_doc, crc32).

    One row per sequence. ``slot`` counts from 0 without gaps in the order of shards and records; ``n_docs`` documents begin
    in the sequence, ``first_doc`` is the document of its first token. NULL and empty texts give no tokens. Repeated rows
    are encoded as often as they stand there. An empty table gives no shard and an empty index.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    plain = written(plain, "texts") if written_first else plain
    amount = F.when(F.octet_length("text") > 0, F.octet_length("text").cast("long") + 1).otherwise(0)
    bounds = sorted(tuple(r) for r in plain.select(F.col("id"), amount.alias("n"), F.spark_partition_id().alias("task")).groupBy("task").agg(F.sum("n"), F.count("id")).collect())
    bases, size = {}, 0
    for task, tokens, _ in bounds:
        bases[task] = size, size - (-tokens // length)
        size = bases[task][1]
    shards = max(1, -(-size // places_per_shard))
    stride = length * encoder(ranks_path).kind.itemsize
    shard = F.floor(F.col("place") / places_per_shard).cast("int")
    sorted_ = (_sequences(plain, bases, size, length, key, ranks_path).withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard", "place"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(ranks_path).kind
        store, folder = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        store.create_dir(f"{folder}/_writing", recursive=True)
        current = out = None
        position = 0

        def finish() -> None:
            if out is not None:
                out.close()
                store.move(name, f"{folder}/shard-{current:08d}.bin")

        for batch in batches:
            of, payload = batch.column("shard").to_pylist(), batch.column("payload")
            at, sums = [], []
            for i, s in enumerate(of):
                if s != current:
                    finish()
                    current, position, name = s, 0, f"{folder}/_writing/{s}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(name)
                record = _restored(payload[i].as_py(), length, kind)
                out.write(record)
                at.append(position * stride)
                sums.append(zlib.crc32(record))
                position += 1
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(at, pa.int64()), batch.column("n_tokens"), batch.column("n_docs"), batch.column("first_doc"),
                                              pa.array(sums, pa.int64())], names=["shard", "byte_offset", "n_tokens", "n_docs", "first_doc", "crc32"])
        finish()

    schema = T.StructType([*T.StructType.fromDDL("shard int, byte_offset long, n_tokens int, n_docs int").fields,
                           T.StructField("first_doc", plain.schema["id"].dataType), T.StructField("crc32", T.LongType())])
    index = written(sorted_.mapInArrow(write, schema), "index")
    counts = sorted(tuple(r) for r in index.groupBy("shard").count().collect())
    begins, total = [], 0
    for s, n in counts:
        begins.append((s, total))
        total += n
    begin = F.broadcast(local_table(spark, begins, "shard int, first_slot long"))
    return index.join(begin, "shard").select((F.col("first_slot") + F.col("byte_offset") / stride).cast("long").alias("slot"), "shard", "byte_offset", "n_tokens", "n_docs", "first_doc", "crc32")


def training_order(docs: DataFrame, **how) -> DataFrame:
    """:func:`write_shards` into a new folder below the shared one."""
    return write_shards(docs, scratch_path(docs.sparkSession, "shards"), **how)
