"""Token ids as length-delimited binary records, with a separate offset index for shuffled reads.

A shard holds the documents of one key range in ascending order. `part-NNNNNN.rec` is a run of records:

    u64 length | u32 masked CRC-32 of the length's 8 bytes | payload | u32 masked CRC-32 of the payload

(little-endian; masked(c) = rotate right by 15 bits, plus 0xA282EAD8, so that a checksum of data that
holds checksums stays sound). The payload is i64 key | u8 1 if the key is null | u8 bytes per id | ids.
`part-NNNNNN.idx` has the u64 offset of each record. Shards are written under a task's own name and then
renamed, so that a repeated task leaves the same files. Paths may have any scheme that pyarrow.fs reads.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch, slices
from .ordering import MOST_BUCKETS, places
from .tokens import encoder, with_end

_HEAD = struct.Struct("<QI")
_CRC = struct.Struct("<I")
_KEY = struct.Struct("<qBB")


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def record(key: int | None, ids: np.ndarray, width: int) -> bytes:
    if width < 4 and ids.max(initial=0) >> 8 * width:
        raise ValueError(f"an id takes more than {width} bytes")
    payload = _KEY.pack(key or 0, key is None, width) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(payload))
    return b"".join((size, _CRC.pack(masked(size)), payload, _CRC.pack(masked(payload))))


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, none, width = _KEY.unpack_from(payload)
    return None if none else key, np.frombuffer(payload, f"<u{width}", offset=_KEY.size)


def read_one(stream) -> tuple[int | None, np.ndarray] | None:
    """The record that begins here, checked; None at the end."""
    head = stream.read(_HEAD.size)
    if not head:
        return None
    if len(head) < _HEAD.size:
        raise ValueError("a record's length is cut off")
    size, check = _HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("a record's length doesn't match its checksum")
    payload, check = stream.read(size), stream.read(_CRC.size)
    if len(payload) < size or len(check) < _CRC.size or masked(payload) != _CRC.unpack(check)[0]:
        raise ValueError("a record doesn't match its checksum")
    return parse(payload)


def read_at(folder: str, shard: int, nth: int) -> tuple[int | None, np.ndarray]:
    """One record by its place, through the offset index."""
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{base}/part-{shard:06d}.idx") as index:
        index.seek(8 * nth)
        offset = struct.unpack("<Q", index.read(8))[0]
    with fs.open_input_file(f"{base}/part-{shard:06d}.rec") as data:
        data.seek(offset)
        found = read_one(data)
    if found is None:
        raise IndexError(nth)
    return found


class _Shard:
    """A shard as it is written: a stream under a name of its own, renamed at the end."""

    def __init__(self, folder: str, number: int):
        self.fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        self.path, self.number = f"{base}/part-{number:06d}", number
        self.temporary = f"{base}/_{uuid.uuid4().hex}"
        self.stream, self.at, self.offsets, self.ids = self.fs.open_output_stream(self.temporary), 0, [], 0

    def add(self, key: int | None, ids: np.ndarray, width: int) -> None:
        data = record(key, ids, width)
        self.offsets.append(self.at)
        self.stream.write(data)
        self.at += len(data)
        self.ids += len(ids)

    def close(self) -> tuple[int, int, int]:
        self.stream.close()
        with self.fs.open_output_stream(f"{self.temporary}i") as index:
            index.write(np.array(self.offsets, "<u8").tobytes())
        self.fs.move(f"{self.temporary}i", f"{self.path}.idx")
        self.fs.move(self.temporary, f"{self.path}.rec")
        return self.number, len(self.offsets), self.ids


#: Text of a shard, unless there would be over MOST_BUCKETS of them.
SHARD_BYTES = 32 << 20


def write_records(df: DataFrame, folder: str, tokenizer: str, end: int, width: int = 2, key: str = "doc_id", text: str = "text", bucket_rows: int | None = None) -> list[tuple[int, int, int]]:
    """Encodes and writes all rows; returns (shard, records, ids) of each shard, in order (a row per key range).

    Null texts count as empty: a record with the end id alone. Rows with equal keys follow each other by
    the beginning of their texts, then by a hash; null keys come last; identical rows are spread over
    shards. A very long text is one record. An empty table writes no shard; other columns are dropped.
    `width`: bytes per id; an id that does not fit is an error.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer).encode, None
        for batch in batches:
            for rows in slices(batch, 1):
                ids, ends = with_end(*encode(rows.column(1)), end)
                shard = shard or _Shard(folder, TaskContext.get().partitionId())
                for i, k in enumerate(rows.column(0).to_pylist()):
                    shard.add(k, ids[ends[i] : ends[i + 1]], width)
        done = [shard.close()] if shard else []
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.int64()) for i in range(3)], names=["shard", "records", "ids"])

    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    rows = df.select(F.col(key).cast("long").alias(key), text)
    size = F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 64)
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    shards = n // bucket_rows + 1 if bucket_rows else total // max(SHARD_BYTES, total // MOST_BUCKETS) + 1
    # a task's number is its range's; rows that are the same are told apart by their place in the input, so that they fall into several ranges
    order = ["o_null", "o_key", "o_begin", "o_hash", "o_at"]
    placed = rows.select("*", *places(key, text), F.monotonically_increasing_id().alias("o_at"))
    ordered = placed.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    found = ordered.select(key, text).mapInArrow(write, "shard long, records long, ids long").collect()
    return sorted(tuple(r) for r in found)


def read_records(spark: SparkSession, folder: str, shards: list[tuple[int, int, int]], key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each record, read from the files; start counts the ids of all shards and records before."""
    starts = np.concatenate([[0], np.cumsum([x[2] for x in shards])]).astype(np.int64) if shards else [0]
    rows = [(int(s), int(a)) for (s, _, _), a in zip(shards, starts, strict=False)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out: tuple[list, ...] = ([], [], [], [])
                with fs.open_input_stream(f"{base}/part-{shard:06d}.rec", buffer_size=1 << 20) as stream:
                    while (got := read_one(stream)) is not None:
                        for column, value in zip(out, (got[0], start, len(got[1]), zlib.crc32(got[1].astype("<u4").tobytes())), strict=True):
                            column.append(value)
                        start += len(got[1])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=[key, "start", "n_tokens", "ids_crc32"])

    table = spark.createDataFrame(rows, "shard long, start long")
    return table.repartition(max(1, min(len(rows), 4 * spark.sparkContext.defaultParallelism))).mapInArrow(read, T.StructType([T.StructField(x, T.LongType()) for x in (key, "start", "n_tokens", "ids_crc32")]))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch(spark, "records")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_records(spark, folder, write_records(docs, folder, public_tokenizers.path("word_bpe_49k.json"), 2))
