"""Packing token pieces into sequences: shortest pack first over the length histogram.

Texts are encoded and cut into pieces of at most `capacity` ids. Only the histogram of piece lengths
(`capacity` rows at most) goes to the driver. There lengths are placed longest first, each on the packs
that are shortest so far, as whole counts: a pattern is a list of lengths with the number of packs that
have it. A pattern's slots take stretches of ranks of a length, so that a piece finds its sequence and
offset from its length and its rank among pieces of that length alone.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, slices
from .tokens import encoder, with_end

CAPACITY = 1024
#: Slots are broadcast up to this number of rows (40 bytes each).
BROADCAST_SLOTS = 200_000


def place(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, rank_from, rank_to, sequence_from, offset): rank r sits in sequence_from + r - rank_from."""
    packs: list[tuple[int, int, int]] = []  # a heap of (length so far, first sequence, number of packs)
    slots, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if packs and packs[0][0] + length <= capacity:
                so_far, first, count = heapq.heappop(packs)
                if count > left:
                    heapq.heappush(packs, (so_far, first + left, count - left))
                    count = left
            else:
                so_far, first, count = 0, sequences, -(-left // max(1, capacity // length))
                sequences += count
            slots.append((length, rank, rank + count, first, so_far))
            rank, left = rank + count, left - count
            if so_far + length < capacity:
                heapq.heappush(packs, (so_far + length, first, count))
    return slots


def pieces(df: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, and its place (part, nth) among pieces of its length."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen, part = encoder(tokenizer), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for rows in slices(batch, 1):
                ids, ends = with_end(*tokens.encode(rows.column(1)), end)
                sizes = np.diff(ends)
                many = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), many)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * capacity
                length = np.minimum(sizes[row] - start, capacity)
                begin = ends[row] + start
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length[order])
                nth = np.empty(len(order), np.int64)
                nth[order] = np.arange(len(order)) - first + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(row)), *map(pa.array, (start, length, np.array(crc, np.int64), sizes[row], np.full(len(row), part, np.int64), nth))], names=[key, "start", "length", "ids_crc32", "doc_tokens", "part", "nth"])

    fields = [T.StructField(key, df.schema[key].dataType), *[T.StructField(x, T.LongType()) for x in ("start", "length", "ids_crc32", "doc_tokens", "part", "nth")]]
    return df.select(key, text).mapInArrow(encode, T.StructType(fields))


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (length, part, nth); read twice, so give it a written table."""
    spark = cut_pieces.sparkSession
    counts = cut_pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = place(histogram, capacity)
    table = spark.createDataFrame(slots or [(0, 0, 0, 0, 0)], "s_length long, rank_from long, rank_to long, sequence_from long, offset long")
    table = F.broadcast(table) if len(slots) <= BROADCAST_SLOTS else table
    ranked = cut_pieces.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    found = ranked.join(table, (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
    found = found.withColumn("sequence_id", F.col("sequence_from") + F.col("rank") - F.col("rank_from"))
    return found.drop("s_length", "rank_from", "rank_to", "sequence_from", "before", "rank", "part", "nth")


def pack_documents(df: DataFrame, tokenizer: str, end: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Encodes (doc_id, text), cuts and packs: one row per piece.

    A null or empty text is one piece with the end id alone. Null and repeated doc_ids are rows like any
    other: each row has pieces of its own. A very long text is encoded whole and cut into as many pieces as
    it takes. An empty table gives an empty table; other columns are dropped.
    """
    done = pack(cut(pieces(df, tokenizer, end, capacity), "pieces"), capacity)
    return done.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
