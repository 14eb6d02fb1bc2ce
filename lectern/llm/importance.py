"""Importance resampling towards a target distribution, over hashed runs of words.

Texts are read as bytes. A lookup table tells word bytes from others and lowers A-Z; words begin and end
where neighbours differ in class. Each feature (a run of 1 to `longest` words, joined by one space) goes
to the bucket of its CRC-32: the checksums of all words of a batch advance together, one byte a step,
over the words that are still that long. Counts per bucket of corpus and target give each bucket a gain,
a document's weight is the mean gain of its features, and Gumbel noise of its key makes the draw of the
highest scores a sample without replacement in proportion to the exponential of the weights.

Corpus and target are counted whole. Only the counts go to the driver, a row per bucket.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, row_numbers, slices, table

#: Word bytes: digits, letters, and all of UTF-8 beyond ASCII.
WORD_BYTES = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: With this many words left, the rest of them is summed one by one.
FEW = 32


def _crc_table() -> np.ndarray:
    """Step of the reflected CRC-32 (polynomial 0xEDB88320) for each byte."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> np.uint32(1) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    return step


CRC = _crc_table()


def advance(state: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC states after data[start : start + length] of each, all starts at once."""
    order = np.argsort(-length, kind="stable")
    state, start, length = state[order], start[order], length[order]
    left, at = np.searchsorted(-length, 0, side="left"), 0
    while left >= FEW:
        own = state[:left]
        state[:left] = CRC[(own ^ data[start[:left] + at]) & np.uint32(0xFF)] ^ own >> np.uint32(8)
        at += 1
        left = int(np.searchsorted(-length, -at, side="left"))
    for i in range(left):
        state[i] = zlib.crc32(data[start[i] + at : start[i] + length[i]].tobytes(), int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(state)
    out[order] = state
    return out


def features(texts: pa.Array, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of each feature of the texts, and the words of each text."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, raw = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = LOWERED[np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]]] if ends[-1] > ends[0] else np.array([], np.uint8)
    ends = ends - ends[0]
    inside = np.concatenate([[False], WORD_BYTES[data], [False]])
    change = np.diff(inside.view(np.int8))  # one more place than bytes
    begins, stops = change == 1, change == -1
    border = ends[(ends > 0) & (ends < len(data))]
    border = border[inside[border] & inside[border + 1]]  # a text ends within a run of word bytes
    begins[border] = stops[border] = True
    start = np.flatnonzero(begins)
    length = np.flatnonzero(stops) - start
    row = np.searchsorted(ends, start, side="right") - 1
    many = np.bincount(row, minlength=len(texts))
    after = np.cumsum(many)[row] - np.arange(len(row))  # words from here to the text's end
    state = advance(np.full(len(start), 0xFFFFFFFF, np.uint32), data, start, length)
    rows, found = [row], [state]
    for run in range(2, longest + 1):
        first = np.flatnonzero(after >= run)
        own = state[np.searchsorted(rows_at, first)] if run > 2 else state[first]
        own = CRC[(own ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ own >> np.uint32(8)
        state = advance(own, data, start[first + run - 1], length[first + run - 1])
        rows_at = first
        rows.append(row[first])
        found.append(state)
    return np.concatenate(rows), ((np.concatenate(found) ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64), many


def counts(df: DataFrame, text: str = "text", buckets: int = 10_000, longest: int = 1) -> np.ndarray:
    """How many features of all texts fall in each bucket; each task sends one row per bucket at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for rows in slices(batch, 0):
                n += np.bincount(features(rows.column(0), buckets, longest)[1], minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in df.select(text).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


@dataclass(frozen=True)
class Target:
    """What each bucket gains a document."""

    gains: np.ndarray
    longest: int


def fit(corpus: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = 10_000, longest: int = 1, scale: int = 1000) -> Target:
    """Gains: the floored, scaled logarithm of the ratio of smoothed shares of target and corpus. Empty tables count nothing."""
    s, t = counts(corpus, text, buckets, longest), counts(target, target_text, buckets, longest)
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    gains = [math.floor(scale * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    return Target(np.array(gains, np.int64), longest)


def weighted(df: DataFrame, target: Target, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight) of each row: weight is the floored mean gain of its features, 0 without any."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1):
                row, bucket, words = features(rows.column(1), len(target.gains), target.longest)
                n = np.bincount(row, minlength=rows.num_rows)
                order = np.argsort(row, kind="stable")
                total = np.concatenate([[0], np.cumsum(target.gains[bucket[order]])])
                ends = np.cumsum(n)
                weight = (total[ends] - total[ends - n]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, (words.astype(np.int64), n.astype(np.int64), weight))], names=[key, "n_words", "n_features", "weight"])

    fields = [T.StructField(key, df.schema[key].dataType), *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]]
    return df.select(key, text).mapInArrow(weigh, T.StructType(fields))


def resample(df: DataFrame, target: Target, key: str = "doc_id", text: str = "text", percent: int = 10, least_words: int = 20, seed: int = 2024, scale: int = 1000) -> DataFrame:
    """(key, n_features, weight, score, rank) of each row; rank 1, 2, 3... of the floor(percent * N / 100) highest scores, null for others.

    N counts the rows of at least `least_words` words. A null or empty text, or one without a word, has no
    features, weight 0 and a score of noise alone, and is not drawn. A null key's noise is that of an
    empty key; such rows rank after others of their score. Rows of one key have the same noise: they rank
    by features, then by weight, and rows that are alike in all are drawn one after another, as many as
    there are. A very long text counts with all its words. An empty table gives an empty table. Other
    columns are dropped, whatever their names.
    """
    own = weighted(df.select(key, text), target, key, text)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(own.withColumn("score", F.col("weight") + noise).withColumn("__few", F.col("n_words") < least_words), "scored")
    drawn = scored.filter("NOT __few").count() * percent // 100
    order = [F.col("__few"), -F.col("score"), F.col(key).isNull(), F.col(key), F.col("n_features"), F.col("weight")]
    numbered, _ = row_numbers(scored.select(key, "n_features", "weight", "score", "__few"), order, "__n")
    return numbered.select(key, "n_features", "weight", "score", F.when(F.col("__n") < drawn, F.col("__n") + 1).alias("rank"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample(docs, fit(docs, benchmark))


ORACLE = r"""
WITH RECURSIVE step(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8
),
crc AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
dw AS (SELECT row_number() OVER () AS r, doc_id, w FROM d),
each AS (SELECT r, unnest(w) AS w FROM dw),
known AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM each UNION SELECT w FROM b)),
bytes AS (SELECT w, list_transform(range(0, length(x) // 2), lambda i: (instr('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', x[2 * i + 2]) - 1) AS y FROM known),
hashed AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, y), lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1])), 4294967295) % 10000 AS k FROM bytes, crc),
s AS (SELECT k, count(*) AS s FROM each JOIN hashed USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN hashed USING (w) GROUP BY k),
sums AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS s, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS t),
gains AS (SELECT k, floor(1000 * ln((coalesce(t.t, 0) + 1.0::DOUBLE) * (sums.s + 10000) / ((coalesce(s.s, 0) + 1.0::DOUBLE) * (sums.t + 10000)))) AS g FROM s LEFT JOIN t USING (k), sums),
weights AS (SELECT r, count(*) AS n, floor(sum(g) / count(*)) AS weight FROM each JOIN hashed USING (w) JOIN gains USING (k) GROUP BY r),
scored AS (
  SELECT dw.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(dw.doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM dw LEFT JOIN weights USING (r)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS i FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND i <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN i END AS rank FROM ranked
"""
