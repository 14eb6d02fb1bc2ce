"""Document fingerprints by consistent weighted sampling.

Terms are white-space separated words (ASCII letters lower-cased), weighted by their counts w. For each
of `samples` positions a term has r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1), drawn from a hash of term and
position. With t = floor(ln w / r + b), the term with the least ln c - r (t - b + 1) is sampled, and
(term, t) is its value. Two documents' values at a position are equal with probability
sum(min(w1, w2)) / sum(max(w1, w2)), the generalised Jaccard similarity. A value is kept as 16 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices
from .ordering import ORDER, ranges, with_tails

SAMPLES = 64
#: (term, count) pairs whose samples are held at a time (8 bytes a sample).
MOST_PAIRS = 200_000
#: Rows and characters that are fingerprinted at a time, unless one text is longer.
HELD_ROWS, HELD_CHARS = 1000, 2_000_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray, nth: int) -> np.ndarray:
    """21 of the 64 bits as a number in (0, 1)."""
    return (((x >> np.uint64(21 * nth)) & np.uint64(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) / np.float32(2**21)


def _table(terms: np.ndarray, counts: np.ndarray, samples: int) -> np.ndarray:
    """Of each (term, count) and position: rank bits above, the 16-bit value below, so that the least entry is the sample."""
    out = np.empty((len(terms), samples), np.uint64)
    place = (np.arange(1, samples + 1, dtype=np.uint64) * _A)[None, :]
    for at in range(0, len(terms), 4096):
        x = _mixed(terms[at : at + 4096, None] ^ place)
        y = _mixed(x + _A)
        r = -np.log(_uniform(x, 0)) - np.log(_uniform(x, 1))
        c = -np.log(_uniform(x, 2)) - np.log(_uniform(y, 0))
        b = _uniform(y, 1)
        t = np.floor(np.log(counts[at : at + 4096].astype(np.float32))[:, None] / r + b)
        rank = (np.log(c) - r * (t - b + np.float32(1))).astype(np.float32).view(np.uint32)
        rank = np.where(rank >> np.uint32(31), ~rank, rank | np.uint32(0x80000000)).astype(np.uint64)  # order as unsigned
        out[at : at + 4096] = rank << np.uint64(16) | _mixed(x ^ t.astype(np.int64).view(np.uint64)) >> np.uint64(48)
    return out


def signatures(texts: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """(texts, samples) uint16; a text without words has zeros."""
    import xxhash

    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
    coded = words.flatten().dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh64_intdigest(w.encode()) for w in vocabulary], np.uint64)
    rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
    real = np.array([w != "" for w in vocabulary], bool)
    keys = rows * max(1, len(vocabulary)) + coded.indices.to_numpy()
    keys, counts = np.unique(keys[real[coded.indices.to_numpy()]] if len(keys) else keys, return_counts=True)
    rows, terms = np.divmod(keys, max(1, len(vocabulary)))
    pairs, index = np.unique(terms * (int(counts.max(initial=1)) + 1) + counts, return_inverse=True)
    terms, counts = np.divmod(pairs, int(counts.max(initial=1)) + 1)
    drawn = hashes[terms] if len(terms) else np.array([], np.uint64)
    table = _table(drawn, counts, samples) if len(pairs) <= MOST_PAIRS else None  # shared by texts, unless too large
    out = np.zeros((len(texts), samples), np.uint16)
    starts = np.searchsorted(rows, np.arange(len(texts) + 1))
    for i in np.flatnonzero(np.diff(starts)).tolist():
        own = index[starts[i] : starts[i + 1]]
        least = np.full(samples, 2**64 - 1, np.uint64)
        for at in range(0, len(own), 4096):
            part = own[at : at + 4096]
            least = np.minimum(least, (_table(drawn[part], counts[part], samples) if table is None else table[part]).min(axis=0))
        out[i] = least & np.uint64(0xFFFF)
    return out


def hexadecimal(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of equal values of two fingerprints."""
    x, y = (np.frombuffer(bytes.fromhex(s), ">u2") for s in (a, b))
    return float((x == y).mean())


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(key, fingerprint) of every row; null and empty texts have the fingerprint of zeros, alike among themselves."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1, 1000):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(map(hexadecimal, signatures(rows.column(1), samples)), pa.string())], names=[key, "fingerprint"])

    return df.select(key, text).mapInArrow(made, T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("fingerprint", T.StringType())]))


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) replaced by the first as many code points of the next text, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compare_edited(df: DataFrame, samples: int = SAMPLES, bucket_rows: int | None = None) -> DataFrame:
    """Fingerprints each text of (doc_id, text) and its edited text, and compares it to that and to the next document's.

    Next is ascending doc_id, after the last the first; equal doc_ids follow each other by the beginning
    of their texts, then by a hash, null doc_ids come last; identical rows are spread over tasks. A null
    text counts as empty. A very long text is one row, its distinct words' samples being made in parts.
    A single document follows itself. An empty table gives an empty table. Other columns are dropped.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush(final: str) -> pa.RecordBatch:
            texts = [x[1] for x in held] + [final]
            n = len(held)
            changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
            signs = signatures(pa.array(texts + changed, pa.large_string()), samples)
            own, after, other = signs[:n], signs[1 : n + 1], signs[n + 1 :]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in held], pa.int64()),
                    pa.array([len(t) for t in texts[:n]], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                    pa.array([hexadecimal(x) for x in own]),
                    pa.array([hexadecimal(x) for x in other]),
                    pa.array((own == other).mean(axis=1)),
                    pa.array((own == after).mean(axis=1)),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        size = 0
        for batch in batches:
            for rows in slices(batch, 1, HELD_ROWS, HELD_CHARS):
                for key, text, bucket, tail in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    # a bucket's rows come before its tails, of which the first is the next document
                    if held and (tail or size > HELD_CHARS or len(held) >= HELD_ROWS or held[-1][2] != bucket):
                        yield flush(text)
                        held, size = [], 0
                    if not tail:
                        held.append((key, text, bucket))
                        size += len(text)
        if held:
            raise ValueError("a bucket has no tail")

    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = ranges(docs, bucket_rows=bucket_rows)
    ordered = with_tails(docs, cuts).repartition(len(cuts.bounds) + 1, "bucket").sortWithinPartitions("bucket", "tail", *ORDER[1:])
    return ordered.select("doc_id", "text", "bucket", "tail").mapInArrow(compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def query(spark, sf_dir: str) -> DataFrame:
    return compare_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
