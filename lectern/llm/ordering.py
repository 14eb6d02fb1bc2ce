"""Rows in ascending key order over many tasks: ranges (buckets) of about equal bytes, each sorted by itself.

Rows with equal keys follow each other by the first PREFIX characters of their texts, then by a hash of
it; rows that are the same in all of that have equal texts and are spread over the buckets that they
span. Bounds come from a sample; they decide how even the buckets are, never which rows come first.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of a text that order rows with equal keys.
PREFIX = 32
#: Buckets grow beyond this number of them; sampled rows for each.
MOST_BUCKETS, SAMPLED = 50_000, 20


def places(key: str, text: str) -> list[Column]:
    """What rows are ordered by: null keys last, then key, the text's beginning, the text's hash."""
    k = F.col(key).cast("long")
    return [k.isNull().alias("o_null"), F.coalesce(k, F.lit(0)).alias("o_key"), F.coalesce(F.substring(text, 1, PREFIX), F.lit("")).alias("o_begin"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("o_hash")]


@dataclass(frozen=True)
class Ranges:
    """Ascending lower bounds of all buckets but the first, as tuples of places; a bound that stands several times has that many buckets for its rows alone."""

    bounds: list[tuple]

    @cached_property
    def keys(self) -> np.ndarray:
        """The keys of bounds, which null ones follow."""
        return np.array([b[1] for b in self.bounds if not b[0]], np.int64)

    def of(self, place: tuple, turn: int) -> int:
        """The bucket of a row; `turn` deals rows that equal a repeated bound."""
        low, high = bisect_left(self.bounds, place), bisect_right(self.bounds, place)
        return high if high - low < 2 else low + 1 + turn % (high - low)

    def of_all(self, null: np.ndarray, key: np.ndarray, begin: pd.Series, digest: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """The buckets of rows: by their keys alone, unless a bound has the key too."""
        out = np.searchsorted(self.keys, key, side="left")
        for i in np.flatnonzero(null | (out != np.searchsorted(self.keys, key, side="right"))).tolist():
            out[i] = self.of((bool(null[i]), int(key[i]), begin.iat[i], int(digest[i])), int(turn[i]))
        return out


def ranges(df: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = 32 << 20, bucket_rows: int | None = None) -> Ranges:
    """Ranges of about `bucket_bytes` of text (or of `bucket_rows` rows), by places that a sample of rows has."""
    size = F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 64)
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    buckets = n // bucket_rows + 1 if bucket_rows else total // max(bucket_bytes, total // MOST_BUCKETS) + 1
    if buckets == 1:
        return Ranges([])
    share = SAMPLED * buckets / n
    some = df if share >= 1 else df.filter(F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = sorted(tuple(r) for r in some.select(*places(key, text)).collect())  # SAMPLED rows a bucket, without their texts
    return Ranges([got[len(got) * i // buckets] for i in range(1, buckets)] if got else [])


def bucketed(df: DataFrame, cuts: Ranges, key: str = "doc_id", text: str = "text", out: str = "bucket") -> DataFrame:
    """Adds the bucket, and the columns of `places` to sort by."""

    @F.pandas_udf("long")
    def bucket(null: pd.Series, k: pd.Series, begin: pd.Series, digest: pd.Series, turn: pd.Series) -> pd.Series:
        return pd.Series(cuts.of_all(null.to_numpy(bool), k.to_numpy(), begin, digest.to_numpy(), turn.to_numpy()))

    turn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
    return df.select("*", *places(key, text), turn.alias("o_turn")).withColumn(out, bucket("o_null", "o_key", "o_begin", "o_hash", "o_turn")).drop("o_turn")


#: The columns that rows of a bucket are sorted by.
ORDER = ("bucket", "o_null", "o_key", "o_begin", "o_hash")


def with_tails(df: DataFrame, cuts: Ranges, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds bucket and tail: every row stands in its bucket, and a row like a bucket's first once more, as the tail of the bucket before (of the last one for the first).

    Which row is a bucket's first is found among places, without texts; the texts of firsts are looked up then.
    """
    placed = bucketed(df, cuts, key, text)
    at = ("o_null", "o_key", "o_begin", "o_hash")
    firsts = placed.groupBy("bucket").agg(F.min(F.struct(*at)).alias("f")).collect()  # a row per bucket, without texts
    present = sorted((r["bucket"], *r["f"]) for r in firsts)
    rows = [(present[i - 1][0], *first) for i, (_, *first) in enumerate(present)]
    before = F.broadcast(df.sparkSession.createDataFrame(rows, "f_before long, f_null boolean, f_key long, f_begin string, f_hash long"))
    own = df.select(text, *places(key, text))
    same = [F.col(f"o_{c}") == F.col(f"f_{c}") for c in ("null", "key", "begin", "hash")]
    tails = own.join(before, same).dropDuplicates(["f_before"]).select(F.col("o_key").alias(key), text, F.lit(False).alias("o_null"), "o_key", F.lit("").alias("o_begin"), F.lit(0).cast("long").alias("o_hash"), F.col("f_before").alias("bucket"), F.lit(True).alias("tail"))
    return placed.withColumn("tail", F.lit(False)).unionByName(tails)
