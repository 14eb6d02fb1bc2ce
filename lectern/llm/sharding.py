"""Sharding by a Feistel permutation of global row numbers, with DataFrame functions alone.

The permutation acts on a x b >= N cells, a = ceil(sqrt(N)), b = ceil(N / a), as alternate modular
rounds (L + F(R) mod a, R + F(L) mod b): each round is a bijection. Images past N - 1 walk the cycle on
until they land below N; fewer than a cells lie past it. shard = image mod shards, slot = image div
shards: counts differ by one at most, slots have no gaps, and both can be computed from the row number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, order_hash, row_numbers

#: A Mersenne prime: products of two residues fit in 63 bits.
PRIME = 2**31 - 1
ROUNDS = 4
#: Steps of the cycle walk at first. Each lands below N with a probability of 1 - 1/sqrt(N) at least (1/2 for a handful of rows); what hasn't landed then walks on.
WALK = 200


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three multipliers a half-round, from a Lehmer sequence that starts at the seed."""
    x, keys = seed % (PRIME - 1) + 1, []
    for _ in range(2 * ROUNDS):
        key = []
        for _ in range(3):
            x = x * 48271 % PRIME
            key.append(x)
        keys.append((key[0], key[1], key[2]))
    return keys


def _mix(r: Column, key: tuple[int, int, int]) -> Column:
    z = (r % PRIME * key[0] + key[1]) % PRIME
    z = z.bitwiseXOR(F.shiftright(z, 13))
    z = z * key[2] % PRIME
    return z.bitwiseXOR(F.shiftright(z, 16))


def _sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _permute_once(x: Column, n: int, seed: int) -> Column:
    """One pass of all rounds as nested let-bindings (a lambda each), so that no round is computed twice."""
    a, b = _sides(n)

    def left(key):
        return lambda s: F.struct(((s["l"] + _mix(s["r"], key)) % a).alias("l"), s["r"].alias("r"))

    def right(key):
        return lambda s: F.struct(s["l"].alias("l"), ((s["r"] + _mix(s["l"], key)) % b).alias("r"))

    state = F.array(F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), (x % b).alias("r")))
    for i, key in enumerate(round_keys(seed)):
        state = F.transform(state, right(key) if i % 2 else left(key))
    return state[0]["l"] * b + state[0]["r"]


def permute(df: DataFrame, row: str, n: int, out: str, seed: int = 4) -> DataFrame:
    """Adds the image of a row number under the permutation of 0 .. n-1."""
    a, b = _sides(n)
    keys = round_keys(seed)
    df = df.withColumn("__l", F.floor(F.col(row) / F.lit(b)).cast("long")).withColumn("__q", F.col(row) % b)
    for i in range(ROUNDS):
        df = df.withColumn("__l", (F.col("__l") + _mix(F.col("__q"), keys[2 * i])) % a)
        df = df.withColumn("__q", (F.col("__q") + _mix(F.col("__l"), keys[2 * i + 1])) % b)
    df = df.withColumn("__y", F.col("__l") * b + F.col("__q"))
    # a walk meets no cell twice, so that it ends after as many steps as there are cells past n - 1
    for steps in (WALK, a * b - n + 1):
        walked = F.aggregate(F.sequence(F.lit(1), F.when(F.col("__y") >= n, steps)), F.col("__y"), lambda y, _: F.when(y < n, y).otherwise(_permute_once(y, n, seed)))
        df = df.withColumn("__y", F.when(F.col("__y") < n, F.col("__y")).otherwise(walked))
    return df.withColumn(out, F.col("__y")).drop("__l", "__q", "__y")


def shard(df: DataFrame, shards: int = 24, key: str = "doc_id", ties: tuple[str, ...] = (), seed: int = 4) -> DataFrame:
    """Adds row_number, shard (int) and slot (long, gapless from 0 in each shard) to every row.

    Row numbers go by the MD5 of the key; rows with equal keys (null too) are told apart by `ties`, and
    full duplicates stand next to each other in any order, which leaves the result the same. However
    many rows have one key, they fall into several ranges. A very long text is a row like any other. An
    empty table gives an empty table. Columns named like the outputs are replaced; names that begin with
    two underscores are reserved.
    """
    numbered, n = row_numbers(df, [order_hash(key), F.col(key), *map(F.col, ties)], "row_number")
    out = permute(numbered, "row_number", n, "__p", seed)
    return out.withColumn("shard", (F.col("__p") % shards).cast("int")).withColumn("slot", F.floor(F.col("__p") / shards).cast("long")).drop("__p")


def query(spark, sf_dir: str) -> DataFrame:
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (F.length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    out = shard(cut(docs, "hashed"), 24, ties=("text_crc32", "size"))  # texts are read once
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _sql_mix(r: str, key: tuple[int, int, int]) -> str:
    y = f"(({r} % {PRIME} * {key[0]} + {key[1]}) % {PRIME})"
    z = f"(xor({y}, {y} >> 13) * {key[2]} % {PRIME})"
    return f"xor({z}, {z} >> 16)"


def _sql_rounds(seed: int) -> str:
    """Select lists, one nested query a half-round, over columns x, l, r, a, b, n."""
    sql = "SELECT *, x // b AS l, x % b AS r FROM {src}"
    for i, key in enumerate(round_keys(seed)):
        new = f"* REPLACE ((l + {_sql_mix('r', key)}) % a AS l)" if i % 2 == 0 else f"* REPLACE ((r + {_sql_mix('l', key)}) % b AS r)"
        sql = f"SELECT {new} FROM ({sql})"
    return f"SELECT * EXCLUDE (x, l, r), l * b + r AS x FROM ({sql})"


#: None of DuckDB's checksums is CRC-32, so that its text_crc32 is made bit by bit from a table of 256 entries.
ORACLE = f"""
WITH RECURSIVE tab AS (
  SELECT i, list_reduce(list_concat([i::BIGINT], [k::BIGINT for k in range(8)]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)
), tabs AS (
  SELECT list(v ORDER BY i) AS t FROM tab
), d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size, hex(encode(coalesce(text, ''))) AS hx FROM documents
), c AS (
  SELECT doc_id, size,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(hx) + 1, 2), lambda p: ('0x' || substr(hx, p::BIGINT, 2))::BIGINT)),
        lambda s, y: xor(s >> 8, t[xor(s & 255, y) + 1])), 4294967295) AS text_crc32
  FROM d, tabs
), q AS (
  SELECT *, row_number() OVER (ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, text_crc32, size) - 1 AS x, (count(*) OVER ())::BIGINT AS n FROM c
), q2 AS (
  SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a, ((n + CAST(ceil(sqrt(n)) AS BIGINT) - 1) // CAST(ceil(sqrt(n)) AS BIGINT)) AS b FROM q
), w AS (
  {_sql_rounds(4).format(src='q2')}
  UNION ALL
  {_sql_rounds(4).format(src='(SELECT * FROM w WHERE x >= n)')}
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % 24)::INTEGER AS shard, x // 24 AS slot, NULL::INTEGER AS grown_shard FROM w WHERE x < n
"""
