"""Mixing sources to target weights, by systematic sampling with DataFrame functions alone.

Every document of a source is due the same expected number of copies, e = target / source size.
Documents are laid out within their source, the expected copies are summed up along that order, one
random offset per source is added, and a document is taken once per integer that its stretch crosses.
The order goes by size class first, so that the words taken stay within about two documents of the target.

The prefix sum follows from global row numbers in the order of source and class: a row's place in its
source is its number less that of the source's first row, so that a hot source is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, cut, order_hash, row_numbers

#: Largest number of copies of a document, and of a target as a multiple of its source's size.
CAP = 3


def word_count(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Four classes an octave, in ascending order of size, by integer arithmetic."""
    bits = F.length(F.bin(size)).cast("long")
    return bits * 8 + F.floor(size * 8 / F.pow(F.lit(2.0), bits)).cast("long")


def source_offset(source: Column, seed: int) -> Column:
    """The random offset of a source in [0, 1), a multiple of 2**-16."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(source, F.lit("\u0000")), F.lit(f"|{seed}"))), 1, 4), 16, 10).cast("double") / 65536


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Targets from one row per source (source, source_size): shares by weight, capped, the excess reshared.

    Resharing until none is above its cap comes to one level L with target = min(cap, weight * L). In
    ascending order of cap / weight the capped sources are a prefix; L follows from prefix sums.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(x) for x in weights]), ((rank - 1) % len(weights) + 1).cast("int")).cast("long"))
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    w = w.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("all_weight"),
        F.sum(F.col("source_size") * CAP).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)).alias("caps_before"),
        F.sum("weight").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)).alias("weight_before"),
    )
    left = F.col("total") - F.coalesce("caps_before", F.lit(0))
    free = F.col("all_weight") - F.coalesce("weight_before", F.lit(0))
    # not capped: cap * free weight >= weight * what is left, and so for all after it
    w = w.withColumn("fits", F.col("source_size") * CAP * free >= F.col("weight") * left).withColumn("left", left).withColumn("free", free)
    first = F.min(F.when(F.col("fits"), F.struct((F.col("source_size") / F.col("weight")).alias("ratio"), F.col("source").isNull().alias("none"), "source", "left", "free"))).over(everything)
    w = w.withColumn("first", first)
    shared = (F.col("weight") * F.col("first.left")).cast("double") / F.col("first.free").cast("double")
    target = F.when(F.col("fits"), shared).otherwise((F.col("source_size") * CAP).cast("double"))
    return w.select("source", "source_size", target.alias("target"))


def mix(df: DataFrame, size: Column, source: str = "source", key: str = "doc_id", weights: tuple[int, ...] = (1, 2, 3), seed: int = 1, bucket_rows: int = 50_000) -> DataFrame:
    """Adds size, source_size, target, copies and taken (copies * size) to every row; the caller repeats rows by `copies`.

    A null source is a source of its own, after all others. A null or word-less text has size 0 and
    takes no words. Rows with the same key (null too) keep one place in the order; full duplicates are
    told apart only by their row number, so that which of them is taken makes no difference. However
    many rows have one key or source, they fall into several ranges. A very long text counts with all
    its words. An empty table gives an empty table. Columns named like the outputs are replaced; names
    that begin with two underscores are reserved.
    """
    # sizes are used in several places and read once; only keys and sizes are sorted, and find their rows again by number
    named = cut(df.withColumn("size", size).withColumn("__row", F.monotonically_increasing_id()), "sized")
    narrow = named.select("__row", F.col(source).alias("__s"), F.col(key).alias("__k"), F.col("size").alias("__z"))
    order = [F.col("__s").asc_nulls_last(), size_class(F.col("__z")), order_hash("__k"), F.col("__k"), F.col("__z")]
    numbered, _ = row_numbers(narrow, order, "__n", bucket_rows)
    sources = named.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    firsts = sources.select(F.col("source").alias("f_s"), (F.sum("rows").over(Window.orderBy(F.col("source").asc_nulls_last())) - F.col("rows")).alias("first"))
    # a row per source
    targets = source_targets(sources.select("source", "source_size"), weights).join(firsts, F.col("source").eqNullSafe(F.col("f_s"))).select(F.col("source").alias("__t"), F.col("source_size").alias("__size"), F.col("target").alias("__target"), F.col("first").alias("__first"))
    placed = numbered.join(targets, F.col("__s").eqNullSafe(F.col("__t")))
    place = F.col("__n") - F.col("__first")
    each = F.when(F.col("__size") > 0, F.col("__target") / F.col("__size")).otherwise(0.0)
    upto = F.floor(source_offset(F.col("__s"), seed) + each * (place + 1))
    below = F.floor(source_offset(F.col("__s"), seed) + each * place)
    decided = placed.select("__row", F.col("__size"), F.col("__target"), F.least(upto - below, F.lit(CAP)).cast("long").alias("__copies"))
    out = named.join(decided, "__row").withColumn("source_size", F.col("__size")).withColumn("target", F.col("__target")).withColumn("copies", F.col("__copies"))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("__row", "__size", "__target", "__copies")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(docs, F.col("size")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), k AS (
  SELECT *, (length(bin(size)) * 8 + floor(size * 8 / pow(2.0, length(bin(size)))))::BIGINT AS c, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight FROM s
), r AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT - coalesce(sum(3 * source_size) OVER o, 0)::BIGINT AS remaining,
         (sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER o, 0)::BIGINT AS free,
         row_number() OVER (ORDER BY source_size / weight, source ASC NULLS LAST) AS i
  FROM w WINDOW o AS (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, 3 * source_size * free >= weight * remaining AS fits FROM r
), g AS (
  SELECT remaining AS lr, free AS lf FROM f WHERE fits ORDER BY i LIMIT 1
), t AS (
  SELECT source, source_size, CASE WHEN fits THEN (weight * lr)::DOUBLE / lf::DOUBLE ELSE (3 * source_size)::DOUBLE END AS target FROM f, g
), p AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         ('0x' || substr(md5(coalesce(k.source, chr(0)) || '|1'), 1, 4))::INTEGER::DOUBLE / 65536 AS u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS e,
         row_number() OVER (PARTITION BY k.source ORDER BY k.c, k.h, k.doc_id, k.size) AS i
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (least(floor(u + e * i) - floor(u + e * (i - 1)), 3) * size)::BIGINT AS taken FROM p
"""
