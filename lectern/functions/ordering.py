"""Total orders of the tables: every key ends in a unique one, so that sorting is reproducible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import EDGE_KINDS, LANGUAGES
from ..scratch import fresh_path, staged
from .ids import id_key, literal_map


def by_rank(value: Column, order: tuple[str, ...]) -> Column:
    return F.element_at(literal_map({v: i for i, v in enumerate(order)}), value)


def units(value: Column) -> Column:
    """What a string sorts by, unit by unit of UTF-16: bytes, which differ from Spark's own order of strings above U+FFFF."""
    return F.encode(value, "UTF-16BE")


def order_columns(table: str) -> list[Column]:
    """A reference sorts by book, chapter, verse (one long); equal references (leading zeros) by the id itself."""
    c, u = F.col, lambda name: units(F.col(name))
    return {
        "canonical_verses": [id_key(c("id")), u("id")],
        "verse_texts": [id_key(c("canonicalId")), u("canonicalId"), u("translation")],
        "original_words": [id_key(c("canonicalId")), u("canonicalId"), c("position")],
        "strongs": [by_rank(c("language"), LANGUAGES), u("id")],
        "edges": [id_key(c("sourceId")), id_key(c("targetId")), u("sourceId"), u("targetId"), by_rank(c("kind"), EDGE_KINDS)],
        "embeddings": [id_key(c("canonicalId")), u("canonicalId"), u("translation")],
    }[table]


def ordered(df: DataFrame, table: str) -> DataFrame:
    return df.orderBy(*order_columns(table))


def dense_position(df: DataFrame, group: str, *order: str, out: str = "position") -> DataFrame:
    """Numbers the rows of each group from 1 in the given (total) order."""
    from pyspark.sql.window import Window

    return df.withColumn(out, F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def spread_position(df: DataFrame, group: str, *order: str, out: str = "position", small: int = 1_000_000, rows: int | None = None) -> DataFrame:
    """dense_position for groups of any size: a large table is sorted by ranges, which part a group too; a row's place in its group is that among the group's rows in its range, after those in the ranges before it.

    rows: how many there are, of a table that is staged already and needn't be counted.
    """
    from pyspark.sql.window import Window

    if (df.count() if rows is None else rows) <= small:
        return dense_position(df, group, *order, out=out)
    placed = _by_ranges(df if rows is not None else staged(df, "keyed"), group, *order)
    # of each group a row per range that it is in
    pieces = placed.groupBy(F.col(group).alias("__group"), F.col("__r").alias("__range")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__group").orderBy("__range")) - F.col("__n")
    first = staged(pieces.select("__group", "__range", (F.col("__first") - before).alias("__first")), "firsts")
    here = (F.col("__r") == F.col("__range")) & F.col(group).eqNullSafe(F.col("__group"))
    return placed.join(first, here).withColumn(out, (F.col("__at") - F.col("__first") + 1).cast("int")).drop("__at", "__r", "__group", "__range", "__first")


def _by_ranges(df: DataFrame, *keys: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Rows sorted by ranges and written once, so that ranges are the same for all readers, with their range __r and their place __at in it, from 0."""
    place = fresh_path(df.sparkSession, "sorted")
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*drop).withColumn("__m", F.monotonically_increasing_id()).write.parquet(place)
    rows = df.sparkSession.read.parquet(place)
    return rows.withColumns({"__r": F.shiftright("__m", 33), "__at": F.col("__m").bitwiseAND((1 << 33) - 1)}).drop("__m")


#: Up to so many rows one task numbers them all.
SMALL = 1_000_000


def global_position(df: DataFrame, *order: str | Column, out: str = "position", small: int = SMALL) -> DataFrame:
    """Numbers all rows from 1 in the given (total) order.

    A large table is sorted by ranges: a row's number is its place in its range plus the rows of the
    ranges before it. The sorted rows are written once, so that ranges are the same for all readers.
    What is counted, sampled and sorted is written before, with what it sorts by, so that it is worked out once.
    """
    from pyspark.sql.window import Window

    keys = [f"__by{i}" for i in range(len(order))]
    df = staged(df.withColumns({k: F.col(o) if isinstance(o, str) else o for k, o in zip(keys, order, strict=True)}), "keyed")
    if df.count() <= small:
        return df.withColumn(out, F.row_number().over(Window.orderBy(*keys))).drop(*keys)
    rows = _by_ranges(df, *keys, drop=tuple(keys))
    sizes = rows.groupBy("__r").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__r", (F.sum("__n").over(Window.orderBy("__r")) - F.col("__n")).alias("__before"))  # a row per range
    return rows.join(before, "__r").withColumn(out, F.col("__before") + F.col("__at") + 1).drop("__at", "__r", "__before")


def counts_up_to(df: DataFrame, key: str, flag: str, out: str) -> DataFrame:
    """(key, out) of each distinct key: how many keys up to it, itself included, have the flag in some row.

    Keys are sorted by ranges, which are written once; a range's own running count is added to the
    counts of the ranges before it, of which there is a row each.
    """
    from pyspark.sql.window import Window

    keys = df.groupBy(key).agg(F.max(F.col(flag).cast("int")).alias("__f"))
    rows = staged(keys.repartitionByRange(key).withColumn("__r", F.spark_partition_id()), "ranked")
    before = rows.groupBy("__r").agg(F.sum("__f").alias("__n")).select("__r", (F.sum("__n").over(Window.orderBy("__r")) - F.col("__n")).alias("__before"))
    own = F.sum("__f").over(Window.partitionBy("__r").orderBy(key))
    return rows.join(before, "__r").select(key, (F.col("__before") + own).alias(out))


def first_appearance(df: DataFrame, group: str, place: str, out: str = "first_place") -> DataFrame:
    """Adds to each row its group's first place."""
    from pyspark.sql.window import Window

    return df.withColumn(out, F.min(place).over(Window.partitionBy(group)))
