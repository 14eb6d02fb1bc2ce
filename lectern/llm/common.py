"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import fresh_path

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Ranges grow beyond this number of them.
MOST_RANGES = 100_000


#: Paths that `scratch` has given out in this process, in order.
MADE: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; see lectern.scratch."""
    MADE.append(fresh_path(spark, name))
    return MADE[-1]


def release(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that nothing will read any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        MADE.remove(path)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes a table in the shared folder and reads it back: cuts the lineage and gives the planner true sizes."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, by: str, size: int, task: int = 64 << 20) -> DataFrame:
    """Rows of equal `by` together, in the session's number of tasks (which the planner may coalesce), or in more if `size` bytes need them."""
    tasks = size // task + 1
    return df.repartition(tasks, by) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(by)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text: int, rows: int = 4000, size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in parts of so many rows and bytes of its text column at most, or of one row: what a worker makes of a part stays small."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = min(max(at + 1, int(np.searchsorted(ends, before + size, side="right"))), at + rows)
        yield batch.slice(at, min(to, batch.num_rows) - at)
        at = to


def order_hash(*cols: str) -> Column:
    """A reproducible pseudo-random order key: hex MD5 of the values as text, null as the empty string."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def row_numbers(df: DataFrame, order: list[Column], out: str, bucket_rows: int = 50_000) -> tuple[DataFrame, int]:
    """Adds the global row number (long, from 0) in the given order, ties in the order of reading; returns the table and its number of rows.

    The rows are sorted by ranges and written: a row's number is its place in its range plus the rows of
    the ranges before it, of which there is one row each. Rows that tie are told apart by their place in
    the input, so that a value that many rows have falls into several ranges like any other. A range has
    about `bucket_rows` rows, more where there would be over MOST_RANGES of them.
    """
    n = df.count()
    parts = n // max(bucket_rows, n // MOST_RANGES) + 1
    keyed = df.withColumn("__at", F.monotonically_increasing_id())
    keys = [*order, F.col("__at")]
    placed = cut(keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("__at").withColumn("__m", F.monotonically_increasing_id()), "numbered")
    rows = placed.withColumn("__p", F.shiftright("__m", 33))
    before = rows.groupBy("__p").agg(F.count(F.lit(1)).alias("__n")).select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))
    numbered = rows.join(before, "__p").withColumn(out, F.col("__before") + F.col("__m").bitwiseAND((1 << 33) - 1))
    return numbered.drop("__m", "__p", "__before"), n
