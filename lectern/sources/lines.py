"""Text files as numbered lines, read in splits.

A file of any size is read in as many splits as the session asks for. Each split counts its lines; a
line's number is its place in its split plus the lines of the file's splits before it, of which there is
one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import RuleError


def numbered_lines(texts: DataFrame, text: str = "value", *carry: str) -> DataFrame:
    """(carry, line_no, line): lines from 1, in files given as whole texts; a carriage return at a line's end goes."""
    lines = F.split(F.regexp_replace(F.col(text), "^\\uFEFF", ""), "\n")
    return texts.select(*carry, F.posexplode(lines).alias("at", "raw")).select(*carry, (F.col("at") + 1).alias("line_no"), F.regexp_replace("raw", "\r$", "").alias("line"))


def is_folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()


def read_pieces(spark: SparkSession, path: str, separator: str = "\n", names: str | None = None) -> DataFrame:
    """(path, size, block, at, raw): what separators part, in the splits (block: where one begins) and the order (at) in which it is read. Of a folder's files, at any depth, only those whose names match are read."""
    try:
        reader = spark.read.option("lineSep", separator).option("recursiveFileLookup", "true")
        if names is not None and is_folder(spark, path):
            reader = reader.option("pathGlobFilter", names)
        df = reader.text(path)
    except Exception as e:
        raise RuleError("the source is there", f"{path}: {str(e)[:120]}") from e
    file = F.col("_metadata")
    return df.select(file["file_path"].alias("path"), file["file_size"].alias("size"), file["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw"))


def read_splits(pieces: DataFrame, separator: int = 1, **sums: Column) -> DataFrame:
    """(path, size, block, first, n, bytes, sums, before, before_sums) of each split: its first place, its pieces, their bytes with a separator of so many each, and what comes before it in its file."""
    counted = {"n": F.count(F.lit(1)), "bytes": F.sum(F.octet_length("raw").cast("long") + separator), **{k: F.sum(c) for k, c in sums.items()}}
    splits = pieces.groupBy("path", "size", "block").agg(F.min("at").alias("first"), *[c.alias(k) for k, c in counted.items()])
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = {"before": "n", **{f"before_{k}": k for k in sums}}
    return splits.withColumns({k: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for k, c in before.items()})


def in_order(pieces: DataFrame, splits: DataFrame) -> DataFrame:
    """Pieces with their place `nth` in the file, from 0, and the columns of their splits. Both come from one reading plan, whose splits are the same each time; if they are not, this fails."""
    own = splits.drop("size", "bytes").withColumnsRenamed({"path": "__path", "block": "__block"})
    joined = pieces.join(own, (F.col("path") == F.col("__path")) & (F.col("block") == F.col("__block")), "left")
    here = F.col("at") - F.col("first")
    nth = F.when((here >= 0) & (here < F.col("n")), F.col("before") + here).otherwise(F.raise_error(F.lit("a file was split in another way when it was read again")).cast("long"))
    return joined.withColumn("nth", nth).drop("__path", "__block", "at", "first", "n", "before")


def file_ends(splits: DataFrame) -> DataFrame:
    """(path, lines, ended): how many lines a file has, and whether a newline ends the last one. A byte-order mark of three bytes is in no line."""
    left = F.first("size") - F.sum("bytes")
    return splits.groupBy("path").agg(F.sum("n").alias("lines"), left.isin(0, 3).alias("ended"))


def line_of(raw: Column) -> Column:
    return F.regexp_replace(raw, "\r$", "")


def read_lines(spark: SparkSession, path: str, names: str | None = None) -> DataFrame:
    """(path, line_no, line) of text files: lines from 1, without carriage returns at their ends and without a byte-order mark. A newline at a file's end begins a last, empty line; an empty file has none."""
    pieces = read_pieces(spark, path, names=names)
    splits = read_splits(pieces)
    lines = in_order(pieces, splits).select("path", (F.col("nth") + 1).alias("line_no"), line_of(F.col("raw")).alias("line"))
    last = file_ends(splits).filter("ended").select("path", (F.col("lines") + 1).alias("line_no"), F.lit("").alias("line"))
    return lines.unionByName(last)


def cells(df: DataFrame, line: str = "line") -> DataFrame:
    return df.withColumn("cells", F.split(F.col(line), "\t", -1))
