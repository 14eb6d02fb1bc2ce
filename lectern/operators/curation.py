"""The append-only curation log, applied by projection, and the queue of what to curate first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(log: DataFrame, keys: list[str], value: str, *order: str) -> DataFrame:
    """The last value per key; `order` must be total."""
    return log.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def apply_log(rows: DataFrame, log: DataFrame, fields: dict[str, str], key: str = "canonicalId") -> DataFrame:
    """Rows with the last curated value of each field, cast to its type; what the log doesn't touch stays."""
    values = latest(log.filter(F.col("field").isin(*fields)), [key, "field"], "newValue", "timestamp", "author", "newValue")
    wide = values.groupBy(key).pivot("field", list(fields)).agg(F.first("newValue")).withColumnsRenamed({f: f"__{f}" for f in fields})
    joined = rows.join(wide, key, "left")
    return joined.withColumns({f: F.coalesce(F.col(f"__{f}").cast(kind), F.col(f)) for f, kind in fields.items()}).drop(*[f"__{f}" for f in fields])


def centrality(edges: DataFrame, source: str = "sourceId") -> DataFrame:
    return edges.groupBy(F.col(source).alias("node")).agg(F.count(F.lit(1)).alias("degree"))


def queue(verses: DataFrame, edges: DataFrame, reports: DataFrame, reviewed: Column | None = None) -> DataFrame:
    """Verses by open reports, then by how many edges leave them."""
    open_reports = reports.groupBy("canonicalId").agg(F.count_if(F.col("status") == "open").alias("open"))
    joined = verses.join(open_reports, F.col("id") == F.col("canonicalId"), "left").join(centrality(edges), F.col("id") == F.col("node"), "left")
    left = joined.filter(~reviewed) if reviewed is not None else joined
    return left.select("id", F.coalesce("open", F.lit(0)).alias("open"), F.coalesce("degree", F.lit(0)).alias("degree")).orderBy(F.desc("open"), F.desc("degree"), "id")
