"""Loading the built tables: staged as a version, checked, then switched to in one step, so that a failed load leaves the old rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import cross_check, duplicates, enforce, marks, suspected
from ..schemas import BUILT, KEYS, TABLES
from ..scratch import staged as written_once
from .snapshots import Snapshots


def snake(name: str) -> str:
    return re.sub(r"([A-Z])", lambda m: "_" + m[1].lower(), name)


def projected(df: DataFrame, table: str) -> DataFrame:
    """The table's columns under their relational names."""
    return df.select(*[F.col(c).alias(snake(c)) for c in TABLES[table].fieldNames() if c in df.columns])


def with_embeddings(texts: DataFrame, embeddings: DataFrame | None, stamp: str | None = None) -> DataFrame:
    """Texts with their vectors. A set of embeddings must be complete in both directions, unique and of the pinned build; without one all vectors are null and a row keeps its own model."""
    if embeddings is None:
        return texts.withColumn("embedding", F.lit(None).cast("array<double>"))
    keys = ["canonicalId", "translation"]
    checks = {"embeddings are unique": duplicates(embeddings, keys)}
    if stamp is not None:
        checks["embeddings are of the pinned build"] = embeddings.filter(F.col("embeddingModel") != stamp).select(*keys, "embeddingModel")
    checks["no embedding is an orphan"] = embeddings.select(*keys).join(texts.select(*keys), keys, "left_anti")
    checks["no embedding is missing"] = texts.select(*keys).join(embeddings.select(*keys), keys, "left_anti")
    enforce(checks)
    own = embeddings.select(*keys, "embedding", F.col("embeddingModel").alias("__model"))
    joined = texts.join(own, keys, "left")
    return joined.withColumn("embeddingModel", F.coalesce("__model", "embeddingModel")).drop("__model")


def snapshots(spark: SparkSession, database: str) -> Snapshots:
    """The versions of a database's built tables, beside its other tables."""
    return Snapshots(spark, f"{spark.catalog.getDatabase(database).locationUri}/snapshots")


def create(spark: SparkSession, database: str) -> None:
    """All tables, where they are not there yet. The built ones stand where the current version is."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    places = snapshots(spark, database)
    for table, schema in TABLES.items():
        if table != "embeddings" and not spark.catalog.tableExists(f"{database}.{table}"):
            fields = [f"{snake(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
            fields += ["embedding array<double>"] if table == "verse_texts" else []
            at = f" LOCATION '{places.folder('none', table)}'" if table in BUILT else ""
            spark.sql(f"CREATE TABLE {database}.{table} ({', '.join(fields)}) USING parquet{at}")


def point(spark: SparkSession, database: str) -> None:
    """Lets the catalogue's names follow the current version. They do so one by one; who reads several tables together takes `open_tables`."""
    places = snapshots(spark, database)
    version = places.current()
    for table in BUILT if version else ():
        spark.sql(f"ALTER TABLE {database}.{table} SET LOCATION '{places.folder(version.name, table)}'")
        spark.catalog.refreshTable(f"{database}.{table}")


def open_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The five built tables, all of one version."""
    return snapshots(spark, database).read()


def add_column(spark: SparkSession, table: str, column: str, kind: str) -> bool:
    """An additive migration; False if the column is there."""
    if column in spark.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({column} {kind})")
    return True


def load(spark: SparkSession, database: str, tables: dict[str, DataFrame], embeddings: DataFrame | None = None, stamp: str | None = None) -> dict[str, int]:
    """Stages all tables, checks and counts them as they were written, then switches to them in one step; returns their row counts. Loading twice gives the same.

    Nothing that readers see changes before all is staged and checked, and a load that dies at any point
    leaves the old version or the new one. Two loads at a time: the second one to switch is refused.
    """
    texts = with_embeddings(tables["verse_texts"], embeddings, stamp)
    create(spark, database)
    versions = snapshots(spark, database)
    over = versions.current()
    fields = {t: [*TABLES[t].fieldNames(), *(["embedding"] if t == "verse_texts" else [])] for t in BUILT}
    name, written = versions.stage({t: (texts if t == "verse_texts" else tables[t]).select(*[F.col(c).alias(snake(c)) for c in fields[t]]) for t in BUILT})
    try:
        staged = {t: df.toDF(*fields[t]) for t, df in written.items()}
        # edges are many and lie together by source: their keys and both ends are read in one pass, and only what may repeat is shuffled
        marked = written_once(marks(staged["edges"], KEYS["edges"]), "marks")
        ends = {("edges", c): marked.filter(F.col("column") == i).select(F.col("ref").alias(c)) for i, c in enumerate(KEYS["edges"][:2])}
        repeated = {t: suspected(staged[t], KEYS[t], marked) if t == "edges" else duplicates(staged[t], KEYS[t]) for t in BUILT}
        enforce({"references are whole": cross_check(staged, ends)} | {f"{t}: the key is unique": repeated[t] for t in BUILT})
        counts = {t: df.count() for t, df in staged.items()}
        versions.switch(name, counts, over)
    except Exception:
        versions.store.delete(f"{versions.root}/versions/{name}")
        raise
    point(spark, database)
    return counts
