"""The curation log as a stream: the latest value of each id and field is keyed state, and a batch writes what it changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Store
from ..operators.curation import latest
from ..schemas import TABLES

COLUMNS = TABLES["curation_log"].fieldNames()
#: The greatest of these is the latest entry.
ORDER = ("timestamp", "author", "newValue")


def read_log(spark: SparkSession, folder: str, late: str | None = None) -> DataFrame:
    """New JSON lines of a folder. With `late`, an entry that comes twice within that time counts once, and later ones are dropped; what keeps the latest values needs neither."""
    rows = spark.readStream.schema(TABLES["curation_log"]).json(folder)
    return rows.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["canonicalId", "field", "author", "timestamp", "newValue"]) if late else rows


def _best(rows: DataFrame) -> DataFrame:
    return rows.groupBy("canonicalId", "field").agg(F.max_by(F.struct(*COLUMNS), F.struct(*ORDER)).alias("r")).select("r.*")


def keep_latest(log: DataFrame, target: str, checkpoint: str):
    """Starts the query. The state store has the latest entry of each id and field; a batch writes the entries that it made the latest, under its own number, so that a batch that is run again leaves the same."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/changes/batch={number}")

    return _best(log).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _parts(spark: SparkSession, target: str) -> tuple[list[str], list[str]]:
    """Folders of complete bases and of changes."""
    store = Store(spark, target)
    whole = lambda kind: [f"{target}/{kind}/{n}" for n in (store.names(f"{target}/{kind}") if store.exists(f"{target}/{kind}") else []) if store.exists(f"{target}/{kind}/{n}/_SUCCESS")]
    return whole("base"), whole("changes")


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    """The latest entry of each id and field. Bases and changes may overlap: the latest of all is the same."""
    found = [p for kind in _parts(spark, target) for p in kind]
    if not found:
        return spark.createDataFrame([], TABLES["curation_log"])
    return _best(spark.read.schema(TABLES["curation_log"]).parquet(*found))


def compact(spark: SparkSession, target: str) -> int:
    """Folds the changes so far into a new base, then deletes what it holds; returns how many folders went. A stop in between leaves entries twice, never none."""
    bases, changes = _parts(spark, target)
    if len(bases) + len(changes) < 2:
        return 0
    number = max([-1, *(int(p.rsplit("=", 1)[1]) for p in bases)]) + 1
    read_latest(spark, target).write.mode("overwrite").parquet(f"{target}/base/number={number}")
    store = Store(spark, target)
    for path in [*bases, *changes]:
        store.delete(path)
    return len(bases) + len(changes)


__all__ = ["compact", "keep_latest", "latest", "read_latest", "read_log"]
