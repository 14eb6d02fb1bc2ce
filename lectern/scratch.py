"""Where intermediate files go."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="scratch")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written once in the shared folder and read from there: what several jobs read is worked out once, and in the same way for all."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_side(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: it is sorted and never broadcast. The planner goes by the bytes of a file, of which ids and numbers take few, and the driver would hold millions of rows of one."""
    return df.hint("merge")


#: Rows of a task where tables are dealt by their size.
ROWS = 250_000


def tasks_of(df: DataFrame, rows: int = ROWS) -> int:
    """How many tasks a table is dealt over, so that one holds the same whatever the table's size."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that spark.checkpoint.dir names. On a single machine it may be unset; on a cluster that is an error, as a local folder isn't shared."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
