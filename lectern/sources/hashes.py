"""SHA-256 of files of any size: a file is a stream of one task, of which it holds a batch of lines."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import Store

#: More than any file has, so that none is split; and what opening one is said to cost, so that each has a task.
_WHOLE = str(1 << 46)
_MARK = b"\xef\xbb\xbf"


class _Digest:
    """The hash of a file of which its lines are seen, but neither its byte-order mark nor whether a newline ends it: the file's size tells."""

    def __init__(self, size: int):
        self.size, self.seen, self.begun = size, 0, False
        self.plain, self.marked = hashlib.sha256(), hashlib.sha256(_MARK)

    def add(self, lines: list[bytes]) -> None:
        data = (b"\n" if self.begun else b"") + b"\n".join(lines)
        self.begun = True
        self.seen += len(data)
        self.plain.update(data)
        self.marked.update(data)

    def end(self) -> str:
        left = self.size - self.seen
        if left not in (0, 1, 3, 4):
            raise ValueError(f"{left} bytes of {self.size} were not seen")
        chosen = self.marked if left >= 3 else self.plain
        if left % 3 == 1:
            chosen.update(b"\n")
        return chosen.hexdigest()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, _Digest] = {}
    for batch in batches:
        if any(batch.column(2).to_numpy()):
            raise ValueError("a file was split")
        coded = batch.column(0).dictionary_encode()
        for code, path in enumerate(coded.dictionary.to_pylist()):
            own = batch if len(coded.dictionary) == 1 else batch.filter(pa.array(coded.indices.to_numpy() == code))
            found.setdefault(path, _Digest(own.column(1)[0].as_py())).add(own.column(3).to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([d.end() for d in found.values()], pa.string())], names=["path", "sha256"])


def file_hashes(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, sha256) of files, in one job however many they are."""
    whole = spark.newSession()
    whole.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE)
    whole.conf.set("spark.sql.files.openCostInBytes", _WHOLE)
    file = F.col("_metadata")
    lines = whole.read.option("lineSep", "\n").text(list(paths)).select(file["file_path"].alias("path"), file["file_size"].alias("size"), file["file_block_start"].alias("block"), F.col("value").cast("binary").alias("raw"))
    empty = [(name, hashlib.sha256().hexdigest()) for p in paths for name in Store(spark, p).empty(p)]  # these have no lines
    return lines.mapInArrow(_hashed, "path string, sha256 string").unionByName(whole.createDataFrame(empty, "path string, sha256 string"))
