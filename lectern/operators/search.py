"""Exact search for many queries at a time, and the gate that holds a search to a golden set.

A pass goes over the rows once for some queries: their vectors are one matrix, a batch of rows is another,
and their product gives all similarities. Each task keeps for each query what can still be among its
nearest, and works the kept distances out anew in the order of `cosine_distance`, so that they are equal
to the last bit. Tasks' lists are merged by query.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..errors import RuleError
from ..files import Store
from ..scratch import staged
from .embedding import Embedder, answer, check_build, stamp
from .retrieval import LIMITS, _bounded, evaluate, may_see

#: Bytes of query vectors in a pass; golden rows at most, which the driver reads.
PASS_BYTES, MOST_GOLDEN = 64 << 20, 100_000
#: How far the product of matrices may be from the sum in order.
SLACK = 1e-9


def _sums(products: np.ndarray) -> np.ndarray:
    """Row sums, added from left to right."""
    return np.add.accumulate(products, axis=1)[:, -1]


class _Kept:
    """For each query of a pass its nearest rows so far, as (distance, keys)."""

    def __init__(self, vectors: np.ndarray, limits: list[int], only: list[str | None]):
        self.vectors, self.limits = vectors, limits
        self.norms = np.sqrt(_sums(vectors * vectors))
        self.only, self.free = np.array(only, object), np.array([x is None for x in only])
        self.rows: list[list[tuple]] = [[] for _ in limits]
        self.worst = np.full(len(limits), np.inf)

    def add(self, vectors: np.ndarray, keys: list[tuple], groups: list) -> None:
        size = self.norms[:, None] * np.sqrt(_sums(vectors * vectors))[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            about = 1 - self.vectors @ vectors.T / size
        wanted = (size > 0) & (self.free[:, None] | (self.only[:, None] == np.array(groups, object)[None, :]))
        about = np.where(wanted, about, np.inf)
        for i in np.flatnonzero((about <= self.worst[:, None] + SLACK).any(axis=1)).tolist():
            limit = self.limits[i]
            near = np.flatnonzero(np.isfinite(about[i]) & (about[i] <= self.worst[i] + SLACK))
            if len(near) > limit:
                near = near[about[i, near] <= np.partition(about[i, near], limit - 1)[limit - 1] + 2 * SLACK]
            exact = 1 - _sums(self.vectors[i] * vectors[near]) / size[i, near]
            own = [*self.rows[i], *((d, keys[j]) for j, d in zip(near.tolist(), exact.tolist(), strict=True))]
            own.sort(key=lambda r: (r[0], [(k is not None, k) for k in r[1]]))  # as the merge does
            self.rows[i] = own[:limit]
            if len(own) >= limit:
                self.worst[i] = own[limit - 1][0]


def nearest_many(rows: DataFrame, queries: DataFrame, keys: Sequence[str], vector: str = "embedding", group: str | None = None) -> DataFrame:
    """(id, rank, keys, distance) of queries (id, vector, limit[, only]): the nearest rows of each, ties by the keys.

    `only` (null: any) is the value that a row's `group` must have. Null, zero and differently sized
    vectors take no part. One plan for all queries; it has a pass over the rows for each PASS_BYTES of
    query vectors.
    """
    asked = queries.select("id", "vector", "limit", (F.col("only") if "only" in queries.columns else F.lit(None)).cast("string").alias("only")).orderBy("id").limit(MOST_GOLDEN + 1).collect()
    if len(asked) > MOST_GOLDEN:
        raise RuleError("a golden set is small", f"over {MOST_GOLDEN} rows")
    asked = [q for q in asked if q["vector"]]
    for q in asked:
        _bounded(q["limit"], LIMITS, "the limit")
    kinds = [rows.schema[k] for k in keys]
    out = T.StructType([queries.schema["id"], *kinds, T.StructField("distance", T.DoubleType())])
    shown = rows.filter(F.col(vector).isNotNull()).select(*keys, (F.col(group) if group else F.lit(None)).cast("string").alias("__group"), F.col(vector).cast("array<double>").alias("__vector"))
    found = None
    for dims in sorted({len(q["vector"]) for q in asked}):
        same = [q for q in asked if len(q["vector"]) == dims]
        step = max(1, PASS_BYTES // (8 * dims))
        for at in range(0, len(same), step):
            part = shown.mapInArrow(_pass(same[at : at + step], dims, out), out)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], out)
    limits = rows.sparkSession.createDataFrame([(q["id"], q["limit"]) for q in asked], T.StructType([queries.schema["id"], T.StructField("limit", T.IntegerType())]))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("distance", *keys))).filter(F.col("rank") <= LIMITS[1])
    return ranked.join(limits, "id").filter(F.col("rank") <= F.col("limit")).select("id", "rank", *keys, "distance")


def _pass(asked: list, dims: int, out: T.StructType):
    ids = [q["id"] for q in asked]
    vectors, limits, only = np.array([q["vector"] for q in asked], float), [q["limit"] for q in asked], [q["only"] for q in asked]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kept = _Kept(vectors, limits, only)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            sizes = np.diff(lists.offsets.to_numpy())
            use = np.flatnonzero(sizes == dims)
            for at in range(0, len(use), 1024):
                own = batch.take(pa.array(use[at : at + 1024]))
                matrix = own.column(own.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                named = list(zip(*(own.column(i).to_pylist() for i in range(own.num_columns - 2)), strict=True))
                kept.add(matrix, named, own.column(own.num_columns - 2).to_pylist())
        flat = [(ids[i], *key, d) for i, own in enumerate(kept.rows) for d, key in own]
        schema = to_arrow_schema(out)
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in flat], f.type) for c, f in enumerate(schema)], names=schema.names)

    return search


def run_golden(golden: DataFrame, texts: DataFrame, verses: DataFrame, embedder: Embedder, model: str, revision: str, levels: Sequence[str], canon: Sequence[str] = ("protestant",)) -> DataFrame:
    """(id, rank, canonicalId, translation, distance) of golden rows (id, query, translation, limit): each as search_by_theme finds it, all in one plan."""
    check_build(embedder.health(), model, revision)
    asked = golden.select("id", "query", "translation", F.coalesce("limit", F.lit(LIMITS[2])).alias("limit")).orderBy("id").limit(MOST_GOLDEN + 1).collect()
    if short := [q["id"] for q in asked if len((q["query"] or "").strip()) < 2]:
        raise RuleError("a query has 2 characters", str(short[:5]), len(short))
    vectors = []
    for at in range(0, len(asked), 32):
        made, mark = answer(embedder, [q["query"] for q in asked[at : at + 32]])
        if mark != f"{model}@{revision}":
            raise RuleError("the build stays the same", mark)
        vectors += made
    kind = T.StructType([golden.schema["id"], T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("limit", T.IntegerType()), T.StructField("only", T.StringType())])
    queries = golden.sparkSession.createDataFrame([(q["id"], [float(x) for x in v], q["limit"], q["translation"]) for q, v in zip(asked, vectors, strict=True)], kind)
    allowed = texts.join(verses.filter(F.col("canonStatus").isin(*canon)).select(F.col("id").alias("canonicalId")), "canonicalId", "left_semi")
    allowed = allowed.filter(may_see(F.col("authorizedLevels"), levels) & (F.col("embeddingModel") == stamp({"model": model, "revision": revision})))
    return nearest_many(allowed, queries, ("canonicalId", "translation"), "embedding", "translation")


def _lines(found: DataFrame) -> str:
    """Results as text, in order; a row for each golden row and rank."""
    rows = found.orderBy("id", "rank").collect()
    return "".join(json.dumps({**r.asDict(), "distance": repr(r["distance"])}, ensure_ascii=False, sort_keys=True) + "\n" for r in rows)


def gate(golden: DataFrame, run: Callable[[], DataFrame], snapshot: str | None = None, strict: bool = False) -> DataFrame:
    """Runs a golden set (id, ..., expectedIds) and returns (id, covered, strict); raises if a second run differs, if a row's expected ids are not all found (with `strict`: do not lead in order), or if results are not those of the stored snapshot. A snapshot that isn't there yet is written."""
    found, again = staged(run(), "run"), staged(run(), "run")
    differ = found.exceptAll(again).count() + again.exceptAll(found).count()
    if differ:
        raise RuleError("a search that is run twice gives the same", f"{differ} rows differ", differ)
    held = staged(evaluate(golden, found), "evaluated")
    missed = held.filter(~F.col("strict") if strict else ~F.col("covered"))
    if n := missed.count():
        raise RuleError("all expected ids are found", str([r["id"] for r in missed.orderBy("id").limit(5).collect()]), n)
    if snapshot is not None:
        store, now = Store(golden.sparkSession, snapshot), _lines(found)
        if not store.exists(snapshot):
            store.write(snapshot, now)
        elif (old := store.read(snapshot)) != now:
            changed = sorted({json.loads(x)["id"] for x in set(old.splitlines()) ^ set(now.splitlines())}, key=str)
            raise RuleError("results are those of the snapshot", str(changed[:5]), len(changed))
    return held
