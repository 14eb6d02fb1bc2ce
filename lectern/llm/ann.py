"""Approximate nearest neighbours by an adaptive dimension scan of probed lists.

Vectors are scaled to unit length and rotated at random, so that any leading dimensions carry their fair
share of a distance. Centroids of a bounded sample divide them into lists. Rows go in cells: a slice of a
list's vectors and a slice of the queries that probe it, both of bounded size, so that a list that holds
a third of all rows is many cells. A cell keeps its vectors in column blocks. After each block, a
candidate is abandoned if its partial distance, scaled to all dimensions, exceeds the query's bound by
the factor that the hypothesis test allows: (1 + EPSILON / sqrt(dimensions seen))^2. Bounds start at the
k-th distance to sampled vectors in the probed lists and tighten as a cell is read.

Equal vectors are searched once: a row of the table of distinct vectors has the k + 1 least ids, which is
all that a result can show of them. Scores are the cosine of the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

#: Rows that centroids are fitted on, at most, and bytes of them.
SAMPLE_ROWS, SAMPLE_BYTES = 16_384, 32 << 20
#: Lists: about the square root of the rows, at most a sixteenth of the sample. So many are probed that this share of sampled vectors' neighbours lie in them.
RECALL, TRIED = 0.97, 512
#: Dimensions in a column block, and the slack of the test.
BLOCK, EPSILON = 16, 2.1
CELL_VECTORS, CELL_QUERIES = 4096, 1024


def usable(vector: Column) -> Column:
    """No null and no non-finite components, and not zero."""
    d = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(d, lambda x: x != 0)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at unit length, without overflow or underflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(dims: int, seed: int = 8) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def fit_centroids(x: np.ndarray, lists: int, rounds: int = 8, seed: int = 8) -> np.ndarray:
    """Spherical k-means; a list that empties keeps its centroid."""
    c = x[np.random.default_rng(seed).permutation(len(x))[:lists]]
    for _ in range(rounds):
        near = np.concatenate([(x[at : at + 4096] @ c.T).argmax(axis=1) for at in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        length = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(length > 1e-12, total / np.maximum(length, 1e-12), c)
    return c


def lists_to_probe(sample: np.ndarray, centroids: np.ndarray, owner: np.ndarray, k: int, recall: float = RECALL) -> int:
    """The number of nearest lists that hold `recall` of the k nearest sampled neighbours of sampled vectors."""
    tried = sample[:: max(1, len(sample) // TRIED)]
    own = np.arange(0, len(sample), max(1, len(sample) // TRIED))
    near = tried @ sample.T
    near[np.arange(len(tried)), own] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return len(centroids)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    place = np.argsort(np.argsort(-(tried @ centroids.T), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, owner[best], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def scan_cell(vectors: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, vector) that a scan by column blocks leaves, with squared distances; the k nearest of each query are among them unless the test errs."""
    n, dims = vectors.shape
    columns = [np.ascontiguousarray(vectors[:, a : a + BLOCK].T) for a in range(0, dims, BLOCK)]
    norms = [(c * c).sum(axis=0) for c in columns]
    bounds = bounds.copy()
    found: list[tuple] = []
    for at in range(0, n, 1024):  # a few vectors at a time, so that what they show tightens the bounds for the rest
        to = min(n, at + 1024)
        seen = min(BLOCK, dims)
        head = queries[:, :BLOCK]
        partial = norms[0][None, at:to] + (head * head).sum(axis=1)[:, None] - 2 * head @ columns[0][:, at:to]
        q, v = np.nonzero(partial * (dims / seen) <= (bounds * (1 + EPSILON / np.sqrt(seen)) ** 2)[:, None] + 1e-9)
        distance = partial[q, v]
        v = v + at
        for i in range(1, len(columns)):
            part = queries[q, i * BLOCK : (i + 1) * BLOCK] - columns[i][:, v].T
            distance = distance + (part * part).sum(axis=1)
            seen = min(dims, seen + BLOCK)
            slack = 1.0 if seen == dims else (1 + EPSILON / np.sqrt(seen)) ** 2
            keep = distance * (dims / seen) <= bounds[q] * slack + 1e-9
            q, v, distance = q[keep], v[keep], distance[keep]
        found.append((q, v, distance))
        if to < n and len(q):
            order = np.lexsort((distance, q))
            starts = np.searchsorted(q[order], np.arange(len(queries)))
            enough = np.flatnonzero(np.diff(np.append(starts, len(q))) >= k)
            kth = distance[order][starts[enough] + k - 1]
            bounds[enough] = np.minimum(bounds[enough], kth)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def search(df: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """The k nearest rows of each row whose key is divisible by `every`: query_id, rank, vec_id, score.

    Rows with a null key, a null or zero vector, or one with null or non-finite components take no part,
    nor do vectors of another length than the commonest (of equals the greatest). Equal vectors tie, to
    the smaller key; a row is no neighbour of itself, but of others with its key and another vector. Rows that
    repeat a key and its vector count as one; queries with one key and several vectors are ranked apart. Fewer
    than k candidates give fewer rows; an empty table none. Other columns are dropped.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    dims = lengths["dims"]
    rows = rows.filter(F.size("v") == dims).withColumn("v", F.transform("v", lambda x: x.cast("double") + F.lit(0.0)))  # -0.0 equals 0.0
    rows = rows.withColumn("h", F.xxhash64("v"))
    # a row per key and vector; before the exchange as well as after it
    rows = rows.dropDuplicates(["id", "h", "v"])

    # distinct vectors, each with its k + 1 least ids; the limit by rank works before the exchange as well as after it
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).filter(F.col("place") <= k + 1)
    distinct = cut(placed.groupBy("h", "v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    n = distinct.count()
    most = min(SAMPLE_ROWS, max(1, SAMPLE_BYTES // (8 * dims)))
    sample = unit(np.array([r["v"] for r in distinct.select("v", "h").orderBy(F.xxhash64("h"), "h").limit(most).collect()], np.float64).reshape(-1, dims))
    turn = rotation(dims)
    sample = sample @ turn
    centroids = fit_centroids(sample, max(1, min(int(n**0.5), len(sample) // 16)))
    owner = np.concatenate([(sample[at : at + 4096] @ centroids.T).argmax(axis=1) for at in range(0, len(sample), 4096)])
    probes = lists_to_probe(sample, centroids, owner, k, recall)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(matrix(batch.column("v"), dims)) @ turn
            near = np.concatenate([(x[at : at + 4096] @ centroids.T).argmax(axis=1) for at in range(0, len(x), 4096)]) if len(x) else np.array([], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int64()), *batch.columns], names=["list", "h", "v", "ids"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = unit(matrix(part.column("v"), dims)) @ turn
                near = np.argsort(-(x @ centroids.T), axis=1, kind="stable")[:, :probes]
                probed = np.zeros((len(x), len(centroids)), bool)
                np.put_along_axis(probed, near, True, axis=1)
                distance = np.where(probed[:, owner], 2 - 2 * (x @ sample.T), np.inf)
                bound = np.partition(distance, k, axis=1)[:, k] if len(sample) > k else np.full(len(x), np.inf)
                row = np.repeat(np.arange(len(x)), probes)
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel(), pa.int64()), part.column("v").take(pa.array(row)), part.column("h").take(pa.array(row)), pa.array(np.maximum(bound, 0)[row])], names=["list", "v", "h", "bound"])

    # queries: one row per distinct vector that a query has
    asked = rows.filter(F.pmod("id", F.lit(every)) == 0)
    questions = cut(asked.groupBy("h", "v").agg(F.lit(1).alias("one")).select("v", "h").mapInArrow(probe, "list long, v array<double>, h long, bound double"), "questions")
    members = cut(distinct.select("h", "v", "ids").mapInArrow(assign, "list long, h long, v array<double>, ids array<bigint>"), "members")

    # cells: lists times slices; the counts are a row per list
    sizes = members.groupBy("list").agg(F.count(F.lit(1)).alias("n")).withColumn("slices", F.ceil(F.col("n") / CELL_VECTORS)).select("list", "slices")
    crowds = questions.groupBy("list").agg(F.count(F.lit(1)).alias("n")).withColumn("crowds", F.ceil(F.col("n") / CELL_QUERIES)).select("list", "crowds")
    cells = F.broadcast(sizes.join(crowds, "list"))  # as many rows as lists, at most
    left = members.join(cells, "list").withColumn("slice", F.pmod(F.xxhash64("h", F.lit(1)), F.col("slices"))).withColumn("crowd", F.explode(F.sequence(F.lit(0), F.col("crowds") - 1))).select("list", "slice", F.col("crowd").cast("long").alias("crowd"), "h", "v", "ids")
    right = questions.join(cells, "list").withColumn("crowd", F.pmod(F.xxhash64("h", F.lit(2)), F.col("crowds"))).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select("list", F.col("slice").cast("long").alias("slice"), "crowd", "h", "v", "bound")

    def cell(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = pa.schema([("h", pa.int64()), ("q", pa.list_(pa.float64())), ("id", pa.int64()), ("score", pa.float64()), ("same", pa.bool_())])
        if not vectors.num_rows or not queries.num_rows:
            return out.empty_table()
        vectors, queries = vectors.combine_chunks(), queries.combine_chunks()
        x, y = (matrix(t.column("v").chunk(0), dims) for t in (vectors, queries))
        q, v, distance = scan_cell(unit(x) @ turn, unit(y) @ turn, queries.column("bound").to_numpy(), k + 1)
        # of each query the k + 1 nearest vectors and all that tie with the last, then scores as defined
        order = np.lexsort((distance, q))
        q, v, distance = q[order], v[order], distance[order]
        starts = np.searchsorted(q, np.arange(len(y) + 1))
        last = np.minimum(starts[:-1] + k, np.maximum(starts[1:] - 1, 0))
        keep = distance <= (distance[last] if len(distance) else np.zeros(len(y)))[q] + 1e-9
        q, v = q[keep], v[keep]
        a, b = y[q], x[v]
        big = np.abs(a).max(axis=1, initial=0), np.abs(b).max(axis=1, initial=0)
        extreme = np.flatnonzero((np.maximum(*big) > 1e150) | (np.minimum(*big) < 1e-150))
        with np.errstate(all="ignore"):
            score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
        if len(extreme):
            score[extreme] = (unit(a[extreme]) * unit(b[extreme])).sum(axis=1)
        same = (a == b).all(axis=1)
        ids = vectors.column("ids").chunk(0).take(pa.array(v))
        many = np.diff(ids.offsets.to_numpy())
        row = np.repeat(np.arange(len(q)), many)
        return pa.table([queries.column("h").take(pa.array(q[row])), queries.column("v").take(pa.array(q[row])), ids.flatten(), pa.array(score[row]), pa.array(same[row])], schema=out)

    keys = ["list", "slice", "crowd"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "h long, q array<double>, id long, score double, same boolean")
    best = Window.partitionBy("h", "q").orderBy(F.desc("score"), "id")
    top = cut(near.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).select("h", "q", "id", "score", "same"), "nearest")

    # each query has the k + 1 nearest of its vector, itself among them or not
    joined = asked.select(F.col("id").alias("query_id"), "h", "v").alias("a").join(top.alias("t"), (F.col("a.h") == F.col("t.h")) & (F.col("a.v") == F.col("t.q")))
    others = joined.filter((F.col("query_id") != F.col("t.id")) | ~F.col("same")).select("query_id", F.col("a.h").alias("h"), F.col("a.v").alias("v"), F.col("t.id").alias("vec_id"), "score")
    ranked = others.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "h", "v").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
