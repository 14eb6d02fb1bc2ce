"""Interaction audit of a set of filters: what each removes, in every order in which they could run.

Each row's failures are one number of five bits. Which step of which order removes it depends on that
number alone: a table of 32 x 120 entries, made once, holds the first step that fails. Batches index it
and count removals by part, order, step and label; these arrays, 600 rows for each part that a task has
seen, are summed. All else follows from the sums: a filter's failures are its removals where it comes
first, what only it finds are its removals where it comes last.

Texts do not leave the JVM: failures are found by expressions, and only (part, failures, labels) go to
Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
#: A task sends what it has counted when it holds this number of parts.
HELD_PARTS = 1000


def first_failures() -> np.ndarray:
    """[failures, order]: the step (from 0) whose filter is the first to fail, STEPS if none does."""
    masks = np.arange(1 << STEPS)
    out = np.full((len(masks), len(ORDERS)), STEPS, np.int64)
    for j, order in enumerate(ORDERS):
        for step in reversed(range(STEPS)):
            out[masks >> FILTERS.index(order[step]) & 1 == 1, j] = step
    return out


def text_failures(text: Column) -> Column:
    """The bits of filters A to D, which look at a text alone; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(t, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(t, "[^A-Z]+", ""))
    fails = [n < 200, distinct * 100 < n * 50, capitals * 100 > F.length(t) * 2, t.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failures(df: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(key, part, fails) of each row, fails without the bit of filter E; and the text's digest, for E."""
    t = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_failures(F.col(text)).alias("fails"), F.unhex(F.sha2(F.encode(t, "UTF-8"), 256)).alias("digest"))


def with_copies(rows: DataFrame) -> DataFrame:
    """Sets the bit of filter E of (key, digest, fails): an identical text has a smaller key. Takes a written table; the digest goes.

    Digests that more keys have are few, and a row each; what is joined to them is a key, not a text, and
    the planner splits a digest that very many rows have.
    """
    repeated = rows.groupBy("digest").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least < most").select("digest", "least")
    fails = F.col("fails") + F.when(F.col("key") > F.col("least"), 1 << FILTERS.index("E")).otherwise(0)
    return rows.join(repeated, "digest", "left").select("key", "part", fails.alias("fails"))


def removals(rows: DataFrame) -> DataFrame:
    """(part, docs, nth, step, removed, good, toxic) of (part, fails, good, toxic): sums over all rows, for every order and step."""
    table_of = first_failures()
    cells = len(ORDERS) * (STEPS + 1)
    names = ["part", "nth", "step", "docs", "removed", "good", "toxic"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for part, n in held.items():
                by_step = n.reshape(4, len(ORDERS), STEPS + 1)
                every = by_step.sum(axis=0)
                nth, step = (x.ravel() for x in np.indices((len(ORDERS), STEPS)))
                sums = [x[:, :STEPS].ravel() for x in (every, by_step[1] + by_step[3], by_step[2] + by_step[3])]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(nth)), pa.array(nth), pa.array(step), *map(pa.array, (np.full(len(nth), every[0].sum()), *sums))], names=names)
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = batch.slice(at, 4096)
                coded = rows.column(0).dictionary_encode()
                codes, labels = coded.indices.to_numpy(), rows.column(2).to_numpy() + 2 * rows.column(3).to_numpy()
                steps = table_of[rows.column(1).to_numpy()]
                parts = coded.dictionary.to_pylist()
                for code in range(0, len(parts), 64):  # so many parts' arrays at a time
                    own = np.flatnonzero((codes >= code) & (codes < code + 64))
                    place = ((codes[own] - code) * 4 + labels[own])[:, None] * cells + np.arange(len(ORDERS)) * (STEPS + 1) + steps[own]
                    some = parts[code : code + 64]
                    n = np.bincount(place.ravel(), minlength=len(some) * 4 * cells).reshape(len(some), -1)
                    for part, counted in zip(some, n, strict=True):
                        held[part] = held[part] + counted if part in held else counted.copy()
                if len(held) > HELD_PARTS:
                    yield from flush()
        yield from flush()

    counted = rows.select("part", F.col("fails").cast("int"), F.col("good").cast("int"), F.col("toxic").cast("int")).mapInArrow(count, "part string, nth long, step long, docs long, removed long, good long, toxic long")
    return counted.groupBy("part", "nth", "step").agg(*[F.sum(c).alias(c) for c in names[3:]])


def audit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """One row per part, order (all 120) and step (1 to 5), zeros included: part, filter_order, step, and counts in the part.

    kept, removed: after and at this step. redundant: fail this filter but are gone already. unique_fails:
    fail no other filter. good_lost, toxic_lost: removed here, by label. shapley: what this filter
    removes, summed over all orders.

    A null text is an empty one, a null part the part of the empty string. A row with a null key is no
    copy and none is a copy of it; rows of one key and text are no copies of each other, and count each.
    Several label rows of a key count as one that has 1 where any of them has; rows without a label, or
    with a null one, are neither good nor toxic. A very long text is read whole. An empty table gives an
    empty table. Other columns are dropped, whatever their names.
    """
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("l_key")).agg(one(quality).alias("good"), one(toxic).alias("toxic")).filter("good + toxic > 0")
    rows = with_copies(cut(failures(df, key, text, part), "failures"))
    labelled = rows.join(known, F.col("key") == F.col("l_key"), "left").select("part", "fails", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")])
    sums = cut(removals(labelled), "removals")
    of_filter = F.element_at(F.split(F.element_at(F.array(*map(F.lit, ORDERS)), (F.col("nth") + 1).cast("int")), ""), (F.col("step") + 1).cast("int"))
    named = sums.withColumn("filter", of_filter).withColumn("filter_order", F.element_at(F.array(*map(F.lit, ORDERS)), (F.col("nth") + 1).cast("int")))
    so_far = Window.partitionBy("part", "nth").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    own = Window.partitionBy("part", "filter")
    first, last = F.max(F.when(F.col("step") == 0, F.col("removed"))), F.max(F.when(F.col("step") == STEPS - 1, F.col("removed")))
    here = F.sum("removed").over(so_far)
    return named.select(
        "part", "filter_order", (F.col("step") + 1).cast("int").alias("step"), (F.col("docs") - here).alias("kept"), "removed", (first.over(own) - F.col("removed")).alias("redundant"),
        last.over(own).alias("unique_fails"), F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("removed").over(own).alias("shapley"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
least AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
w AS (SELECT d.*, least, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d JOIN least USING (t)),
l AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN w.doc_id > least THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(string_split('ABCDE', '')) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, i AS step, substr(filter_order, i, 1) AS own, left(filter_order, i - 1) AS before FROM o, range(1, 6) r(i)),
r AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (translate(fails, before || own, '') = fails) AS kept,
    sum(n) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS removed,
    sum(n) FILTER (contains(fails, own) AND translate(fails, before, '') <> fails) AS redundant,
    sum(n) FILTER (fails = own) AS unique_fails,
    sum(good) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS good_lost,
    sum(toxic) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS toxic_lost
  FROM g, s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
