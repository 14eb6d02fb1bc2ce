"""Integrity rules. A guard is an action of its own: an assertion inside a projection could be pruned away.

Rules give violations as DataFrames; `enforce` counts all of them in one job and reports them together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import RuleError
from ..functions.ids import valid_id
from ..schemas import ACCESS_LEVELS, BOOKS, CANON_STATUS, EDGE_KINDS, FOREIGN_KEYS, KEYS, LANGUAGES, REPORT_STATUS, TABLES
from ..scratch import staged

SAMPLE = 5
#: A share strictly above this breaks a drop-rate rule.
CEILING = 0.005


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-null references without a row to refer to."""
    return child.select(F.col(column).alias("ref")).filter(F.col("ref").isNotNull()).distinct().join(parent.select(F.col(key).alias("ref")), "ref", "left_anti")


def duplicates(df: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """Keys with several rows, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


#: Rows of a run that are looked at together, and references that a task remembers.
RUN, SEEN = 200_000, 200_000


def _marks(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of batches of n key columns in the order of their file: see `marks`."""

    def repeats(keys: pa.Table) -> tuple[pa.Array, pa.Array, list[pa.Array]]:
        """(leading values of runs, whether a key is twice in the run, distinct values of the other columns)."""
        lead, opens, values = keys.column(0).combine_chunks(), np.ones(len(keys), bool), []
        coded = lead.dictionary_encode(null_encoding="encode").indices.to_numpy()
        opens[1:] = coded[1:] != coded[:-1]
        nth, starts = np.cumsum(opens) - 1, np.flatnonzero(opens)
        code, codes = nth.astype(np.int64), len(starts)
        for i in range(1, n):
            other = keys.column(i).combine_chunks().dictionary_encode(null_encoding="encode")
            values.append(other.dictionary)
            if codes * len(other.dictionary) >= 1 << 62:
                code, codes = np.unique(code, return_inverse=True)[1].astype(np.int64), len(keys)
            code, codes = code * len(other.dictionary) + other.indices.to_numpy(), codes * len(other.dictionary)
        twice, ascending = np.zeros(len(starts), bool), np.sort(code)
        if (again := ascending[1:][ascending[1:] == ascending[:-1]]).size:
            twice[nth[np.isin(code, again)]] = True
        return lead.take(pa.array(starts)), pa.array(twice), values

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[set] = [set() for _ in range(n)]

        def out(keys: pa.Table) -> pa.RecordBatch:
            leads, twice, values = repeats(keys)
            column, ref, again = [pa.repeat(pa.scalar(0, pa.int32()), len(leads))], [leads.cast(pa.string())], [twice]
            for i, found in enumerate(values, 1):
                new = set(found.cast(pa.string()).to_pylist()) - seen[i]
                seen[i] = new if len(seen[i]) + len(new) > SEEN else seen[i] | new
                column.append(pa.repeat(pa.scalar(i, pa.int32()), len(new)))
                ref.append(pa.array(list(new), pa.string()))
                again.append(pa.repeat(False, len(new)))
            return pa.RecordBatch.from_arrays([pa.concat_arrays(column), pa.concat_arrays(ref), pa.concat_arrays(again)], ["column", "ref", "again"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            # the last run may go on in the next batch
            lead = rows.column(0).combine_chunks()
            last = pc.fill_null(pc.equal(lead, lead[-1]), False) if lead[-1].is_valid else pc.is_null(lead)
            other = pc.indices_nonzero(pc.invert(last))
            cut = other[-1].as_py() + 1 if len(other) else 0
            if len(rows) - cut > RUN:
                cut = len(rows)
            if cut:
                yield out(rows.slice(0, cut))
            held = rows.slice(cut) if cut < len(rows) else None
        if held is not None:
            yield out(held)

    return marked


def marks(df: DataFrame, keys: tuple[str, ...] | list[str]) -> DataFrame:
    """(column, ref, again) of a table whose rows of one first key mostly lie together, as text and in one pass without a shuffle: the value of each run of the first key (column 0), and whether a key is twice in it; and the values of each other key column, at least once.

    A key that is twice is twice in one run, or its first key has several; so that `suspects` are all that a table can repeat.
    """
    return df.select(*keys).mapInArrow(_marks(len(keys)), "column int, ref string, again boolean")


def suspected(df: DataFrame, keys: tuple[str, ...] | list[str], marked: DataFrame) -> DataFrame:
    """`duplicates` by the marks of the table: only rows whose first key has a key twice in a run, or several runs, are shuffled."""
    several = marked.filter("column = 0").groupBy("ref").agg(F.count(F.lit(1)).alias("runs"), F.bool_or("again").alias("again"))
    suspects = staged(several.filter("runs > 1 OR again").select(F.col("ref").alias("__ref")), "suspects")
    return duplicates(df.join(suspects, F.col(keys[0]).cast("string").eqNullSafe(F.col("__ref")), "left_semi"), keys)


def completeness(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand on one side alone: side is missing (right lacks it) or orphan (left lacks it)."""
    missing = left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti").withColumn("side", F.lit("missing"))
    orphan = right.select(*keys).distinct().join(left.select(*keys), keys, "left_anti").withColumn("side", F.lit("orphan"))
    return missing.unionByName(orphan)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, repeats counted."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def compared(left: DataFrame, right: DataFrame) -> tuple[int, bool]:
    """(rows of left, whether right has the same ones, repeats counted): each side is read and shuffled once."""
    sides = left.withColumn("__left", F.lit(1)).unionByName(right.withColumn("__left", F.lit(0)))
    rows = sides.groupBy(*left.columns).agg(F.sum("__left").alias("l"), F.count(F.lit(1)).alias("both"))
    found = rows.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("n"), F.count_if(F.col("l") * 2 != F.col("both")).alias("differ")).first()
    return found["n"], found["differ"] == 0


def drop_rate(dropped: Column, attempted: Column) -> Column:
    return F.when(attempted == 0, F.lit(0.0)).otherwise(dropped.cast("double") / attempted)


def check_rate(rule: str, dropped: int, attempted: int, ceiling: float = CEILING) -> float:
    rate = dropped / attempted if attempted else 0.0
    if rate > ceiling:
        raise RuleError(rule, f"{dropped} of {attempted} rows dropped, over {ceiling:.2%}", dropped)
    return rate


def row_rules(table: str) -> dict[str, Column]:
    """What each row of a table must hold."""
    c = F.col
    rules: dict[str, Column] = {f"{f.name} is given": c(f.name).isNotNull() for f in TABLES[table].fields if not f.nullable}
    reference = [x for x in ("canonicalId", "sourceId", "targetId") if x in TABLES[table].fieldNames()]
    rules |= {f"{x} is an id": valid_id(c(x)) for x in reference}
    levels = c("authorizedLevels") if table == "verse_texts" else None
    rules |= {
        "canonical_verses": lambda: {"id is an id": valid_id(c("id")), "book is known": c("book").isin(*BOOKS), "chapter > 0": c("chapter") > 0, "verse >= 0": c("verse") >= 0, "canonStatus is known": c("canonStatus").isin(*CANON_STATUS)},
        "verse_texts": lambda: {"text is not empty": c("text") != "", "levels are given": F.size(levels) > 0, "levels are known": F.forall(levels, lambda x: x.isin(*ACCESS_LEVELS))},
        "original_words": lambda: {"position >= 0": c("position") >= 0, "strongId has its form": F.coalesce(c("strongId").rlike(r"^[HG][0-9]{4}$"), F.lit(True)), "a nulled id keeps its raw tag": c("strongId").isNull() | c("strongRaw").isNotNull()},
        "strongs": lambda: {"id has its form": c("id").rlike(r"^[HG][0-9]{1,4}$"), "language is known": c("language").isin(*LANGUAGES)},
        "edges": lambda: {"kind is known": c("kind").isin(*EDGE_KINDS)},
        "embeddings": lambda: {"the vector is not empty": F.size("embedding") > 0},
        "reports": lambda: {"status is known": c("status").isin(*REPORT_STATUS)},
    }.get(table, dict)()
    return rules


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, count, sample) of all rules of rows that some row breaks: one aggregation over the table."""
    broken = {name: ~F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    row = F.to_json(F.struct(*df.columns))
    # a row is written out only where it breaks a rule; the least of these is the sample
    each = [F.struct(F.lit(name).alias("rule"), F.count_if(b).alias("count"), F.min(F.when(b, row)).alias("sample")) for name, b in broken.items()]
    found = df.agg(F.array(*each).alias("x")) if each else df.select(F.array().cast("array<struct<rule:string,count:bigint,sample:string>>").alias("x")).limit(0)
    return found.select(F.explode("x").alias("r")).select("r.*").filter("count > 0").orderBy("rule")


def enforce(checks: dict[str, DataFrame]) -> None:
    """Raises one error for all checks that have rows, with how many and a few of them. All are counted in one job; only a broken one is read again."""
    marked = [df.select(F.lit(i).alias("nth")) for i, df in enumerate(checks.values())]
    broken = {r["nth"]: r["count"] for r in reduce(DataFrame.union, marked).groupBy("nth").count().collect()}
    if broken:
        problems = [(name, broken[i], df) for i, (name, df) in enumerate(checks.items()) if i in broken]
        name, count, df = problems[0]
        sample = [r.asDict(recursive=True) for r in df.limit(SAMPLE).collect()]
        raise RuleError(name, "; ".join(f"{n}: {c} rows" for n, c, _ in problems), count, sample)


def validate(df: DataFrame, table: str) -> None:
    """All rules of rows, and the key's uniqueness, before anything is written."""
    checks = {f"{table}: a rule of rows is broken": violations(df, row_rules(table))}
    if table == "edges":  # which are many, and lie together by source
        checks["edges: the key is not unique"] = suspected(df, KEYS[table], staged(marks(df, KEYS[table]), "marks"))
    elif table in KEYS:
        checks[f"{table}: the key is not unique"] = duplicates(df, KEYS[table])
    enforce(checks)


def cross_check(tables: dict[str, DataFrame], values: dict[tuple[str, str], DataFrame] | None = None) -> DataFrame:
    """All broken references among the given tables, as (child, column, ref). Where the values of a column are known they are given by (child, column), each at least once."""
    found = [orphans((values or {}).get((child, column), tables[child]), column, tables[parent], key).select(F.lit(child).alias("child"), F.lit(column).alias("column"), "ref") for child, column, parent, key in FOREIGN_KEYS if child in tables and parent in tables]
    return reduce(DataFrame.unionByName, found)


def require_rows(df: DataFrame, rule: str) -> DataFrame:
    if df.isEmpty():
        raise RuleError(rule, "no rows", 0)
    return df
