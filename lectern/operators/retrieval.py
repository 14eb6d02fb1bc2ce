"""Deterministic retrieval: exact vector search behind hard filters, record lookup, bounded graph walks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import RuleError
from ..functions.ids import ID
from ..schemas import BOOKS
from .embedding import answer, check_build, stamp

LIMITS, HOPS = (1, 50, 10), (1, 3, 1)


def _bounded(value: int | None, bounds: tuple[int, int, int], what: str) -> int:
    low, high, default = bounds
    value = default if value is None else value
    if not isinstance(value, int) or isinstance(value, bool) or not low <= value <= high:
        raise RuleError(f"{what} is from {low} to {high}", str(value))
    return value


def check_id(value: str) -> str:
    import re

    if not isinstance(value, str) or re.fullmatch(ID.strip("^$"), value) is None or value[:3] not in BOOKS:
        raise RuleError("an id is valid", str(value))
    return value


def dot(a: Column, b: Column) -> Column:
    """In double precision, in the order of the components."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine_distance(a: Column, b: Column) -> Column:
    """Null for a null, zero or differently sized vector."""
    size = norm(a) * norm(b)
    return F.when((size > 0) & (F.size(a) == F.size(b)), 1 - dot(a, b) / size)


def may_see(row_levels: Column, levels: Sequence[str], superset: bool = False) -> Column:
    """Some of a row's levels are the user's; with `superset` the row's hold all of the user's."""
    own = F.array(*[F.lit(x) for x in levels])
    return F.size(F.array_except(own, row_levels)) == 0 if superset else F.arrays_overlap(row_levels, own)


def nearest(rows: DataFrame, vector: str, query: Sequence[float], limit: int | None = None, order: Sequence[str] = (), keep: Column | None = None) -> DataFrame:
    """The rows nearest to a vector, after the hard filter; exact, ties by `order`, rows without a vector left out."""
    limit = _bounded(limit, LIMITS, "the limit")
    found = rows.filter(keep) if keep is not None else rows
    found = found.filter(F.col(vector).isNotNull())
    distance = cosine_distance(F.col(vector), F.array(*[F.lit(float(x)) for x in query]))
    return found.withColumn("distance", distance).filter("distance IS NOT NULL").orderBy("distance", *order).limit(limit)


def search_by_theme(texts: DataFrame, verses: DataFrame, embed, query: str, levels: Sequence[str], translation: str | None = None, limit: int | None = None, canon: Sequence[str] = ("protestant",), pin: tuple[str, str] | None = None) -> DataFrame:
    """(canonicalId, translation, text, distance): the query is embedded by the pinned build (model, revision; the embedder's own if none is given), only rows of that build are ranked, filters come before ranking, ties by id and translation."""
    health = embed.health()
    if pin is not None:
        check_build(health, *pin)
    if len(query.strip()) < 2:
        raise RuleError("a query has 2 characters", query)
    allowed = texts.join(verses.filter(F.col("canonStatus").isin(*canon)).select(F.col("id").alias("canonicalId")), "canonicalId", "left_semi")
    keep = may_see(F.col("authorizedLevels"), levels) & (F.col("embeddingModel") == stamp(health))
    if translation is not None:
        keep = keep & (F.col("translation") == translation)
    (vector,), made = answer(embed, [query])
    if made != stamp(health):
        raise RuleError("the build stays the same", made)
    return nearest(allowed, "embedding", vector, limit, ("canonicalId", "translation"), keep).select("canonicalId", "translation", "text", "distance")


def search_passages(passages: DataFrame, verses: DataFrame, query: Sequence[float], limit: int | None = None) -> DataFrame:
    """(passageId, distance, canonicalId): the nearest passages, written out into the verses between their ends."""
    top = nearest(passages, "embedding", query, limit, ("passageId",)).select("passageId", "distance", F.col("book").alias("p_book"), F.col("chapter").alias("p_chapter"), "verseStart", "verseEnd")
    inside = (F.col("book") == F.col("p_book")) & (F.col("chapter") == F.col("p_chapter")) & F.col("verse").between(F.col("verseStart"), F.col("verseEnd"))
    return F.broadcast(top).join(verses, inside).select("passageId", "distance", F.col("id").alias("canonicalId")).orderBy("distance", "passageId", "canonicalId")


def children(parents: DataFrame, key: str, rows: DataFrame, foreign: str, fields: Sequence[str], out: str) -> DataFrame:
    """Adds to each parent the sorted array of its rows' fields, empty if it has none; no row is merged with another."""
    made = rows.groupBy(F.col(foreign).alias("__k")).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))
    joined = parents.join(made, F.col(key) == F.col("__k"), "left").drop("__k")
    kind = made.schema[out].dataType.simpleString()
    return joined.withColumn(out, F.coalesce(out, F.array().cast(kind)))


def get_verse(canonical_id: str, levels: Sequence[str], verses: DataFrame, texts: DataFrame, words: DataFrame, interpretations: DataFrame, canon: Sequence[str] = ("protestant",)) -> DataFrame:
    """One row with texts, originalWords and interpretations, or none for an unknown id or one of another canon. Each child is filtered to the key before it is gathered."""
    at = F.col("canonicalId") == check_id(canonical_id)
    found = verses.filter((F.col("id") == canonical_id) & F.col("canonStatus").isin(*canon))
    found = children(found, "id", texts.filter(at & may_see(F.col("authorizedLevels"), levels)), "canonicalId", ("translation", "text"), "texts")
    found = children(found, "id", words.filter(at), "canonicalId", ("position", "lexeme", "strongId", "strongRaw", "morphology", "edition"), "originalWords")
    return children(found, "id", interpretations.filter(at), "canonicalId", ("viewLabel", "text", "tradition", "source"), "interpretations")


def exegesis(canonical_id: str, levels: Sequence[str], verses: DataFrame, texts: DataFrame, words: DataFrame, lexicon: DataFrame, interpretations: DataFrame, canon: Sequence[str] = ("protestant",)) -> DataFrame:
    """As get_verse, with each word's entry beside it; words without one stay."""
    entries = lexicon.select(F.col("id").alias("strongId"), "lemma", "transliteration", "definition")
    own = words.filter(F.col("canonicalId") == check_id(canonical_id)).join(entries, "strongId", "left")
    found = get_verse(canonical_id, levels, verses, texts, words.limit(0), interpretations, canon).drop("originalWords")
    return children(found, "id", own, "canonicalId", ("position", "lexeme", "strongId", "strongRaw", "morphology", "edition", "lemma", "transliteration", "definition"), "originalWords")


def walk(edges: DataFrame, start: Column | str | int, hops: int | None = None, allowed: DataFrame | None = None, source: str = "sourceId", target: str = "targetId", kind: str = "kind") -> DataFrame:
    """(depth, source, target, kind): edges reached from a node within 1 to 3 hops, each once at its least depth, in total order. A start given as a string is an id.

    A path never visits a node twice. `allowed` (one column, the node) is applied to every hop's targets,
    so that nothing is reached through a node that may not be seen. Hops are unrolled joins. Nodes move
    on, not paths: a node goes on once, from its least depth, with the least and the greatest node before
    it. At three hops that is all that a path's other nodes can matter for: an edge back to the one node
    before is barred only if there is no other way to come.
    """
    hops = _bounded(hops, HOPS, "hops")
    if isinstance(start, str):
        check_id(start)
    e = edges.select(F.col(source).alias("source"), F.col(target).alias("target"), F.col(kind).alias("kind"))
    if allowed is not None:
        e = e.join(allowed.select(F.col(allowed.columns[0]).alias("target")).distinct(), "target", "left_semi").select("source", "target", "kind")
    begin = start if isinstance(start, Column) else F.lit(start)
    e = e.filter((F.col("target") != begin) & (F.col("target") != F.col("source")))
    step = e.filter(F.col("source") == begin)
    out, seen = step.withColumn("depth", F.lit(1)), None
    for depth in range(2, hops + 1):
        reached = step.groupBy(F.col("target").alias("node")).agg(F.min("source").alias("low"), F.max("source").alias("high"))
        frontier = reached if seen is None else reached.join(seen, "node", "left_anti")
        seen = frontier.select("node") if seen is None else seen.union(frontier.select("node"))
        step = e.join(frontier, F.col("source") == F.col("node")).filter((F.col("low") != F.col("target")) | (F.col("high") != F.col("target"))).select("source", "target", "kind")
        out = out.unionByName(step.withColumn("depth", F.lit(depth)))
    least = out.groupBy("source", "target", "kind").agg(F.min("depth").alias("depth"))
    return least.select("depth", "source", "target", "kind").orderBy("depth", "source", "target", "kind")


def evaluate(golden: DataFrame, got: DataFrame) -> DataFrame:
    """Of golden (id, expectedIds) and got (id, rank, canonicalId): whether all expected ids were found, and whether they lead in order."""
    lists = got.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "canonicalId"))), lambda x: x["canonicalId"]).alias("found"))
    joined = golden.join(lists, "id", "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))
    return joined.select("id", (F.size(F.array_except("expectedIds", "found")) == 0).alias("covered"), (F.slice("found", F.lit(1), F.size("expectedIds")) == F.col("expectedIds")).alias("strict"))
