"""Versification as DataFrame algebra: which rules hold for an edition, and where each of its verses lands in the master numbering.

Rules come from sources.tabular.read_rules, editions as rows of sources.xml.USFX_ROWS.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import book_ordinal, rule_book
from ..functions.text import word_count
from ..scratch import sorted_side, staged
from .quality import enforce


def features(usfx: DataFrame) -> DataFrame:
    """(book, chapter, verse, word_count, is_last, has_text) of an edition; verse 0 is a chapter's title, and a bridge is each of its verses."""
    chapters = usfx.filter("kind = 'chapter'").select("book", "chapter", F.col("verse_end").alias("last_verse"), F.coalesce("text", F.lit("")).alias("title"))
    bodies = usfx.filter("kind = 'verse'").select("book", "chapter", F.explode(F.sequence("verse", "verse_end")).alias("verse"), F.coalesce("text", F.lit("")).alias("text"))
    joined = bodies.join(chapters.select("book", "chapter", "last_verse"), ["book", "chapter"]).select("book", "chapter", "verse", "text", (F.col("verse") == F.col("last_verse")).alias("is_last"))
    titles = chapters.select("book", "chapter", F.lit(0).alias("verse"), F.col("title").alias("text"), F.lit(False).alias("is_last"))
    return joined.unionByName(titles).select("book", "chapter", "verse", word_count(F.col("text")).alias("word_count"), "is_last", (F.col("text") != "").alias("has_text"))


def last_verses(usfx: DataFrame) -> DataFrame:
    """(book, chapter, last_verse) of the master edition."""
    return usfx.filter("kind = 'chapter'").select("book", "chapter", F.col("verse_end").alias("last_verse"))


def _place(ref: Column) -> list[Column]:
    """A reference's book, chapter and verse as features have them; null where none can match (a part of a verse, a lettered chapter)."""
    whole = ref["subverse"].isNull() & ref["chapter_letter"].isNull()
    return [F.when(whole, rule_book(ref["book"])["book"]).alias("book"), ref["chapter"].alias("chapter"), F.when(ref["is_title"], 0).otherwise(ref["verse"]).alias("verse")]


def active_rules(rules: DataFrame, known: DataFrame) -> DataFrame:
    """(line_no) of rules all of whose tests hold in an edition with the given features; without tests a rule always holds."""
    tests = rules.select("line_no", F.posexplode("tests").alias("nth", "t")).select("line_no", "nth", "t.*")
    # a term per side of a comparison, and one for any other test; signs tell the sides apart
    one = F.array(F.struct(F.col("ref"), F.lit(1).alias("factor"), F.lit(1).alias("side")))
    side = lambda c, s: F.transform(F.coalesce(c, F.array().cast("array<struct<ref:struct<book:string,chapter:int,chapter_letter:string,verse:int,is_title:boolean,subverse:string>,factor:int>>")), lambda t: F.struct(t["ref"].alias("ref"), t["factor"].alias("factor"), F.lit(s).alias("side")))
    terms = tests.withColumn("term", F.explode(F.when(F.col("kind") == "compare", F.concat(side(F.col("left"), 1), side(F.col("right"), -1))).otherwise(one)))
    terms = terms.select("line_no", "nth", "kind", "op", "expected", F.col("term.factor").alias("factor"), F.col("term.side").alias("side"), *_place(F.when(F.col("kind") == "text_before", F.struct(*[(F.lit(True) if f == "is_title" else F.lit(None).cast("int") if f == "verse" else F.col(f"term.ref.{f}")).alias(f) for f in ("book", "chapter", "chapter_letter", "verse", "is_title", "subverse")])).otherwise(F.col("term.ref"))))
    found = terms.join(sorted_side(known), ["book", "chapter", "verse"], "left")
    has, last, words = F.coalesce("has_text", F.lit(False)), F.coalesce("is_last", F.lit(False)), F.coalesce("word_count", F.lit(0))
    tested = found.groupBy("line_no", "nth", "kind", "op", "expected").agg(F.bool_and(has).alias("has"), F.bool_and(last).alias("last"), F.sum(words * F.col("factor") * F.col("side")).alias("balance"))
    holds = (
        F.when(F.col("kind") == "last", F.col("last"))
        .when(F.col("kind") == "compare", F.when(F.col("op") == "<", F.col("balance") < 0).otherwise(F.col("balance") > 0))
        .otherwise(F.col("has") == F.col("expected"))
    )
    failed = tested.filter(~holds).select("line_no").distinct()
    return rules.select("line_no").distinct().join(sorted_side(failed), "line_no", "left_anti")


def standard_targets(rules: DataFrame, last: DataFrame) -> DataFrame:
    """(line_no, source_type, book, chapter, verse, subverse): a rule's references in the master numbering; ranges are written out over chapters."""
    items = rules.select("line_no", "source_type", F.explode("standard").alias("i"))
    start, end = F.col("i.start"), F.col("i.end")
    placed = items.select(
        "line_no", "source_type", F.col("i.kind").alias("kind"), rule_book(start["book"])["book"].alias("book"), rule_book(end["book"])["book"].alias("end_book"),
        start["chapter"].alias("chapter"), F.when(start["is_title"], 0).otherwise(start["verse"]).alias("verse"), start["subverse"].alias("subverse"),
        end["chapter"].alias("end_chapter"), end["verse"].alias("end_verse"), (start["chapter_letter"].isNotNull() | F.coalesce(end["chapter_letter"].isNotNull(), F.lit(False))).alias("lettered"),
    )
    placed = staged(placed, "targets")
    singles = placed.filter("kind = 'single'").select("line_no", "source_type", "book", "chapter", "verse", "subverse")
    ranges = placed.filter("kind = 'range'")
    per_chapter = ranges.withColumn("at", F.explode(F.when(F.col("end_chapter") >= F.col("chapter"), F.sequence("chapter", "end_chapter")).otherwise(F.array().cast("array<int>"))))
    bounded = per_chapter.join(last.select("book", F.col("chapter").alias("at"), "last_verse"), ["book", "at"], "left")
    first = F.when(F.col("at") == F.col("chapter"), F.col("verse")).otherwise(1)
    to = F.when(F.col("at") == F.col("end_chapter"), F.col("end_verse")).otherwise(F.col("last_verse"))
    bounded = staged(bounded.withColumn("first", first).withColumn("to", to), "bounded")
    enforce({
        "a target's book is in the canon": placed.filter("book IS NULL OR kind = 'raw'").select("line_no"),
        "a target's chapter is a number": placed.filter("lettered").select("line_no"),
        "a range stays in its book": ranges.filter("book <> end_book").select("line_no"),
        "a range is not empty": ranges.select("line_no", "chapter", "end_chapter").join(sorted_side(bounded.filter("first <= to").select("line_no").distinct()), "line_no", "left_anti"),
        "the master has a range's chapters": bounded.filter("to IS NULL").select("line_no", "book", "at"),
    })
    # ranges are small and become many verses, so that the size of their table says nothing of the tasks that these take
    dealt = bounded.filter("first <= to").repartition(8 * bounded.sparkSession.sparkContext.defaultParallelism, "line_no", "at")
    spread = dealt.select("line_no", "source_type", "book", F.col("at").alias("chapter"), F.explode(F.sequence("first", "to")).alias("verse"), F.lit(None).cast("string").alias("subverse"))
    return singles.unionByName(spread)


def matching_rules(verses: DataFrame, rules: DataFrame) -> DataFrame:
    """(book, chapter, verse, line_no): a verse lies in a source item of the rule; parts of verses match the whole verse, titles and lettered chapters nothing."""
    items = rules.select("line_no", F.explode("source").alias("i"))
    start, end = F.col("i.start"), F.when(F.col("i.kind") == "range", F.col("i.end")).otherwise(F.col("i.start"))
    usable = (F.col("i.kind") != "raw") & ~start["is_title"] & ~end["is_title"] & start["chapter_letter"].isNull() & end["chapter_letter"].isNull()
    spans = items.filter(usable).select(
        "line_no", rule_book(start["book"])["book"].alias("s_book"), (start["chapter"] * 1000 + start["verse"]).alias("low"), (end["chapter"] * 1000 + end["verse"]).alias("high")
    )
    at = F.col("chapter") * 1000 + F.col("verse")
    found = ["book", "chapter", "verse", "line_no"]
    # most items are one verse and meet it by its place; ranges meet chapter by chapter, and their first and last one by verse
    single = F.col("low") == F.col("high")
    placed = verses.withColumn("__at", at)
    one = placed.join(sorted_side(spans.filter(single)), (F.col("book") == F.col("s_book")) & (F.col("__at") == F.col("low"))).select(*found)
    chapters = spans.filter(~single & (F.col("low") < F.col("high"))).withColumn("s_chapter", F.explode(F.sequence(F.floor(F.col("low") / 1000), F.floor(F.col("high") / 1000))))
    ranged = placed.join(sorted_side(chapters), (F.col("book") == F.col("s_book")) & (F.floor(F.col("__at") / 1000) == F.col("s_chapter")) & F.col("__at").between(F.col("low"), F.col("high"))).select(*found)
    return one.unionByName(ranged).distinct()


def map_verses(verses: DataFrame, rules: DataFrame, known: DataFrame, last: DataFrame, tradition: str) -> DataFrame:
    """(book, chapter, verse, targets) of (book, chapter, verse), targets an array of struct(book, chapter, verse, subverse) in canonical order.

    Rules of one tradition add up. If all traditions agree, or else those that hold the wanted label,
    their targets are it; a verse without rules stays itself; anything else is ambiguous and an error.
    """
    active = staged(rules.join(sorted_side(active_rules(rules, known)), "line_no", "left_semi"), "active")
    targets = standard_targets(active, last).withColumnsRenamed({"book": "t_book", "chapter": "t_chapter", "verse": "t_verse"})
    met = matching_rules(verses.select("book", "chapter", "verse").distinct(), active).join(sorted_side(targets), "line_no")
    keys = ["book", "chapter", "verse"]
    # the whole verse wins over a part of it; of parts that of the earliest line
    part = F.when(F.bool_or(F.col("subverse").isNull()), F.lit(None).cast("string")).otherwise(F.min_by("subverse", "line_no"))
    each = met.groupBy(*keys, "source_type", "t_book", "t_chapter", "t_verse").agg(part.alias("subverse"), F.min("line_no").alias("line_no"))
    place = F.struct(book_ordinal(F.col("t_book")).alias("o"), F.col("t_chapter").alias("chapter"), F.col("t_verse").alias("verse"), F.col("t_book").alias("book"), F.col("subverse").alias("subverse"))
    outcome = each.groupBy(*keys, "source_type").agg(F.array_sort(F.collect_list(place)).alias("set"), F.min("line_no").alias("line_no"))
    outcome = outcome.withColumn("signature", F.array_join(F.transform("set", lambda x: F.concat_ws("_", x["book"], x["chapter"].cast("string"), x["verse"].cast("string"))), ";"))
    wanted = F.array_contains(F.transform(F.split("source_type", r"\+"), lambda x: F.trim(x)), tradition)
    decided = outcome.groupBy(*keys).agg(
        F.count_distinct("signature").alias("all"), F.count_distinct(F.when(wanted, F.col("signature"))).alias("own"),
        F.min_by("set", "line_no").alias("any_set"), F.min_by("set", F.when(wanted, F.col("line_no"))).alias("own_set"), F.sort_array(F.collect_set("line_no")).alias("lines"),
    )
    decided = staged(decided, "decided")
    enforce({"a verse's rules agree": decided.filter("all > 1 AND own <> 1").select(*keys, "lines").orderBy(*keys)})
    chosen = decided.select(*keys, F.when(F.col("all") == 1, F.col("any_set")).otherwise(F.col("own_set")).alias("set"))
    itself = F.array(F.struct(F.col("book").alias("book"), F.col("chapter").alias("chapter"), F.col("verse").alias("verse"), F.lit(None).cast("string").alias("subverse")))
    mapped = F.transform("set", lambda x: F.struct(x["book"].alias("book"), x["chapter"].alias("chapter"), x["verse"].alias("verse"), x["subverse"].alias("subverse")))
    return verses.join(sorted_side(chosen), keys, "left").withColumn("targets", F.coalesce(mapped, itself)).drop("set")


def compare_mappings(left: DataFrame, right: DataFrame, key: str, accepted: DataFrame) -> DataFrame:
    """Keys whose two sets of ids differ, other than those accepted (key, kind): granularity if both lie in one chapter, overlap and leave no verse out, else conflict."""
    joined = left.select(key, F.array_sort("ids").alias("a")).join(right.select(key, F.array_sort("ids").alias("b")), key, "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
    both = F.array_union("a", "b")
    chapters = F.array_distinct(F.transform(both, lambda i: F.regexp_replace(i, "_[0-9]+$", "")))
    numbers = F.transform(both, lambda i: F.regexp_extract(i, "([0-9]+)$", 1).cast("int"))
    near = (F.size(chapters) == 1) & F.arrays_overlap("a", "b") & (F.array_max(numbers) - F.array_min(numbers) + 1 == F.size(F.array_distinct(numbers)))
    kinds = joined.withColumn("kind", F.when(F.coalesce(near, F.lit(False)), "granularity").otherwise("conflict"))
    return kinds.join(accepted, [key, "kind"], "left_anti")
