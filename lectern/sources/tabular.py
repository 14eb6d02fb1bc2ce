"""The tab-separated sources: versification rules, tagged words and cross references.

Each reader filters its lines with native expressions before anything else, keeps 1-based line numbers,
fails loudly on what is outside the known vocabulary, and counts what is known and left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import RuleError
from ..functions import grammar, refs, tags
from ..functions.ids import id_key, make_id, ref_key, rule_book
from ..functions.ordering import spread_position
from ..operators.quality import CEILING, check_rate, enforce, require_rows
from ..schemas import RULE_ACTIONS
from ..scratch import staged
from .lines import cells

# Marks and headers of the formats.
HEADER = r"^From Verse\tTo Verse\tVotes"
START, END = "#DataStart(Expanded)", "#DataEnd(Expanded)"


def read_rules(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rules, skipped) of (line_no, line): the expanded section between its marks, without header, separators, comments and rows without a source.

    rules: line_no, source_type, source (items), standard (items), action, starred, tests. skipped: line_no, reason.
    """
    marks = lines.agg(F.min(F.when(F.trim("line").startswith(START), F.col("line_no"))).alias("start"), F.min(F.when(F.trim("line").startswith(END), F.col("line_no"))).alias("end")).first()
    if marks["start"] is None or marks["end"] is None:
        raise RuleError("the expanded section has both marks", ", ".join(m for m, at in ((START, marks["start"]), (END, marks["end"])) if at is None))
    inside = lines.filter((F.col("line_no") > marks["start"]) & (F.col("line_no") < marks["end"]))
    body = cells(inside.filter(~F.col("line").startswith("'") & ~F.col("line").startswith("#") & ~F.col("line").startswith("SourceType\t")))
    cell = lambda i: F.trim(F.coalesce(F.get("cells", F.lit(i)), F.lit("")))
    rows = body.select("line_no", cell(0).alias("source_type"), cell(1).alias("source_text"), cell(2).alias("standard_text"), cell(3).alias("action_text"), cell(8).alias("tests_text")).filter("source_text != ''")
    rows = rows.withColumn("starred", F.col("action_text").endswith("*")).withColumn("action", F.regexp_replace("action_text", r"\*$", ""))
    rows = rows.repartition(2 * lines.sparkSession.sparkContext.defaultParallelism, "line_no")  # one split's lines would all be parsed in one task
    parsed = rows.withColumn("s", grammar.refs_column("source_text")).withColumn("t", grammar.refs_column("standard_text"))
    parsed = parsed.withColumn("p", grammar.tests_column("tests_text", F.regexp_extract("source_text", r"^([0-9]?[A-Z][A-Za-z0-9]{1,3})\.", 1)))
    error = F.coalesce(F.when(~F.col("action").isin(*RULE_ACTIONS), F.concat(F.lit("unknown action "), F.col("action"))), F.col("s.error"), F.col("t.error"), F.col("p.error"))
    parsed = staged(parsed.withColumn("error", error), "rules")
    enforce({"rules can be read": parsed.filter("error IS NOT NULL").select("line_no", "error").orderBy("line_no")})
    all_items = F.concat("s.items", "t.items")
    known = F.forall(all_items, lambda i: (i["kind"] != "raw") & (rule_book(i["start"]["book"])["status"] == "known"))
    kept = parsed.filter(known).select("line_no", "source_type", F.col("s.items").alias("source"), F.col("t.items").alias("standard"), "action", "starred", F.col("p.tests").alias("tests"))
    skipped = parsed.filter(~known).select("line_no", F.lit("book left out").alias("reason"))
    return require_rows(kept, "there are rules"), skipped


WORD_LINE = r"#[0-9]+="


def _kept(rows: DataFrame, name: str, keep: Column, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """(rows to keep, written once; counts of all rows, taken as they are written). No row may have an error."""
    seen = Observation()
    found = rows.observe(seen, F.count(F.lit(1)).alias("word_lines"), F.count("error").alias("wrong"), *[F.count_if(c).alias(n) for n, c in counts.items()])
    kept = staged(found.filter(keep | F.col("error").isNotNull()).select("line_no", "error", *_WORD), name)
    stats = dict(seen.get)
    if stats.pop("wrong"):
        enforce({"words can be read": kept.filter("error IS NOT NULL").select("line_no", "error").orderBy("line_no")})
    return kept, stats


#: What a tagged word has besides its position.
_WORD = ("canonicalId", "lexeme", "strongId", "strongRaw", "morphology", "edition")


def _placed(kept: DataFrame, rows: int) -> DataFrame:
    first, *rest = _WORD
    return spread_position(kept.select("line_no", *_WORD), first, "line_no", rows=rows).select(first, "position", *rest)


def read_hebrew_words(lines: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """(tagged words, counts): a word line has the word mark in its first cell and 17 cells; an empty lexeme is left out and counted. Lines are parsed and counted once, as the words are written to a staged table that is read for the result alone."""
    words = cells(lines.filter(F.substring_index("line", "\t", 1).rlike(WORD_LINE)))
    cell = lambda i: F.trim(F.get("cells", F.lit(i)))
    rows = words.select("line_no", F.size("cells").alias("n"), refs.hebrew_ref(cell(0)).alias("ref"), cell(1).alias("lexeme"), F.nullif(cell(4), F.lit("")).alias("strongRaw"), F.nullif(cell(5), F.lit("")).alias("morphology"))
    rows = rows.withColumn("tag", tags.hebrew_roots(F.col("strongRaw")))
    error = F.coalesce(F.when(F.col("n") != 17, F.concat(_text("n"), F.lit(" cells in place of 17"))), F.col("ref.error"), F.col("tag.error"))
    rows = rows.select("line_no", error.alias("error"), F.col("ref.status").alias("status"), refs.canonical_ref(F.col("ref"), greek=False).alias("canonicalId"), "lexeme", F.col("tag.root").alias("strongId"), "strongRaw", "morphology", F.col("ref.type.raw").alias("edition"))
    known, empty = F.col("status") == "known", F.col("lexeme") == ""
    kept, stats = _kept(rows, "hebrew", known & ~empty, skipped_books=F.col("status") == "excluded", skipped_empty=known & empty)
    stats["produced"] = stats["word_lines"] - stats["skipped_books"] - stats["skipped_empty"]
    return _placed(kept, stats["produced"]), stats


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def read_greek_words(lines: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """(tagged words, counts): unlike Hebrew ones, an empty lexeme or tag on a word line is an error. Lines are parsed and counted once, as the words are written to a staged table that is read for the result alone."""
    words = cells(lines.filter(F.substring_index("line", "\t", 1).rlike(WORD_LINE)))
    cell = lambda i: F.trim(F.coalesce(F.get("cells", F.lit(i)), F.lit("")))
    rows = words.select("line_no", refs.greek_ref(cell(0)).alias("ref"), cell(1).alias("lexeme"), cell(3).alias("cell")).withColumn("tag", tags.greek_tag(F.col("cell")))
    error = F.coalesce("ref.error", F.when(F.col("lexeme") == "", "lexeme"), F.when(F.col("cell") == "", "tag"), "tag.error", tags.word_type(F.col("ref.type"))["error"])
    rows = rows.select("line_no", error.alias("error"), F.col("ref.status").alias("status"), refs.canonical_ref(F.col("ref"), greek=True).alias("canonicalId"), "lexeme", F.col("tag.root").alias("strongId"), F.col("tag.raw").alias("strongRaw"), F.col("tag.grammar").alias("morphology"), F.col("ref.type").alias("edition"))
    kept, stats = _kept(rows, "greek", F.col("status") == "known", skipped_books=F.col("status") == "excluded")
    stats["produced"] = stats["word_lines"] - stats["skipped_books"]
    return _placed(kept, stats["produced"]), stats


def edition_counts(words: DataFrame) -> DataFrame:
    """How many words stand in each edition, and in one alone."""
    k, n = tags.in_received_text(F.col("edition")), tags.in_critical_text(F.col("edition"))
    return words.agg(F.count_if(k).alias("received"), F.count_if(n).alias("critical"), F.count_if(k & ~n).alias("received_only"), F.count_if(n & ~k).alias("critical_only"))


def verse_sizes(words_lines: DataFrame) -> DataFrame:
    """Of (line_no, ref): words per verse and whether any is a title's, books by first appearance."""
    keyed = words_lines.filter(F.col("ref.status") == "known").select("line_no", "ref.book", "ref.chapter", "ref.verse")
    sized = keyed.groupBy("book", "chapter", "verse").agg(F.count(F.lit(1)).alias("words"), (F.min("verse") == 0).alias("has_title"), F.min("line_no").alias("first_line"))
    return sized.withColumn("book_first", F.min("first_line").over(Window.partitionBy("book")))


def read_xrefs(lines: DataFrame, ceiling: float = CEILING) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(direct edges, ranges, counts): three columns under a header; verse ranges inside a chapter become an edge per verse, longer ones are left for the inventory.

    Both come in reference order. A range is inclusive and never descends. Lines that touch a book left out are dropped, up to a ceiling.
    """
    first = lines.filter("line_no = 1").select("line")
    enforce({"the header is known": first.filter(~F.col("line").rlike(HEADER)).select("line")})
    body = cells(lines.filter((F.col("line_no") > 1) & (F.trim("line") != "")))
    enforce({"a line has 3 columns": body.filter(F.size("cells") != 3).select("line_no", "line").orderBy("line_no"), "votes are a number": body.filter(~F.coalesce(F.get("cells", F.lit(2)).rlike(r"^-?[0-9]+$"), F.lit(False))).select("line_no", "line").orderBy("line_no")})
    target = F.split(F.get("cells", F.lit(1)), "-", -1)
    rows = body.select("line_no", refs.xref(F.get("cells", F.lit(0))).alias("source"), refs.xref(F.get(target, F.lit(0))).alias("start"), F.when(F.size(target) > 1, refs.xref(F.get(target, F.lit(1)))).alias("end"), (F.size(target) > 2).alias("odd"), F.get("cells", F.lit(2)).cast("int").alias("votes"))
    key = lambda c: ref_key(F.col(f"{c}.book"), F.col(f"{c}.chapter"), F.col(f"{c}.verse"))
    rows = rows.withColumn("error", F.coalesce("source.error", "start.error", "end.error", F.when(F.col("odd"), "range"), F.when(key("end") < key("start"), "descends")))
    rows = staged(rows, "xrefs")
    enforce({"references can be read": rows.filter("error IS NOT NULL").select("line_no", "error").orderBy("line_no")})
    out_of_canon = (F.col("source.status") == "excluded") | (F.col("start.status") == "excluded") | F.coalesce(F.col("end.status") == "excluded", F.lit(False))
    ranged = F.col("end").isNotNull()
    inside = ranged & (F.col("start.book") == F.col("end.book")) & (F.col("start.chapter") == F.col("end.chapter"))
    kept = rows.filter(~out_of_canon)
    made = lambda c, verse=None: make_id(F.col(f"{c}.book"), F.col(f"{c}.chapter"), F.col(f"{c}.verse") if verse is None else verse)
    span = F.when(inside, F.sequence("start.verse", "end.verse")).otherwise(F.array("start.verse"))
    direct = kept.filter(~ranged | inside).withColumn("v", F.explode(span)).select(made("source").alias("sourceId"), made("start", F.col("v")).alias("targetId")).distinct()
    ranges = kept.filter(ranged & ~inside).select(made("source").alias("sourceId"), made("start").alias("startId"), made("end").alias("endId")).distinct()
    stats = rows.agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(out_of_canon).alias("discarded"), F.count_if(F.col("votes") < 0).alias("negative_votes"),
        F.count_if(inside & ~out_of_canon).alias("inner_ranges"), F.count_if(ranged & ~inside & ~out_of_canon).alias("outer_ranges"),
        F.sum(F.when(inside & ~out_of_canon, F.col("end.verse") - F.col("start.verse") + 1).otherwise(0)).alias("expanded"),
    ).first().asDict()
    check_rate("cross references outside the canon", stats["discarded"], stats["lines"], ceiling)
    counts = {**stats, "edges": direct.count(), "ranges": ranges.count()}
    by_id = lambda *names: [x for n in names for x in (id_key(F.col(n)), F.col(n))]
    return direct.orderBy(*by_id("sourceId", "targetId")), ranges.orderBy(*by_id("sourceId", "startId", "endId")), counts
