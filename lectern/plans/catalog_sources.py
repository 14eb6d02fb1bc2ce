"""Registered queries over whole files and tables: readers, builders, sinks and loading, on files made of the driver's tables.

Each calls the library's own function; the SQL says what must come out.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import RuleError
from ..functions import ids, ordering, tags, text
from ..operators import builders, quality, retrieval, versification
from ..schemas import BOOKS, BUILT, RULE_BOOKS, key_order
from ..scratch import fresh_path, staged
from ..sinks import jsonl, tables
from ..sources import jsonl as json_source
from ..sources import hashes, lines, provenance, tabular, xml
from .catalog import _BOOKS, _CODES, _DISTANCE, Read, _vector, long, query


def _one_file(df: DataFrame, column: str) -> str:
    """A text file of one row."""
    path = fresh_path(df.sparkSession, "files")
    df.select(column).coalesce(1).write.text(path)
    return path


def _text(c: Column) -> Column:
    return c.cast("string")


def _rows(t: Read, rows: list[tuple], schema: str) -> DataFrame:
    return t("region").sparkSession.createDataFrame(rows, schema)


# --- the stand-in corpus: a verse per part ---------------------------------------------------------

def _k() -> Column:
    return F.col("p_partkey")


def _of(names: tuple[str, ...], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (at + 1).cast("int"))


def _parts(t: Read) -> DataFrame:
    ordinal, chapter = F.floor(_k() / 500) % 66, (F.floor(_k() / 10) % 50 + 1).cast("int")
    verse = (_k() % 10 + 1 + F.floor(_k() / 33000) * 10).cast("int")
    return t("part").select(_k(), "p_name", _of(BOOKS, ordinal).alias("book"), _of(RULE_BOOKS, ordinal).alias("code"), chapter.alias("c"), verse.alias("v")).withColumn("id", ids.make_id(F.col("book"), F.col("c"), F.col("v")))


_PARTS = f"""parts AS (SELECT *, book || '_' || c || '_' || v AS id, o * 1000000 + c * 1000 + v AS rk FROM (SELECT p_partkey AS k, p_name AS name, {_BOOKS}[(p_partkey // 500) % 66 + 1] AS book, {_CODES}[(p_partkey // 500) % 66 + 1] AS code,
  (p_partkey // 500) % 66 AS o, ((p_partkey // 10) % 50 + 1)::INTEGER AS c, (p_partkey % 10 + 1 + p_partkey // 33000 * 10)::INTEGER AS v FROM part))"""


def _edition(t: Read) -> DataFrame:
    """Every 11th verse is empty, chapters of even number have titles."""
    rows = _parts(t)
    verses = rows.select(F.lit("verse").alias("kind"), "book", F.col("c").alias("chapter"), F.col("v").alias("verse"), F.col("v").alias("verse_end"), F.when(_k() % 11 == 0, "").otherwise(F.col("p_name")).alias("text"))
    chapters = verses.groupBy("book", "chapter").agg(F.max("verse").alias("verse_end")).select(F.lit("chapter").alias("kind"), "book", "chapter", F.lit(None).cast("int").alias("verse"), "verse_end", F.when(F.col("chapter") % 2 == 0, "A title").alias("text"))
    return verses.unionByName(chapters)


_EDITION = f"""{_PARTS}, verses AS (SELECT *, CASE WHEN k % 11 = 0 THEN '' ELSE name END AS text FROM parts), chapters AS (SELECT book, o, c, max(v) AS last FROM parts GROUP BY ALL),
  inventory AS (SELECT id, book, c, v, rk FROM parts UNION ALL SELECT book || '_' || c || '_0', book, c, 0, o * 1000000 + c * 1000 FROM chapters WHERE c % 2 = 0)"""


@query("canonical_verses_build", f"WITH {_EDITION} SELECT id, book, c AS chapter, v AS verse, 'protestant' AS \"canonStatus\", NULL::VARCHAR AS \"theologicalCategory\" FROM inventory")
def canonical_verses_build(t: Read) -> DataFrame:
    return builders.canonical_verses(_edition(t))


@query("edition_features", f"""WITH {_EDITION} SELECT book, c AS chapter, v AS verse, CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END AS word_count, v = last AS is_last, text <> '' AS has_text FROM verses JOIN chapters USING (book, c)
  UNION ALL SELECT book, c, 0, CASE WHEN c % 2 = 0 THEN 2 ELSE 0 END, false, c % 2 = 0 FROM chapters""")
def edition_features(t: Read) -> DataFrame:
    return versification.features(_edition(t)).withColumn("word_count", long(F.col("word_count")))


@query("chapter_lasts", f"WITH {_EDITION} SELECT book, c AS chapter, last AS last_verse FROM chapters")
def chapter_lasts(t: Read) -> DataFrame:
    return versification.last_verses(_edition(t))


# --- versification rules ---------------------------------------------------------------------------


def _rule_lines(rows: DataFrame, number: Column, kind: Column, source: Column, standard: Column, action: Column, tests: Column | None = None) -> DataFrame:
    """A rule table's lines under its marks and header, among comments and separators."""
    cells = F.concat_ws("\t", kind, source, standard, action, *[F.lit("")] * 4, F.lit("") if tests is None else tests)
    body = rows.select(number.cast("int").alias("line_no"), cells.alias("line"))
    frame = [(1, "notes"), (2, "#DataStart(Expanded)"), (3, "SourceType\tSourceRef\tStandardRef"), (4, "# comment"), (5, "'Gen"), (2**31 - 2, "#DataEnd(Expanded)"), (2**31 - 1, "Any\tGen.1:??")]
    return body.unionByName(rows.sparkSession.createDataFrame(frame, "line_no int, line string"))


def _shown(items: Column) -> Column:
    point = lambda p: F.concat_ws(":", p["book"], F.coalesce(_text(p["chapter"]), p["chapter_letter"]), F.when(p["is_title"], "T").otherwise(_text(p["verse"])), F.coalesce(p["subverse"], F.lit("-")))
    return F.array_join(F.transform(items, lambda i: F.concat(i["kind"], F.lit(" "), point(i["start"]), F.when(i["kind"] == "range", F.concat(F.lit("~"), point(i["end"]))).otherwise(""))), ";")


def _ref(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else _text(p) for p in parts])


@query("rules_scan", f"""WITH {_PARTS} SELECT (k + 10)::INTEGER AS line_no, CASE WHEN k % 6 = 3 THEN 'book left out' ELSE 'kept' END AS status,
  CASE k % 6 WHEN 0 THEN 'single ' || code || ':' || c || ':' || v || ':-' WHEN 1 THEN 'single ' || code || ':' || c || ':' || v || ':-;single ' || code || ':' || c || ':' || (v + 3) || ':-'
    WHEN 2 THEN 'range ' || code || ':' || c || ':' || v || ':-~' || code || ':' || (c + 1) || ':2:-;single ' || code || ':' || c || ':' || (v + 1) || ':-'
    WHEN 4 THEN 'single ' || code || ':' || c || ':' || v || ':a' WHEN 5 THEN 'range ' || code || ':' || c || ':' || v || ':a~' || code || ':' || c || ':' || v || ':c2' END AS source,
  CASE k % 6 WHEN 0 THEN 'range ' || code || ':' || c || ':' || v || ':-~' || code || ':' || c || ':' || (v + 2) || ':-' WHEN 1 THEN 'single ' || code || ':' || c || ':' || v || ':-;single ' || code || ':' || (c + 1) || ':1:-;single ' || code || ':' || (c + 1) || ':2:-'
    WHEN 2 THEN 'single ' || code || ':' || c || ':' || v || ':-' WHEN 4 THEN 'single ' || code || ':' || c || ':T:-' WHEN 5 THEN 'single ' || code || ':' || c || ':' || v || ':2' END AS standard,
  CASE WHEN k % 6 = 3 THEN NULL WHEN k % 2 = 0 THEN 'Keep verse' ELSE 'Renumber verse' END AS action, CASE WHEN k % 6 <> 3 THEN k % 6 = 5 END AS starred FROM parts""")
def rules_scan(t: Read) -> DataFrame:
    """A rule table: singles, lists that inherit, ranges within and across chapters, parts, titles, and books left out."""
    m = _k() % 6
    here = _ref(F.col("code"), ".", F.col("c"), ":")
    v = F.col("v")
    source = (
        F.when(m == 0, _ref(here, v)).when(m == 1, _ref(here, v, ",", v + 3)).when(m == 2, _ref(here, v, "-", F.col("c") + 1, ":2,", v + 1))
        .when(m == 3, _ref("Tob.", F.col("c"), ":", v)).when(m == 4, _ref(here, v, "!a")).otherwise(_ref(here, v, "a-c2"))
    )
    standard = (
        F.when(m == 0, _ref(here, v, "-", v + 2)).when(m == 1, _ref(here, v, "; ", F.col("c") + 1, ":1, 2,")).when(m == 2, _ref(here, v)).when(m == 3, _ref("Tob.1:1"))
        .when(m == 4, _ref(here, "Title")).otherwise(_ref(here, v, ".2"))
    )
    action = F.concat(F.when(_k() % 2 == 0, "Keep verse").otherwise("Renumber verse"), F.when(m == 5, "*").otherwise(""))
    rules, skipped = tabular.read_rules(_rule_lines(_parts(t), _k() + 10, F.lit("Hebrew"), source, standard, action))
    kept = rules.select("line_no", F.lit("kept").alias("status"), _shown(F.col("source")).alias("source"), _shown(F.col("standard")).alias("standard"), "action", "starred")
    return kept.unionByName(skipped.select("line_no", F.col("reason").alias("status")), allowMissingColumns=True)


@query("rule_targets", f"""WITH {_EDITION}, r AS (SELECT k, book, c, v, last FROM parts JOIN chapters USING (book, c))
  SELECT (k + 10)::INTEGER AS line_no, book, c AS chapter, unnest(range(v, last + 1))::INTEGER AS verse FROM r UNION ALL SELECT (k + 10)::INTEGER, book, c + 1, unnest([1, 2]) FROM r""")
def rule_targets(t: Read) -> DataFrame:
    """Ranges into the next chapter, written out by the last verse of the first."""
    here = _ref(F.col("code"), ".", F.col("c"), ":")
    rules, _ = tabular.read_rules(_rule_lines(_parts(t), _k() + 10, F.lit("Hebrew"), _ref(here, F.col("v")), _ref(here, F.col("v"), "-", F.col("c") + 1, ":2"), F.lit("Renumber verse")))
    return versification.standard_targets(rules, versification.last_verses(_edition(t))).select("line_no", "book", "chapter", "verse")


@query("map_two_traditions", f"WITH {_EDITION} SELECT id, book || '_' || c || '_' || CASE WHEN k % 5 = 0 THEN v + 2 ELSE v + 1 END AS targets FROM verses")
def map_two_traditions(t: Read) -> DataFrame:
    """Each verse has rules of two traditions, which agree or not: then those with the wanted label decide. Every fifth has one of another tradition alone."""
    here, v = _ref(F.col("code"), ".", F.col("c"), ":"), F.col("v")
    rows = _parts(t).withColumn("own", F.explode(F.when(_k() % 5 == 0, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1), F.lit(2)))))
    # lines of one tradition add up: the whole verse, and a part of it that it covers
    kind = F.when(F.col("own") == 0, "Latin").otherwise("Eng+Hebrew")
    target = F.when(F.col("own") == 2, _ref(here, v + 1, "!a")).when(F.col("own") == 1, _ref(here, v + 1)).otherwise(_ref(here, v + F.when(_k() % 5 == 0, 2).when(_k() % 2 == 0, 1).otherwise(0)))
    edition = _edition(t)
    rules, _ = tabular.read_rules(_rule_lines(rows, _k() * 3 + 10 + F.col("own"), kind, _ref(here, v), target, F.lit("Renumber verse")))
    verses = edition.filter("kind = 'verse'").select("book", "chapter", "verse")
    mapped = versification.map_verses(verses, rules, versification.features(edition), versification.last_verses(edition), "Hebrew")
    shown = F.array_join(F.transform("targets", lambda x: F.concat_ws("_", x["book"], _text(x["chapter"]), _text(x["verse"]))), ";")
    return mapped.select(ids.make_id(F.col("book"), F.col("chapter"), F.col("verse")).alias("id"), shown.alias("targets"))


def _verse_texts(t: Read, ceiling: float = 1.0) -> tuple[DataFrame, dict]:
    """Every seventh verse goes to a chapter outside the inventory, which has 50 a book at every size, and of two of seven a copy too."""
    m, here, v = _k() % 7, _ref(F.col("code"), ".", F.col("c"), ":"), F.col("v")
    edition = _edition(t)
    made = _parts(t).filter(m.isin(0, 2))
    rules, _ = tabular.read_rules(_rule_lines(made, _k() + 10, F.lit("Hebrew"), _ref(here, v), F.when(m == 0, _ref(F.col("code"), ".150:1")).otherwise(_ref(here, v, "; 150:1")), F.lit("Renumber verse")))
    inventory = builders.canonical_verses(edition)
    return builders.verse_texts(edition, "one", "Hebrew", rules, versification.features(edition), versification.last_verses(edition), inventory, ceiling)


@query("verse_texts_build", f"""WITH {_EDITION} SELECT id AS "canonicalId", 'one' AS translation, text, 'public' AS levels FROM verses WHERE text <> '' AND k % 7 <> 0 UNION ALL SELECT book || '_' || c || '_0', 'one', 'A title', 'public' FROM chapters WHERE c % 2 = 0""")
def verse_texts_build(t: Read) -> DataFrame:
    return _verse_texts(t)[0].select("canonicalId", "translation", "text", F.array_join("authorizedLevels", ",").alias("levels"))


@query("verse_texts_counts", f"""WITH {_EDITION}, n AS (SELECT count(*) FILTER (text <> '') AS bodies, count(*) FILTER (text <> '' AND k % 7 = 2) AS twice, count(*) FILTER (text <> '' AND k % 7 = 0) AS away, (SELECT count(*) FROM chapters WHERE c % 2 = 0) AS titles FROM verses)
  SELECT bodies + twice + titles AS attempted, away + twice AS dropped FROM n""")
def verse_texts_counts(t: Read) -> DataFrame:
    counts = _verse_texts(t)[1]
    return t("region").sparkSession.createDataFrame([(counts["attempted"], counts["dropped"])], "attempted long, dropped long")


# --- tagged words, cross references, lexicons ------------------------------------------------------


@query("greek_words_scan", """WITH w AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'MAT_3_4' ELSE 'MAT_' || (l_orderkey % 28 + 1) || '_' || l_linenumber END AS id, l_partkey, l_suppkey, lpad((l_partkey % 5000 + 1)::VARCHAR, 4, '0') AS n FROM lineitem)
  SELECT id AS "canonicalId", row_number() OVER (PARTITION BY id ORDER BY l_partkey * 1000000 + l_suppkey)::INTEGER AS position, 'logos' AS lexeme, CASE WHEN l_suppkey % 10 <> 0 THEN 'G' || n END AS "strongId",
    CASE WHEN l_suppkey % 10 = 0 THEN 'G2' || n ELSE 'G' || n || 'A' END AS "strongRaw", 'N-NSM=x' AS morphology, CASE WHEN l_suppkey % 3 = 0 THEN 'N(k)O' ELSE 'NKO' END AS edition FROM w""")
def greek_words_scan(t: Read) -> DataFrame:
    """Every second line is numbered otherwise in one edition, every tenth tag is an extended number."""
    n = F.lpad(_text(F.col("l_partkey") % 5000 + 1), 4, "0")
    cell = _ref("Mat.", F.col("l_orderkey") % 28 + 1, ".", F.col("l_linenumber"), F.when(F.col("l_linenumber") % 2 == 0, "(9.9)[3.4]{1.1}").otherwise(""), "#01=", F.when(F.col("l_suppkey") % 3 == 0, "N(k)O").otherwise("NKO"))
    tag = F.when(F.col("l_suppkey") % 10 == 0, F.concat(F.lit("G2"), n, F.lit("=N-NSM=x"))).otherwise(F.concat(F.lit("G"), n, F.lit("A=N-NSM=x")))
    rows = t("lineitem").select((F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("line_no"), F.concat_ws("\t", cell, F.lit(" logos "), F.lit("gloss"), tag, F.lit("more")).alias("line"))
    return tabular.read_greek_words(rows)[0]


def _word_lines(t: Read, greek: bool) -> DataFrame:
    """Headers and notes among word lines; every seventh book is left out, every fifth lexeme of the Hebrew is empty."""
    k = F.col("o_orderkey")
    cell = _ref(F.when(k % 7 == 0, "Tob").otherwise("Mat" if greek else "Gen"), ".", k % 28 + 1, ".", F.col("o_custkey") % 30 + 1, "#01=", "NKO" if greek else "Q(x)")
    words = F.concat_ws("\t", cell, F.lit("word"), F.lit("gloss"), F.lit("G0001=N")) if greek else F.concat_ws("\t", cell, F.when(k % 5 == 0, " ").otherwise("word"), F.lit(""), F.lit(""), F.lit("H9003/{H0001A}"), *[F.lit("")] * 12)
    return t("orders").select(k.alias("line_no"), F.when(k % 11 == 0, "# a note\twith cells").otherwise(words).alias("line"))


@query("word_counts", """WITH w AS (SELECT * FROM orders WHERE o_orderkey % 11 <> 0), n AS (SELECT count(*) AS word_lines, count(*) FILTER (o_orderkey % 7 = 0) AS skipped_books, count(*) FILTER (o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0) AS skipped_empty FROM w)
  SELECT 'hebrew' AS language, word_lines, skipped_books, skipped_empty, word_lines - skipped_books - skipped_empty AS produced FROM n UNION ALL SELECT 'greek', word_lines, skipped_books, 0, word_lines - skipped_books FROM n""")
def word_counts(t: Read) -> DataFrame:
    hebrew, greek = tabular.read_hebrew_words(_word_lines(t, False))[1], tabular.read_greek_words(_word_lines(t, True))[1]
    rows = [(name, c["word_lines"], c["skipped_books"], c.get("skipped_empty", 0), c["produced"]) for name, c in (("hebrew", hebrew), ("greek", greek))]
    return t("region").sparkSession.createDataFrame(rows, "language string, word_lines long, skipped_books long, skipped_empty long, produced long")


def _xrefs(t: Read, ceiling: float = 1.0) -> tuple[DataFrame, DataFrame, dict]:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    to = (
        F.when(k % 5 == 0, _ref("Exod.", k % 40 + 1, ".", c % 20 + 1)).when(k % 5 == 1, _ref("Exod.3.1-Exod.3.", c % 4 + 1)).when(k % 5 == 2, _ref("Exod.3.5-Exod.4.", c % 20 + 1))
        .when(k % 5 == 3, F.lit("Tob.1.1")).otherwise(_ref("1John.2.", c % 20 + 1))
    )
    body = t("orders").select((k + 2).alias("line_no"), F.concat_ws("\t", _ref("Gen.", k % 50 + 1, ".", c % 30 + 1), to, F.when(k % 5 == 4, "-3").otherwise("12")).alias("line"))
    head = body.sparkSession.createDataFrame([(1, "From Verse\tTo Verse\tVotes\t#x"), (2**40, " ")], "line_no long, line string")
    return tabular.read_xrefs(body.unionByName(head), ceiling)


_XREFS = """x AS (SELECT o_orderkey % 5 AS m, 'GEN_' || (o_orderkey % 50 + 1) || '_' || (o_custkey % 30 + 1) AS s, o_orderkey AS k, o_custkey AS c FROM orders),
  direct AS (SELECT s, 'EXO_' || (k % 40 + 1) || '_' || (c % 20 + 1) AS t FROM x WHERE m = 0 UNION SELECT s, 'EXO_3_' || unnest(range(1, c % 4 + 2)) FROM x WHERE m = 1 UNION SELECT s, '1JN_2_' || (c % 20 + 1) FROM x WHERE m = 4),
  ranges AS (SELECT DISTINCT s, 'EXO_3_5' AS a, 'EXO_4_' || (c % 20 + 1) AS b FROM x WHERE m = 2)"""


@query("xref_edges", f"WITH {_XREFS} SELECT s AS \"sourceId\", t AS \"targetId\" FROM direct")
def xref_edges(t: Read) -> DataFrame:
    return _xrefs(t)[0]


@query("xref_ranges", f"WITH {_XREFS} SELECT s AS \"sourceId\", a AS \"startId\", b AS \"endId\" FROM ranges")
def xref_ranges(t: Read) -> DataFrame:
    return _xrefs(t)[1]


@query("xref_counts", f"""WITH {_XREFS} SELECT count(*) AS lines, count(*) FILTER (m = 3) AS discarded, count(*) FILTER (m = 4) AS negative_votes, count(*) FILTER (m = 1) AS inner_ranges, count(*) FILTER (m = 2) AS outer_ranges,
  coalesce(sum(c % 4 + 1) FILTER (m = 1), 0)::BIGINT AS expanded, (SELECT count(*) FROM direct) AS edges, (SELECT count(*) FROM ranges) AS ranges FROM x""")
def xref_counts(t: Read) -> DataFrame:
    names = ("lines", "discarded", "negative_votes", "inner_ranges", "outer_ranges", "expanded", "edges", "ranges")
    counts = _xrefs(t)[2]
    return t("region").sparkSession.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))


@query("lexicon_scan", """SELECT 'H' || lpad((p_partkey % 9999 + 1)::VARCHAR, 4, '0') AS id, 'hebrew' AS language, p_name AS lemma, 'x' || p_partkey AS transliteration, 'to ' || p_name || ' end' AS definition FROM part
  UNION ALL SELECT 'G' || lpad((p_partkey % 9999 + 1)::VARCHAR, 4, '0'), 'greek', CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'def ' || p_name END, CASE WHEN p_partkey % 2 = 0 THEN 't' || p_partkey END, 'def ' || p_name FROM part""")
def lexicon_scan(t: Read) -> DataFrame:
    """Both lexicons as files of an entry a line; every second Greek entry has no headword of its own."""
    n, name = _text(_k() % 9999 + 1), F.col("p_name")
    hebrew = F.concat(F.lit('<div type="entry"><w ID="H'), n, F.lit('" lemma="'), name, F.lit('" xlit="x'), _text(_k()), F.lit('" xml:lang="arc"/>to  <foreign>gone</foreign><list><item>'), name, F.lit('</item></list><note type="x-typo">no <hi>more</hi></note> end</div>'))
    head = F.when(_k() % 2 == 0, F.concat(F.lit('<greek unicode="'), name, F.lit('" translit="t'), _text(_k()), F.lit('"/>'))).otherwise("")
    greek = F.concat(F.lit('<entry strongs="'), n, F.lit('"><strongs>5</strongs> '), head, F.lit(' def <see language="GREEK"/><strongs_def>'), name, F.lit("</strongs_def></entry>"))
    paths = []
    for tag, entry in (("osis", hebrew), ("lexicon", greek)):
        body = t("part").select(_k().alias("at"), entry.alias("x")).unionByName(_rows(t, [(-1, f"<{tag}>"), (2**62, f"</{tag}>")], "at long, x string"))
        paths.append(fresh_path(body.sparkSession, "files"))
        body.orderBy("at").select("x").coalesce(1).write.text(paths[-1])
    return xml.read_lexicon(t("part").sparkSession, *paths)


@query("usfx_bridges", f"""WITH v AS (SELECT {_BOOKS}[n_regionkey + 1] AS book, n_nationkey AS k, n_name AS name FROM nation)
  SELECT 'verse' AS kind, book, k * 2 + 1 AS verse, k * 2 + 2 AS verse_end, name || ' of it' AS text FROM v UNION ALL SELECT 'skipped', 'FRT', NULL, NULL, NULL FROM region""")
def usfx_bridges(t: Read) -> DataFrame:
    """Bridges of two verses, and front matter that is left out, in a file per region."""
    k = F.col("n_nationkey")
    verse = F.concat(F.lit('<v id="'), _text(k * 2 + 1), F.lit("-"), _text(k * 2 + 2), F.lit('"/>'), F.col("n_name"), F.lit("\n  <f>a <q>note</q></f><w>of</w>\tit <ve/><v id=\""), _text(k * 2 + 100), F.lit('"/><ve/>'))
    bodies = t("nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(F.struct("n_nationkey", verse.alias("x"))))["x"], "").alias("body"))
    files = bodies.select(F.concat(F.lit('<usfx><book id="FRT"><p>front</p></book><book id="'), _of(BOOKS, F.col("n_regionkey")), F.lit('"><c id="1"/>'), "body", F.lit("</book></usfx>")).alias("value"))
    rows = xml.rows_of(files, xml.parse_usfx, xml.USFX_ROWS).cache()
    verses = xml.raw_verses(rows, "one", "Hebrew").select(F.lit("verse").alias("kind"), "book", "verse", "verse_end", "text")
    return verses.unionByName(rows.filter("kind = 'skipped'").select("kind", "book", "verse", "verse_end", "text"))


# --- words, edges and their tables -----------------------------------------------------------------


def _words(t: Read) -> tuple[DataFrame, DataFrame]:
    """(words, lexicon): Hebrew words of line items, and Greek ones of suppliers, half of them of numbers without an entry."""
    s = F.col("l_suppkey")
    hebrew = t("lineitem").select(_ref("GEN_", s % 50 + 1, "_", F.col("l_linenumber")).alias("canonicalId"), "l_orderkey", *["l_partkey", "l_suppkey", "l_extendedprice"], F.lit("w").alias("lexeme"), _ref("H", F.lpad(_text(s + 1), 4, "0")).alias("strongId"), _ref("H", F.lpad(_text(s + 1), 4, "0"), "A").alias("strongRaw"), F.lit(None).cast("string").alias("morphology"), F.lit("L").alias("edition"))
    hebrew = ordering.dense_position(hebrew, "canonicalId", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    k = F.col("s_suppkey")
    tag = F.when(k % 2 == 0, F.lit("G6000")).otherwise("G0001")
    greek = t("supplier").select(F.lit("MAT_1_1").alias("canonicalId"), (k + 1).cast("int").alias("position"), F.lit("w").alias("lexeme"), tag.alias("strongId"), tag.alias("strongRaw"), F.lit("N").alias("morphology"), F.lit("NKO").alias("edition"))
    n = _text(k + 1)
    entries = t("supplier").select(_ref("H", F.lpad(n, F.greatest(F.lit(4), F.length(n)), "0")).alias("id"), F.lit("hebrew").alias("language"), F.col("s_name").alias("lemma"), F.lit(None).cast("string").alias("transliteration"), F.lit("d").alias("definition"))
    lexicon = entries.unionByName(entries.sparkSession.createDataFrame([("G0001", "greek", "l", None, "d")], entries.schema))
    return builders.original_words(hebrew.select(*key_order("original_words")), greek, lexicon), lexicon


_WORDS = """words AS (SELECT 'GEN_' || (l_suppkey % 50 + 1) || '_' || l_linenumber AS id, row_number() OVER (PARTITION BY l_suppkey % 50, l_linenumber ORDER BY l_orderkey, l_partkey, l_suppkey, l_extendedprice)::INTEGER AS position, 'H' || lpad((l_suppkey + 1)::VARCHAR, 4, '0') AS strong, 'H' || lpad((l_suppkey + 1)::VARCHAR, 4, '0') || 'A' AS raw, 'L' AS edition FROM lineitem
  UNION ALL SELECT 'MAT_1_1', (s_suppkey + 1)::INTEGER, CASE WHEN s_suppkey % 2 = 1 THEN 'G0001' END, CASE WHEN s_suppkey % 2 = 0 THEN 'G6000' ELSE 'G0001' END, 'NKO' FROM supplier)"""


@query("original_words_build", f"WITH {_WORDS} SELECT id AS \"canonicalId\", position, strong AS \"strongId\", raw AS \"strongRaw\", edition FROM words")
def original_words_build(t: Read) -> DataFrame:
    return _words(t)[0].select("canonicalId", "position", "strongId", "strongRaw", "edition")


@query("referenced_entries", f"WITH {_WORDS} SELECT DISTINCT strong AS \"strongId\" FROM words WHERE strong IS NOT NULL")
def referenced_entries(t: Read) -> DataFrame:
    return builders.referenced_ids(_words(t)[0])


def _graph(t: Read, ceiling: float = 1.0) -> tuple[DataFrame, dict, DataFrame]:
    """Direct pairs of line items, and a range from each part over the 23 next; titles are in the inventory and outside parts are not."""
    inventory = staged(builders.canonical_verses(_edition(t)), "inventory")
    rows = staged(_parts(t).select("p_partkey", "id"), "parts")
    ends = rows.select((_k() - 23).alias("p_partkey"), F.col("id").alias("endId"))
    ranges = rows.select("p_partkey", F.col("id").alias("sourceId"), F.col("id").alias("startId")).join(ends, "p_partkey").filter(ids.id_key(F.col("startId")) <= ids.id_key(F.col("endId")))
    pairs = t("lineitem").select((F.col("l_partkey") % 400).alias("p_partkey"), F.when(F.col("l_linenumber") == 1, F.col("l_partkey") % 400).otherwise(F.col("l_suppkey") * 97 % 4000).alias("to")).distinct()
    away = rows.select(_k().alias("to"), F.col("id").alias("targetId"))
    direct = pairs.join(rows.withColumnRenamed("id", "sourceId"), "p_partkey").join(away, "to", "left").select("sourceId", F.coalesce("targetId", _ref("REV_99_", F.col("to") % 900)).alias("targetId"))
    made, counts = builders.edges(direct, ranges.select("sourceId", "startId", "endId"), inventory, ceiling)
    return made, counts, inventory


_GRAPH = f"""{_EDITION}, pairs AS (SELECT DISTINCT l_partkey % 400 AS s, CASE WHEN l_linenumber = 1 THEN l_partkey % 400 ELSE l_suppkey * 97 % 4000 END AS t FROM lineitem),
  direct AS (SELECT a.id AS s, coalesce(b.id, 'REV_99_' || t % 900) AS t FROM pairs JOIN parts a ON a.k = s LEFT JOIN parts b ON b.k = t),
  spans AS (SELECT a.id AS s, a.rk AS low, b.rk AS high FROM parts a JOIN parts b ON b.k = a.k + 23 WHERE a.rk <= b.rk),
  written AS (SELECT s, i.id AS t, i.v FROM spans JOIN inventory i ON i.rk BETWEEN low AND high),
  candidates AS (SELECT s, t FROM direct UNION SELECT s, t FROM written WHERE v > 0),
  marked AS (SELECT s, t, CASE WHEN t NOT IN (SELECT id FROM inventory) THEN 'outside' WHEN s = t THEN 'loop' ELSE 'kept' END AS class FROM candidates)"""


@query("edges_build", f"WITH {_GRAPH} SELECT s AS \"sourceId\", t AS \"targetId\", 'tsk' AS kind FROM marked WHERE class = 'kept'")
def edges_build(t: Read) -> DataFrame:
    return _graph(t)[0]


@query("edges_counts", f"""WITH {_GRAPH} SELECT count(*) AS candidates, count(*) FILTER (class = 'outside') AS discarded, count(*) FILTER (class = 'loop') AS self_loops, count(*) FILTER (class = 'kept') AS final,
  (SELECT count(*) FROM written WHERE v > 0) AS expanded, (SELECT count(*) FROM written WHERE v = 0) AS skipped_titles, (SELECT count(*) FROM spans) AS ranges FROM marked""")
def edges_counts(t: Read) -> DataFrame:
    names = ("candidates", "discarded", "self_loops", "final", "expanded", "skipped_titles", "ranges")
    counts = _graph(t)[1]
    return t("region").sparkSession.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))


@query("table_orders", f"""WITH {_PARTS}, s AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'greek' ELSE 'hebrew' END AS language, 'X' || lpad(p_partkey::VARCHAR, 6, '0') AS id FROM part)
  SELECT 'canonical_verses' AS name, id AS key, row_number() OVER (ORDER BY rk, id) AS place FROM parts
  UNION ALL SELECT 'verse_texts', id || x, row_number() OVER (ORDER BY rk, id, x) FROM parts, (VALUES ('b'), ('a')) u(x)
  UNION ALL SELECT 'original_words', id || x, row_number() OVER (ORDER BY rk, id, x) FROM parts, (VALUES (10), (9)) u(x)
  UNION ALL SELECT 'strongs', id, row_number() OVER (ORDER BY CASE language WHEN 'hebrew' THEN 0 ELSE 1 END, id) FROM s
  UNION ALL SELECT 'edges', a.id || x, row_number() OVER (ORDER BY a.rk, b.rk, a.id, b.id, CASE x WHEN 'tsk' THEN 0 WHEN 'thematic' THEN 1 ELSE 2 END) FROM parts a JOIN parts b ON b.k = a.k // 2, (VALUES ('manual'), ('thematic'), ('tsk')) u(x)""")
def table_orders(t: Read) -> DataFrame:
    """The total order of each table."""
    parts = staged(_parts(t).select("p_partkey", "id"), "parts")
    other = lambda column, *values: F.explode(F.array(*map(F.lit, values))).alias(column)
    target = parts.select(_k().alias("half"), F.col("id").alias("targetId"))
    made = {
        "canonical_verses": (parts, F.col("id")),
        "verse_texts": (parts.select(F.col("id").alias("canonicalId"), other("translation", "b", "a")), F.concat("canonicalId", "translation")),
        "original_words": (parts.select(F.col("id").alias("canonicalId"), other("position", 10, 9)), F.concat("canonicalId", _text(F.col("position")))),
        "strongs": (parts.select(_ref("X", F.lpad(_text(_k()), 6, "0")).alias("id"), F.when(_k() % 2 == 0, "greek").otherwise("hebrew").alias("language")), F.col("id")),
        "edges": (parts.withColumn("half", F.floor(_k() / 2)).join(target, "half").select(F.col("id").alias("sourceId"), "targetId", other("kind", "manual", "thematic", "tsk")), F.concat("sourceId", "kind")),
    }
    placed = [ordering.global_position(df, *ordering.order_columns(name), out="place").select(F.lit(name).alias("name"), key.alias("key"), long(F.col("place")).alias("place")) for name, (df, key) in made.items()]
    out = placed[0]
    for df in placed[1:]:
        out = out.unionByName(df)
    return out


# --- files of JSON Lines, manifests, loading -------------------------------------------------------


def _texts(t: Read) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = _parts(t).withColumn("translation", F.explode(F.array(F.lit("one"), F.lit("two"))))
    return rows.select(
        F.col("id").alias("canonicalId"), "translation", F.concat(F.col("p_name"), F.lit(' "é" \\ '), "translation").alias("text"), none.alias("embeddingModel"), F.array(F.lit("b"), F.lit("a"), F.lit("b")).alias("thematicTags"),
        none.alias("culturalContext"), (_k() % 2 == 0).alias("humanReviewed"), none.alias("reviewedBy"), F.array(F.lit("public")).alias("authorizedLevels"),
    )


def _inventory(t: Read) -> DataFrame:
    return _parts(t).select("id", "book", F.col("c").alias("chapter"), F.col("v").alias("verse"), F.lit("protestant").alias("canonStatus"), F.lit(None).cast("string").alias("theologicalCategory"))


@query("table_roundtrip", f"WITH {_PARTS} SELECT id, book, c AS chapter, v AS verse, 'protestant' AS \"canonStatus\", NULL::VARCHAR AS \"theologicalCategory\" FROM parts")
def table_roundtrip(t: Read) -> DataFrame:
    """A table written as lines, checked, and read back with its schema, checked again."""
    df = _inventory(t)
    path = fresh_path(df.sparkSession, "files")
    jsonl.write_table(df, path, "canonical_verses")
    return json_source.read_table(df.sparkSession, path, "canonical_verses")


@query("by_book_roundtrip", f"""WITH {_PARTS} SELECT id AS "canonicalId", translation, name || ' "é" \\ ' || translation AS text, 'a,b' AS tags, k % 2 = 0 AS "humanReviewed" FROM parts, (VALUES ('one'), ('two')) u(translation)""")
def by_book_roundtrip(t: Read) -> DataFrame:
    """A table written by book, and read back from all of them in its order."""
    df = _texts(t)
    path = fresh_path(df.sparkSession, "files")
    jsonl.write_by_book(df.withColumns({c: text.set_array(F.col(c)) for c in ("thematicTags", "authorizedLevels")}), f"{path}/verse_texts", "verse_texts")
    return json_source.read_verse_texts_ordered(df.sparkSession, path).select("canonicalId", "translation", "text", F.array_join("thematicTags", ",").alias("tags"), "humanReviewed")


@query("books_written", f"WITH {_PARTS}, b AS (SELECT DISTINCT book, o FROM parts) SELECT book, row_number() OVER (ORDER BY o) AS place FROM b")
def books_written(t: Read) -> DataFrame:
    df = _texts(t).withColumn("thematicTags", text.set_array(F.col("thematicTags")))
    books = jsonl.write_by_book(df, fresh_path(df.sparkSession, "files"), "verse_texts", check=False)
    return df.sparkSession.createDataFrame([(b, i) for i, b in enumerate(books, 1)], "book string, place long")


@query("table_digest", f"""WITH {_PARTS} SELECT sha256(string_agg('{{"id":"' || id || '","book":"' || book || '","chapter":' || c || ',"verse":' || v || ',"canonStatus":"protestant","theologicalCategory":null}}' || chr(10), '' ORDER BY rk)) AS sha256 FROM parts""")
def table_digest(t: Read) -> DataFrame:
    """The hash of a table's file, whatever order its rows come in."""
    df = _inventory(t).orderBy(F.xxhash64("id"))
    return df.sparkSession.createDataFrame([(jsonl.digest(df, "canonical_verses"),)], "sha256 string")


def _tables(t: Read) -> dict[str, DataFrame]:
    """All five, whole and consistent."""
    made, _, inventory = _graph(t)
    words, lexicon = _words(t)
    more = words.select(F.col("canonicalId").alias("id")).distinct().join(inventory.select("id"), "id", "left_anti")
    ref = ids.parse_id(F.col("id"))
    inventory = inventory.unionByName(more.select("id", ref["book"].alias("book"), ref["chapter"].alias("chapter"), ref["verse"].alias("verse"), F.lit("protestant").alias("canonStatus"), F.lit(None).cast("string").alias("theologicalCategory")))
    return {"canonical_verses": inventory, "strongs": lexicon, "verse_texts": _texts(t), "original_words": words, "edges": made}


_COUNTS = f"""{_GRAPH}, {_WORDS}, counts AS (SELECT 'canonical_verses' AS name, (SELECT count(*) FROM (SELECT id FROM inventory UNION SELECT id FROM words)) AS n UNION ALL SELECT 'strongs', (SELECT count(*) + 1 FROM supplier)
  UNION ALL SELECT 'verse_texts', (SELECT 2 * count(*) FROM parts) UNION ALL SELECT 'original_words', (SELECT count(*) FROM words) UNION ALL SELECT 'edges', (SELECT count(*) FROM marked WHERE class = 'kept'))"""


@query("build_manifest", f"""WITH {_COUNTS} SELECT name, n FROM counts UNION ALL SELECT 'verse_texts one', (SELECT count(*) FROM parts) UNION ALL SELECT 'verse_texts two', (SELECT count(*) FROM parts)
  UNION ALL SELECT 'strongs hebrew', (SELECT count(*) FROM supplier) UNION ALL SELECT 'strongs greek', 1 UNION ALL SELECT 'provenance', 1""")
def build_manifest(t: Read) -> DataFrame:
    made = jsonl.manifest(_tables(t), [("source", {"a.txt": "0" * 64})])
    jsonl.manifest_text(made)  # its keys are checked here
    rows = [*made["counts"].items(), *[(f"verse_texts {k}", v) for k, v in made["verseTextsByTranslation"].items()], *[(f"strongs {k}", v) for k, v in made["strongsByLanguage"].items()], ("provenance", len(made["provenance"]))]
    return t("region").sparkSession.createDataFrame(rows, "name string, n long")


@query("load_counts", f"WITH {_COUNTS} SELECT name, n, n AS again FROM counts UNION ALL SELECT 'column added', 1, 0")
def load_counts(t: Read) -> DataFrame:
    """A load, a migration, and a reload, which gives the same."""
    spark = t("region").sparkSession
    database = f"load_{uuid.uuid4().hex}"
    made = {name: staged(df, name) for name, df in _tables(t).items()}  # made once, loaded twice
    try:
        first = tables.load(spark, database, made)
        added = [tables.add_column(spark, f"{database}.strongs", "note", "string") for _ in range(2)]
        again = tables.load(spark, database, made)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    rows = [(name, first[name], again[name]) for name in BUILT]
    return spark.createDataFrame([*rows, ("column added", int(added[0]), int(added[1]))], "name string, n long, again long")


def _embedded(t: Read) -> tuple[DataFrame, DataFrame]:
    docs = t("documents").select(_text(F.col("doc_id")).alias("canonicalId"), F.col("lang").alias("translation"), "text", F.lit("own").alias("embeddingModel"), "doc_id")
    vectors = docs.select("canonicalId", "translation", F.array(F.col("doc_id").cast("double"), F.lit(1.0)).alias("embedding"), F.lit("m@1").alias("embeddingModel"))
    return docs.drop("doc_id"), vectors


@query("texts_with_embeddings", "SELECT doc_id::VARCHAR AS \"canonicalId\", lang AS translation, 'm@1' AS model, doc_id::DOUBLE AS first_dimension, true AS has, false AS has_without, 'own' AS model_without FROM documents")
def texts_with_embeddings(t: Read) -> DataFrame:
    """Texts with a complete set of embeddings, and without any."""
    texts, vectors = _embedded(t)
    joined = tables.with_embeddings(texts, vectors, "m@1").select("canonicalId", "translation", F.col("embeddingModel").alias("model"), F.get("embedding", F.lit(0)).alias("first_dimension"), F.col("embedding").isNotNull().alias("has"))
    without = tables.with_embeddings(texts, None).select("canonicalId", "translation", F.col("embedding").isNotNull().alias("has_without"), F.col("embeddingModel").alias("model_without"))
    return joined.join(without, ["canonicalId", "translation"])


def _problem(call) -> tuple[str, int]:
    try:
        call()
    except RuleError as e:
        return e.rule, e.count
    return "none", 0


@query("embedding_guards", """SELECT 'unique' AS fault, 'embeddings are unique' AS rule, count(*) AS n FROM documents WHERE doc_id < 5 UNION ALL SELECT 'stamp', 'embeddings are of the pinned build', count(*) FROM documents
  UNION ALL SELECT 'orphan', 'no embedding is an orphan', 2 UNION ALL SELECT 'missing', 'no embedding is missing', count(*) FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT 'whole', 'none', 0""")
def embedding_guards(t: Read) -> DataFrame:
    """What each kind of a broken set of embeddings is refused for, and how many rows."""
    texts, vectors = _embedded(t)
    n = F.col("canonicalId").cast("long")
    sets = {
        "unique": (vectors.unionByName(vectors.filter(n < 5)), "m@1"), "stamp": (vectors, "m@2"), "missing": (vectors.filter(n % 10 != 0), "m@1"), "whole": (vectors, "m@1"),
        "orphan": (vectors.unionByName(vectors.sparkSession.createDataFrame([(x, "en", [1.0], "m@1") for x in ("a", "b")], vectors.schema)), "m@1"),
    }
    rows = [(fault, *_problem(lambda v=v, s=s: tables.with_embeddings(texts, v, s))) for fault, (v, s) in sets.items()]
    return texts.sparkSession.createDataFrame(rows, "fault string, rule string, n long")


@query("source_proof", "SELECT 'src_' || r_regionkey AS source, ['whole', 'missing', 'another hash', 'quarantined', 'not in the manifest'][r_regionkey % 5 + 1] AS problem FROM region")
def source_proof(t: Read) -> DataFrame:
    """Pinned files that are whole, missing, changed, quarantined or not listed, all reported together."""
    spark = t("region").sparkSession
    folder = fresh_path(spark, "files")
    files = t("region").select(F.concat(F.lit("src_"), _text(F.col("r_regionkey"))).alias("source"), F.col("r_name").alias("value"))
    files.select("source", "value").coalesce(1).write.partitionBy("source").text(folder)
    hashed = hashes.file_hashes(spark, f"{folder}/*/*.txt").withColumn("source", F.regexp_extract("path", "source=([^/]+)", 1)).withColumn("name", F.regexp_extract("path", "(source=[^/]+/[^/]+)$", 1)).collect()
    found = {r["source"]: (r["name"], r["sha256"]) for r in hashed}
    sources = {}
    for i, (source, (name, sha256)) in enumerate(sorted(found.items())):
        kind = i % 5
        if kind < 4:
            sources[source] = {"file": f"{name}x" if kind == 1 else name, "sha256": "0" * 64 if kind == 2 else sha256, **({"status": "quarantined"} if kind == 3 else {})}
    manifest = _one_file(spark.createDataFrame([(json.dumps({"sources": sources}),)], "value string"), "value")
    try:
        provenance.verify_sources(spark, folder, provenance.read_manifest(spark, manifest), sorted(found))
        said = ""
    except RuleError as e:
        said = str(e)
    kinds = ("missing", "another hash", "quarantined", "not in the manifest")
    rows = [(s, next((k for k in kinds if any(p.strip().startswith(f"{s}:") and k in p for p in said.replace("pins: ", "pins; ").split(";"))), "whole")) for s in sorted(found)]
    return spark.createDataFrame(rows, "source string, problem string")


@query("file_lines", "SELECT n_nationkey + 1 AS line_no, n_name AS line FROM nation UNION ALL SELECT count(*) + 1, '' FROM nation")
def file_lines(t: Read) -> DataFrame:
    """A file's lines with their numbers, carriage returns and the byte-order mark gone."""
    body = t("nation").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda r: F.concat(r["n_name"], F.lit("\r\n"))), "").alias("x"))
    return lines.numbered_lines(body.select(F.concat(F.lit("﻿"), "x").alias("value"))).select(long(F.col("line_no")).alias("line_no"), "line")


# --- rules of rows, mappings, codes ----------------------------------------------------------------


@query("canonical_violations", f"""WITH {_PARTS} SELECT 'id is an id' AS rule, count(*) FILTER (k % 7 = 0) AS count FROM parts UNION ALL SELECT 'book is known', count(*) FILTER (k % 5 = 0) FROM parts
  UNION ALL SELECT 'canonStatus is known', count(*) FILTER (k % 9 = 0) FROM parts UNION ALL SELECT 'chapter > 0', count(*) FILTER (k % 8 = 0) FROM parts""")
def canonical_violations(t: Read) -> DataFrame:
    """A table with broken rows against its own rules."""
    rows = _parts(t).select(
        F.when(_k() % 7 == 0, F.lit("XXX_1_1")).otherwise(F.col("id")).alias("id"), F.when(_k() % 5 == 0, "TOB").otherwise(F.col("book")).alias("book"), F.when(_k() % 8 == 0, 0).otherwise(F.col("c")).alias("chapter"), F.col("v").alias("verse"),
        F.when(_k() % 9 == 0, "other").otherwise("protestant").alias("canonStatus"), F.lit(None).cast("string").alias("theologicalCategory"),
    )
    return quality.violations(rows, quality.row_rules("canonical_verses")).select("rule", "count")


@query("cross_check", """SELECT 'edges' AS child, 'sourceId' AS "column", ref FROM (SELECT DISTINCT 'GEN_1_' || l_linenumber AS ref FROM lineitem) WHERE ref NOT IN (SELECT 'GEN_1_' || n_nationkey FROM nation WHERE n_nationkey < 4)
  UNION ALL SELECT 'edges', 'targetId', ref FROM (SELECT DISTINCT 'GEN_1_' || (l_linenumber + 1) AS ref FROM lineitem) WHERE ref NOT IN (SELECT 'GEN_1_' || n_nationkey FROM nation WHERE n_nationkey < 4)""")
def cross_check(t: Read) -> DataFrame:
    """References of both ends of edges that no verse has."""
    verses = t("nation").filter("n_nationkey < 4").select(_ref("GEN_1_", F.col("n_nationkey")).alias("id"))
    made = t("lineitem").select(_ref("GEN_1_", F.col("l_linenumber")).alias("sourceId"), _ref("GEN_1_", F.col("l_linenumber") + 1).alias("targetId"))
    return quality.cross_check({"canonical_verses": verses, "edges": made})


_SIDE = "SELECT o_custkey AS k, list_sort(list(DISTINCT 'GEN_' || (o_custkey % 3 + CASE WHEN o_orderkey % 50 = {m} THEN 2 ELSE 1 END) || '_' || (o_orderkey // 2 % 4 + 1))) AS x FROM orders WHERE o_orderkey % 2 = {m} GROUP BY 1"


@query("mapping_kinds", f"""WITH a AS ({_SIDE.format(m=0)}), b AS ({_SIDE.format(m=1)}), j AS (SELECT coalesce(a.k, b.k) AS k, a.x AS a, b.x AS b FROM a FULL JOIN b ON a.k = b.k WHERE a.x IS DISTINCT FROM b.x),
  u AS (SELECT *, list_distinct(list_concat(a, b)) AS ab FROM j), g AS (SELECT k, coalesce(len(list_distinct(list_transform(ab, lambda i: regexp_replace(i, '_[0-9]+$', '')))) = 1 AND list_has_any(a, b)
    AND list_max(list_transform(ab, lambda i: split_part(i, '_', 3)::INTEGER)) - list_min(list_transform(ab, lambda i: split_part(i, '_', 3)::INTEGER)) + 1 = len(ab), false) AND a IS NOT NULL AND b IS NOT NULL AS near FROM u)
  SELECT k, CASE WHEN near THEN 'granularity' ELSE 'conflict' END AS kind FROM g WHERE near OR k % 10 <> 0""")
def mapping_kinds(t: Read) -> DataFrame:
    """Two mappings compared as sets, by kind of difference, without the accepted conflicts."""

    def side(m: int) -> DataFrame:
        at = _ref("GEN_", F.col("o_custkey") % 3 + F.when(F.col("o_orderkey") % 50 == m, 2).otherwise(1), "_", F.floor(F.col("o_orderkey") / 2) % 4 + 1)
        return t("orders").filter(F.col("o_orderkey") % 2 == m).groupBy(F.col("o_custkey").alias("k")).agg(F.collect_set(at).alias("ids"))

    accepted = t("customer").filter("c_custkey % 10 = 0").select(F.col("c_custkey").alias("k"), F.lit("conflict").alias("kind"))
    both = t("orders").filter("o_custkey % 10 = 0").select(F.col("o_custkey").alias("k"), F.lit("conflict").alias("kind")).union(accepted).distinct()
    return versification.compare_mappings(side(0), side(1), "k", both).select("k", "kind")


@query("code_predicates", """SELECT n_nationkey AS k, n_nationkey % 4 < 2 AS rule_book, n_nationkey % 4 = 0 AS xref_book, ['GEN', 'EXO', NULL, NULL][n_nationkey % 4 + 1] AS translated, ['Gen', 'Exo', NULL, NULL][n_nationkey % 4 + 1] AS back,
  CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE n_nationkey END AS mapped_verse, CASE WHEN n_nationkey % 5 > 0 THEN 'H0' || (100 + n_nationkey) END AS root, min(n_nationkey) OVER (PARTITION BY n_regionkey) AS region_first FROM nation""")
def code_predicates(t: Read) -> DataFrame:
    """Book codes, a rule's reference as a target, a tag's root, and a group's first place."""
    k = F.col("n_nationkey")
    code = _of(("Gen", "Exo", "Tob", "Zzz"), k % 4)
    found = ids.rule_book(code)["book"]
    mapped = ids.mapped_ref(F.lit("GEN"), F.lit(1), F.lit(None).cast("string"), k, k % 3 == 0, F.lit(None).cast("string"))
    tag = F.when(k % 5 == 0, F.lit("H0001/H0002")).otherwise(F.concat(F.lit("H9001/{H0"), _text(100 + k), F.lit("B}")))
    rows = t("nation").select(k.alias("k"), ids.is_rule_book(code).alias("rule_book"), ids.is_xref_book(code).alias("xref_book"), found.alias("translated"), ids.rule_code(found).alias("back"), mapped["verse"].alias("mapped_verse"), tags.normalize(tag, F.lit("H")).alias("root"), "n_regionkey")
    return ordering.first_appearance(rows, "n_regionkey", "k", "region_first").drop("n_regionkey")


# --- retrieval over the tables ---------------------------------------------------------------------


class _Fixed:
    """An embedder that gives one vector."""

    def __init__(self, vector: list[float]):
        self.vector = vector

    def health(self) -> dict:
        return {"model": "fixed", "revision": "1"}

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [self.vector for _ in texts]


@query("theme_search", f"""SELECT 'GEN_1_' || vec_id AS "canonicalId", 'tr' || label % 2 AS translation, round(d, 6) AS distance FROM (SELECT vec_id, label, {_DISTANCE} AS d FROM embeddings WHERE vec_id % 3 <> 0 AND label IN (1, 2, 3, 4) AND label % 2 = 1 AND vec_id % 7 > 0) ORDER BY d, "canonicalId" LIMIT 8""")
def theme_search(t: Read) -> DataFrame:
    """Levels, canon status, translation and missing vectors are filtered before ranking."""
    rows = t("embeddings").select(_ref("GEN_1_", F.col("vec_id")).alias("canonicalId"), _ref("tr", F.col("label") % 2).alias("translation"), F.lit("t").alias("text"), F.array(_text(F.col("label"))).alias("authorizedLevels"), F.when(F.col("vec_id") % 7 > 0, F.col("embedding")).alias("embedding"), F.lit("fixed@1").alias("embeddingModel"), "vec_id")
    verses = rows.select(F.col("canonicalId").alias("id"), F.when(F.col("vec_id") % 3 == 0, "deuterocanonical").otherwise("protestant").alias("canonStatus")).distinct()
    found = retrieval.search_by_theme(rows.drop("vec_id"), verses, _Fixed(_vector(t)), "hope", ["1", "2", "3", "4"], "tr1", 8)
    return found.select("canonicalId", "translation", F.round("distance", 6).alias("distance"))


def _lookup(t: Read, find) -> DataFrame:
    """GEN_1_1 to GEN_1_5 as regions; nations are texts, suppliers words, of which some have entries."""
    verses = t("region").select(_ref("GEN_1_", F.col("r_regionkey") + 1).alias("id"), F.lit("protestant").alias("canonStatus"))
    texts = t("nation").select(_ref("GEN_1_", F.col("n_regionkey") + 1).alias("canonicalId"), F.col("n_name").alias("translation"), F.col("n_name").alias("text"), F.array(F.when(F.col("n_nationkey") % 2 == 0, "public").otherwise("curated")).alias("authorizedLevels"))
    none = F.lit(None).cast("string")
    words = t("supplier").select(_ref("GEN_1_", F.col("s_suppkey") % 5 + 1).alias("canonicalId"), F.col("s_suppkey").alias("position"), F.col("s_name").alias("lexeme"), _ref("H000", F.col("s_suppkey") % 7).alias("strongId"), none.alias("strongRaw"), none.alias("morphology"), none.alias("edition"))
    entries = t("nation").filter("n_nationkey < 4").select(_ref("H000", F.col("n_nationkey")).alias("id"), F.col("n_name").alias("lemma"), none.alias("transliteration"), F.lit("d").alias("definition"))
    views = t("region").select(_ref("GEN_1_", F.col("r_regionkey") + 1).alias("canonicalId"), F.col("r_name").alias("viewLabel"), F.lit("t").alias("text"), none.alias("tradition"), none.alias("source"))
    return find(verses, texts, words, entries, views)


_TEXTS = "(SELECT string_agg(n_name, ',' ORDER BY n_name) FROM nation WHERE n_regionkey = 1 AND n_nationkey % 2 = 0) AS texts, (SELECT string_agg(r_name, ',') FROM region WHERE r_regionkey = 1) AS views"


@query("verse_lookup", f"SELECT 'GEN_1_2' AS id, {_TEXTS}, (SELECT string_agg(s_name, ',' ORDER BY s_suppkey) FROM supplier WHERE s_suppkey % 5 = 1) AS words")
def verse_lookup(t: Read) -> DataFrame:
    found = _lookup(t, lambda verses, texts, words, entries, views: retrieval.get_verse("GEN_1_2", ["public"], verses, texts, words, views))
    return found.select("id", F.array_join("texts.translation", ",").alias("texts"), F.array_join("interpretations.viewLabel", ",").alias("views"), F.array_join("originalWords.lexeme", ",").alias("words"))


@query("verse_exegesis", f"""SELECT 'GEN_1_2' AS id, {_TEXTS}, (SELECT string_agg(s_name || ':' || coalesce(n_name, '-'), ',' ORDER BY s_suppkey) FROM supplier LEFT JOIN nation ON n_nationkey = s_suppkey % 7 AND n_nationkey < 4 WHERE s_suppkey % 5 = 1) AS words""")
def verse_exegesis(t: Read) -> DataFrame:
    """Words with their entries beside them; words without one stay."""
    found = _lookup(t, lambda verses, texts, words, entries, views: retrieval.exegesis("GEN_1_2", ["public"], verses, texts, words, entries, views))
    words = F.transform("originalWords", lambda w: F.concat(w["lexeme"], F.lit(":"), F.coalesce(w["lemma"], F.lit("-"))))
    return found.select("id", F.array_join("texts.translation", ",").alias("texts"), F.array_join("interpretations.viewLabel", ",").alias("views"), F.array_join(words, ",").alias("words"))


from . import catalog_guards  # noqa: E402, F401  (registers its queries)
