"""The XML sources. Their markup is made of milestones and mixed content, which no row-based XML reader keeps in order; it is read by SAX events.

A file is no unit of work. It is read in splits, parted where records can begin (a book, an entry), and each
record is parsed by itself, behind what opens the file; so a large file is many tasks, and no more than a
record is held. Records know the lines of the file before them, for errors. Marks of a record inside a
comment or a CDATA section are not told apart: such a record is not balanced, which is an error.
"""

from __future__ import annotations

import re
import xml.sax
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.sax.handler import ContentHandler, feature_external_ges

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import RuleError
from ..functions.text import SPACE
from ..operators.quality import enforce
from ..schemas import BOOKS
from ..scratch import staged
from .lines import in_order, read_pieces, read_splits

# The closed element sets.
USFX_STRIPPED = frozenset("f fr ft fq fqa fl x xo xt ref rq id ide h toc cl cp s languageCode".split())
USFX_KEPT = frozenset("add nd w wj tl qs k wh bk".split())
USFX_STRUCTURE = frozenset("usfx book p q b c v ve d".split())
HEBREW_ELEMENTS = frozenset("w foreign list item note hi catchWord".split())
HEBREW_NOTES = frozenset("exegesis explanation translation x-typo".split())
HEBREW_LANGUAGES = frozenset("heb arc x-pn".split())
GREEK_ELEMENTS = frozenset("strongs greek pronunciation strongs_def strongs_derivation kjv_def latin see strongsref".split())

_SPACES = re.compile(SPACE)
USFX_ROWS = "kind string, book string, chapter int, verse int, verse_end int, text string, seq int"
LEXICON_ROWS = "id string, language string, lemma string, transliteration string, definition string, seq int"


def squeeze(text: str) -> str:
    return _SPACES.sub(" ", text).strip(" ")


def _events(text: str, handler: _Strict, opening: str = "", before: int = 0, last: bool = True) -> None:
    """Feeds what opens the file and a record, of which `before` lines of the file come first; after the last record the file must be closed, after others all that the record opened."""
    parser = xml.sax.make_parser()
    parser.setFeature(feature_external_ges, False)
    parser.setContentHandler(handler)
    handler.setDocumentLocator(parser)
    try:
        if opening:
            parser.feed(opening.removeprefix("﻿"))
        handler.shift, opened = before - opening.count("\n"), handler.open_elements
        parser.feed(text if opening else text.removeprefix("﻿"))
        if last:
            parser.close()
        elif handler.open_elements != opened:
            handler.fail("a record is whole", f"{handler.open_elements - opened} elements stay open")
    except xml.sax.SAXParseException as e:
        raise RuleError("the file is well-formed XML", e.getMessage(), line=e.getLineNumber() + handler.shift) from e


class _Strict(ContentHandler):
    """Errors name the line of the file; `shift` is what the parser's own count lacks to it."""

    def __init__(self):
        super().__init__()
        self.shift = self.open_elements = 0

    def fail(self, rule: str, detail: str) -> None:
        raise RuleError(rule, detail, line=self.locator.getLineNumber() + self.shift if self.locator else None)

    locator = None

    def startElement(self, name, attrs):  # noqa: N802
        self.open_elements += 1
        self.begin(name, attrs)

    def endElement(self, name):  # noqa: N802
        self.open_elements -= 1
        self.end(name)

    def setDocumentLocator(self, locator):  # noqa: N802
        self.locator = locator


class _Usfx(_Strict):
    def __init__(self):
        super().__init__()
        self.rows: list[tuple] = []
        self.book, self.chapter, self.verse = None, None, None
        self.skipping, self.stripped, self.in_title = False, 0, False
        self.text: list[str] = []
        self.title: list[str] = []
        self.titles: list[str] = []
        self.numbers: set[int] = set()
        self.books: set[str] = set()

    def emit(self, kind: str, chapter=None, verse=None, end=None, text=None) -> None:
        self.rows.append((kind, self.book, chapter, verse, end, text, len(self.rows)))

    def close_verse(self) -> None:
        if self.verse is not None:
            self.emit("verse", self.chapter, *self.verse, squeeze("".join(self.text)))
        self.verse, self.text = None, []

    def close_chapter(self) -> None:
        self.close_verse()
        if self.chapter is not None:
            self.emit("chapter", self.chapter, None, max(self.numbers, default=0), " ".join(self.titles) or None)
        self.chapter, self.titles, self.numbers = None, [], set()

    def begin(self, name, attrs):
        if name in USFX_STRIPPED:
            self.stripped += 1
            return
        if self.stripped:
            return
        if name not in USFX_KEPT and name not in USFX_STRUCTURE:
            self.fail("elements are known", name)
        if name == "book":
            code = attrs.get("id", "")
            self.skipping = code not in BOOKS
            if self.skipping:
                self.rows.append(("skipped", code, None, None, None, None, len(self.rows)))
            elif code in self.books:
                self.fail("a book stands once", code)
            self.books.add(code)
            self.book = code
        elif self.skipping:
            return
        elif name == "c":
            self.close_chapter()
            if self.book is None or not attrs.get("id", "").isdigit():
                self.fail("a chapter has a number", str(attrs.get("id")))
            self.chapter = int(attrs["id"])
        elif name == "v":
            self.close_verse()
            found = re.fullmatch(r"([0-9]+)(?:-([0-9]+))?", attrs.get("id", ""))
            if found is None or self.chapter is None:
                self.fail("a verse has a number inside a chapter", str(attrs.get("id")))
            first, last = int(found[1]), int(found[2] or found[1])
            if last < first:
                self.fail("a bridge ascends", attrs["id"])
            if "bcv" in attrs and attrs["bcv"] not in (f"{self.book}.{self.chapter}.{attrs['id']}", f"{self.book}.{self.chapter}.{first}"):
                self.fail("bcv is the running position", attrs["bcv"])
            if self.numbers & set(range(first, last + 1)):
                self.fail("a verse stands once", f"{self.book} {self.chapter}:{attrs['id']}")
            self.numbers |= set(range(first, last + 1))
            self.verse = (first, last)
        elif name == "ve":
            self.close_verse()
        elif name == "d":
            self.in_title, self.title = True, []

    def end(self, name):
        if name in USFX_STRIPPED:
            self.stripped -= 1
        elif self.stripped or self.skipping and name != "book":
            return
        elif name == "d":
            self.in_title = False
            text = squeeze("".join(self.title))
            self.titles += [text] if text else []
        elif name == "book":
            if not self.skipping:
                self.close_chapter()
            self.book, self.skipping = None, False

    def characters(self, content):
        if not self.stripped and not self.skipping:
            if self.in_title:
                self.title.append(content)
            elif self.verse is not None:
                self.text.append(content)


def parse_usfx(text: str) -> list[tuple]:
    """Rows (kind, book, chapter, verse, verse_end, text, seq): verse, chapter (verse_end: its last verse, text: its title) or skipped (a book left out)."""
    handler = _Usfx()
    _events(text, handler)
    if not any(r[0] == "verse" for r in handler.rows):
        raise RuleError("there are books", "no verses", 0)
    return handler.rows


class _Lexicon(_Strict):
    """An entry's text in document order, without suppressed subtrees."""

    def __init__(self):
        super().__init__()
        self.rows: list[tuple] = []
        self.entry: dict | None = None
        self.text: list[str] = []
        self.depth = self.muted = 0

    def open_entry(self, **entry) -> None:
        self.entry, self.text, self.depth, self.muted = entry, [], 0, 0

    def mute_here(self) -> None:
        if not self.muted:
            self.muted = self.depth

    def characters(self, content):
        if self.entry is not None and not self.muted:
            self.text.append(content)

    def close_entry(self, letter: str, language: str) -> None:
        entry, definition = self.entry, squeeze("".join(self.text))
        number = re.sub(r"\D", "", entry.get("id") or "")
        if not number or not 1 <= int(number) <= 9999:
            self.fail("an entry has a number from 1 to 9999", str(entry.get("id")))
        lemma = entry.get("lemma") or definition
        if not lemma:
            self.fail("an entry has a lemma", number)
        self.rows.append((f"{letter}{int(number):04d}", language, lemma, entry.get("translit"), definition, len(self.rows)))
        self.entry = None


class _Hebrew(_Lexicon):
    def begin(self, name, attrs):
        if self.entry is None:
            if name == "div" and attrs.get("type") == "entry":
                self.open_entry(id=None)
            return
        self.depth += 1
        if name not in HEBREW_ELEMENTS:
            self.fail("elements are known", name)
        if name == "w" and "ID" in attrs:
            if attrs.get("xml:lang") not in HEBREW_LANGUAGES:
                self.fail("languages are known", str(attrs.get("xml:lang")))
            self.entry |= {"id": attrs["ID"], "lemma": attrs.get("lemma"), "translit": attrs.get("xlit")}
            self.mute_here()
        elif name == "foreign":
            self.mute_here()
        elif name == "note":
            if attrs.get("type") not in HEBREW_NOTES:
                self.fail("note types are known", str(attrs.get("type")))
            if attrs["type"] == "x-typo":
                self.mute_here()

    def end(self, name):
        if self.entry is None:
            return
        if self.depth == 0:
            self.close_entry("H", "hebrew")
            return
        if self.muted == self.depth:
            self.muted = 0
        self.depth -= 1


class _Greek(_Lexicon):
    def begin(self, name, attrs):
        if self.entry is None:
            if name == "entry":
                self.open_entry(id=attrs.get("strongs"))
            return
        self.depth += 1
        if name not in GREEK_ELEMENTS:
            self.fail("elements are known", name)
        if name == "strongs":
            self.mute_here()
        elif name == "greek" and not self.entry.get("lemma"):
            self.entry |= {"lemma": attrs.get("unicode"), "translit": attrs.get("translit")}

    end = _Hebrew.end

    def close_entry(self, letter: str, language: str) -> None:
        super().close_entry("G", "greek")


def _lexicon_rows(handler: type[_Lexicon]) -> Callable[[str], list[tuple]]:
    def parse(text: str) -> list[tuple]:
        own = handler()
        _events(text, own)
        if not own.rows:
            raise RuleError("there are entries", "no entries", 0)
        return own.rows

    return parse


parse_hebrew_lexicon, parse_greek_lexicon = _lexicon_rows(_Hebrew), _lexicon_rows(_Greek)


def rows_of(texts: DataFrame, parse: Callable[[str], list[tuple]], schema: str) -> DataFrame:
    """Rows of whole files (column value), a file at a time."""
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["value"]:
                yield pd.DataFrame(parse(text), columns=names)

    return texts.select("value").mapInPandas(read, schema)


@dataclass(frozen=True)
class Records:
    """Where records of a kind of file can begin, which of these places are beginnings, and who reads them."""

    mark: str
    begins: str
    handler: Callable[[], _Strict]
    schema: str


USFX = Records("<book", r"^[\s>/]", _Usfx, USFX_ROWS)
HEBREW = Records("<div", r"""^\s[^>]*\btype\s*=\s*["']entry["']""", _Hebrew, LEXICON_ROWS)
GREEK = Records("<entry", r"^[\s>/]", _Greek, LEXICON_ROWS)


def read_records(spark: SparkSession, path: str, kind: Records) -> DataFrame:
    """(path, nth, before, last, opening, record) of each record of a file, nth from 1; before: the newlines of the file before it; opening: what comes before the first one."""
    pieces = read_pieces(spark, path, kind.mark)
    newlines, starts = F.length("raw") - F.length(F.replace("raw", F.lit("\n"))), F.col("raw").rlike(kind.begins).cast("int")
    splits = read_splits(pieces, len(kind.mark), newlines=newlines)
    placed = in_order(pieces, splits).withColumn("starts", F.when(F.col("nth") == 0, 0).otherwise(starts)).withColumn("newlines", newlines)
    # a split's pieces at most; what precedes the split has been summed up
    own = Window.partitionBy("path", "block").orderBy("nth")
    sums = placed.groupBy("path", "block").agg(F.sum("starts").alias("__starts"))
    earlier = F.coalesce(F.sum("__starts").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("path").alias("__path"), F.col("block").alias("__block"), earlier.alias("__earlier"))
    numbered = placed.join(sums, (F.col("path") == F.col("__path")) & (F.col("block") == F.col("__block")))
    numbered = numbered.withColumn("record", F.col("__earlier") + F.sum("starts").over(own)).withColumn("before", F.col("before_newlines") + F.sum("newlines").over(own) - F.col("newlines"))
    raw = F.when(F.col("nth") == 0, F.col("raw")).otherwise(F.concat(F.lit(kind.mark), "raw"))
    whole = numbered.groupBy("path", "record").agg(F.min("before").alias("before"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", raw.alias("x")))), lambda p: p["x"]), "").alias("text"))
    opening = whole.filter("record = 0").select(F.col("path").alias("__path"), F.col("text").alias("opening"))
    ends = whole.groupBy("path").agg(F.max("record").alias("__last")).withColumnRenamed("path", "__own")
    joined = whole.filter("record > 0").join(opening, F.col("path") == F.col("__path")).join(ends, F.col("path") == F.col("__own"))
    return joined.select("path", F.col("record").alias("nth"), "before", (F.col("record") == F.col("__last")).alias("last"), "opening", F.col("text").alias("record"))


#: Characters of records after which their rows are handed on.
FRAME = 1 << 20


def _frames(batches: Iterator[pd.DataFrame], kind: Records) -> Iterator[pd.DataFrame]:
    """Rows of records, a frame for many small ones, as a frame takes far longer to make than an entry to parse."""
    columns = [*(part.split()[0] for part in kind.schema.split(", ")), "path", "nth"]
    for batch in batches:
        made, size = [], 0
        for r in batch.itertuples():
            handler = kind.handler()
            _events(r.record, handler, r.opening, r.before, r.last)
            made += [(*row, r.path, r.nth) for row in handler.rows]
            size += len(r.record)
            if size > FRAME:
                yield pd.DataFrame(made, columns=columns)
                made, size = [], 0
        yield pd.DataFrame(made, columns=columns)


def parsed_records(records: DataFrame, kind: Records) -> DataFrame:
    """Rows of records, seq from 0 in each, with path and nth."""
    return records.mapInPandas(lambda batches: _frames(batches, kind), f"{kind.schema}, path string, nth long")


def _read(spark: SparkSession, path: str, kind: Records, rule: str, sound: str) -> tuple[DataFrame, DataFrame]:
    """(records, rows), rows written once; each file must have sound ones."""
    records = read_records(spark, path, kind)
    rows = staged(parsed_records(records, kind), "records")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("_metadata.file_path").alias("path"))
    enforce({rule: files.join(rows.filter(sound).select("path").distinct(), "path", "left_anti")})
    return records, rows


def read_usfx(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all books of a file or folder, each book parsed by itself; a book stands once in a file."""
    records, rows = _read(spark, path, USFX, "there are books", "kind = 'verse'")
    code = F.regexp_extract("record", r"""^<book\b[^>]*\bid\s*=\s*["']([^"']*)""", 1)
    books = records.select("path", code.alias("book"), (F.col("before") + 1).alias("line")).filter(F.col("book").isin(*BOOKS))
    enforce({"a book stands once": books.groupBy("path", "book").agg(F.count(F.lit(1)).alias("n"), F.max("line").alias("line")).filter("n > 1")})
    seq = F.row_number().over(Window.partitionBy("path").orderBy("nth", "seq")) - 1
    return rows.withColumn("seq", seq).drop("path", "nth")


def raw_verses(usfx: DataFrame, translation: str, tradition: str) -> DataFrame:
    """Verses with text, once each (a bridge is one row), stamped."""
    verses = usfx.filter("kind = 'verse' AND text <> ''")
    return verses.select("book", "chapter", "verse", "verse_end", "text", F.lit(translation).alias("translation"), F.lit(tradition).alias("tradition"))


def read_lexicon(spark: SparkSession, hebrew: str, greek: str) -> DataFrame:
    """Entries of both lexicons, each parsed by itself; Aramaic ones are Hebrew."""
    parts = [_read(spark, path, kind, "there are entries", "true")[1] for path, kind in ((hebrew, HEBREW), (greek, GREEK))]
    return parts[0].unionByName(parts[1]).drop("seq", "path", "nth")
