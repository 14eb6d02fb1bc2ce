"""Canonical identifiers BOOK_CHAPTER_VERSE and book codes, as columns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BOOKS, RULE_BOOKS, RULE_EXCLUDED, XREF_BOOKS, XREF_EXCLUDED

ID = r"^([A-Z0-9]{3})_([0-9]{1,3})_([0-9]{1,3})$"


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def place_of(code: Column, codes: tuple[str, ...]) -> Column:
    """The place of a code among others of three characters, from 0; null for one that isn't there. One search of a string, where a map would compare entry by entry."""
    at = F.instr(F.lit("".join(f",{c}" for c in codes)), F.concat(F.lit(","), code))
    return F.when((at > 0) & (F.length(code) == 3) & ~F.contains(code, F.lit(",")), F.floor((at - 1) / 4).cast("int"))


def make_id(book: Column, chapter: Column, verse: Column) -> Column:
    """The id; null where a part is out of range or the book unknown."""
    known = book.isin(*BOOKS) & chapter.between(0, 999) & verse.between(0, 999)
    return F.when(known, F.concat_ws("_", book, chapter.cast("string"), verse.cast("string")))


def valid_id(value: Column) -> Column:
    """The form alone would let unknown books through; null is not valid."""
    return F.coalesce(value.rlike(ID) & F.substring(value, 1, 3).isin(*BOOKS), F.lit(False))


def parse_id(value: Column) -> Column:
    """struct(book, chapter, verse); null where the id is not valid."""
    part = lambda i: F.regexp_extract(value, ID, i)
    return F.when(valid_id(value), F.struct(part(1).alias("book"), part(2).try_cast("int").alias("chapter"), part(3).try_cast("int").alias("verse")))


def book_ordinal(book: Column) -> Column:
    """The book's place in canonical order, from 0; null for an unknown code."""
    return place_of(book, BOOKS)


def ref_key(book: Column, chapter: Column, verse: Column) -> Column:
    """One long that sorts as book, chapter, verse do."""
    return book_ordinal(book).cast("long") * 1_000_000 + chapter.cast("long") * 1_000 + verse.cast("long")


def id_key(value: Column) -> Column:
    """ref_key of an id, null where it is not valid. It reads the id as few times as it can: filters on it are pushed below joins, where the id's own expression stands in each place."""
    at = F.instr(F.lit("".join(f",{b}" for b in BOOKS)), F.concat(F.lit(","), F.substring(value, 1, 3)))
    chapter = F.substring_index(F.substring_index(value, "_", 2), "_", -1).try_cast("long")
    verse = F.substring_index(value, "_", -1).try_cast("long")
    return F.when(value.rlike(ID) & (at > 0), F.floor((at - 1) / 4) * 1_000_000 + chapter * 1_000 + verse)


def _translated(code: Column, known: tuple[str, ...], excluded: tuple[str, ...]) -> Column:
    """struct(book, status): known, excluded (book null) or unknown."""
    at = F.find_in_set(code, F.lit(",".join(known)))  # from 1; 0 for one that isn't there
    status = F.when(at > 0, "known").when(code.isin(*excluded), "excluded").otherwise("unknown")
    return F.struct(F.get(F.array(*[F.lit(b) for b in BOOKS]), at - 1).alias("book"), status.alias("status"))


def rule_book(code: Column) -> Column:
    return _translated(code, RULE_BOOKS, RULE_EXCLUDED)


def xref_book(code: Column) -> Column:
    return _translated(code, XREF_BOOKS, XREF_EXCLUDED)


def rule_code(book: Column) -> Column:
    """The inverse of rule_book."""
    return F.element_at(literal_map(dict(zip(BOOKS, RULE_BOOKS, strict=True))), book)


def is_rule_book(code: Column) -> Column:
    return code.isin(*RULE_BOOKS)


def is_xref_book(code: Column) -> Column:
    return code.isin(*XREF_BOOKS)


def lexicon_id(letter: Column, digits: Column) -> Column:
    """Letter and number padded to four digits; null unless the digits are a number from 1 to 9999."""
    n = F.when(digits.rlike("^[0-9]+$"), digits.try_cast("int"))
    return F.when((n >= 1) & (n <= 9999), F.concat(letter, F.lpad(n.cast("string"), 4, "0")))


def mapped_ref(book: Column, chapter: Column, chapter_letter: Column, verse: Column, is_title: Column, subverse: Column) -> Column:
    """A rule's reference as a target: a title is verse 0; null for a lettered chapter."""
    return F.when(chapter_letter.isNull(), F.struct(book.alias("book"), chapter.alias("chapter"), F.when(is_title, 0).otherwise(verse).alias("verse"), subverse.alias("subverse")))
