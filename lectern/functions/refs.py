"""References in the sources, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import HEBREW_TEXT_TYPES
from .ids import make_id, rule_book, xref_book

# The formats of the sources' references.
_HEBREW = r"^([0-9A-Za-z]{3})\.([0-9]+)\.([0-9]+)(?:\(([0-9]+)\.([0-9]+)\))?#([0-9]+)=(.+)$"
_GREEK = r"^([0-9A-Za-z]{3})\.([0-9]+)\.([0-9]+)((?:[\[({][^\])}]*[\])}])*)#([0-9]+)=(.+)$"
_XREF = r"^([0-9A-Za-z]+)\.([0-9]+)\.([0-9]+)$"


def _let(value: Column, use) -> Column:
    """use(value), with the value worked out once a row however often it is used."""
    return F.transform(F.array(value), use)[0]


#: Stands between the groups of a match; no source holds it.
_CUT = "\u0001"


def _groups(text: Column, pattern: str, count: int) -> Column:
    """All groups by one match, as an array; of another size where the pattern doesn't match."""
    return F.split(F.regexp_replace(text, pattern, _CUT.join(f"${i}" for i in range(1, count + 1))), _CUT, -1)


#: How a cell begins that has nothing but a book, a chapter and a verse.
_PLAIN = r"^[0-9A-Za-z]{3}\.[0-9]{1,6}\.[0-9]{1,6}"


def _plain(cell: Column) -> tuple[Column, Column, Column]:
    """Book, chapter and verse of a cell that begins like that."""
    place = F.substring_index(cell, "#", 1)
    return F.substring_index(place, ".", 1), F.substring_index(F.substring_index(place, ".", 2), ".", -1).try_cast("int"), F.substring_index(place, ".", -1).try_cast("int")


def _position(cell: Column) -> Column:
    return F.substring_index(F.substring_index(cell, "=", 1), "#", -1).try_cast("int")


def text_type(field: Column) -> Column:
    """struct(raw, base, marker, error): a base of the closed list and an optional (marker)."""
    base = F.substring_index(field, "(", 1)
    bare = F.length(base) == F.length(field)
    known = F.coalesce(base.isin(*HEBREW_TEXT_TYPES) & (bare | field.endswith(")")), F.lit(False))
    marker = F.when(known & ~bare, F.nullif(F.substring(field, F.length(base) + 2, F.length(field) - F.length(base) - 2), F.lit("")))
    return F.struct(field.alias("raw"), F.when(known, base).alias("base"), marker.alias("marker"), F.when(~known, "text type").alias("error"))


def hebrew_ref(cell: Column) -> Column:
    """struct(book, status, chapter, verse, other_chapter, other_verse, position, type, error)."""

    def made(parts: Column) -> Column:
        matched = F.coalesce(F.size(parts) == 7, F.lit(False))
        part = lambda i: F.when(matched, F.nullif(F.get(parts, F.lit(i)), F.lit("")))
        number = lambda i: part(i).try_cast("int")
        read = F.struct(matched.alias("ok"), rule_book(part(0)).alias("book"), number(1).alias("chapter"), number(2).alias("verse"), text_type(part(6)).alias("type"))

        def checked(r: Column) -> Column:
            error = F.when(~r["ok"], "form").when(r["book"]["status"] == "unknown", "book").when(r["chapter"].isNull() | r["verse"].isNull(), "number").otherwise(r["type"]["error"])
            return F.struct(
                r["book"]["book"].alias("book"), r["book"]["status"].alias("status"), r["chapter"].alias("chapter"), r["verse"].alias("verse"),
                number(3).alias("other_chapter"), number(4).alias("other_verse"), number(5).alias("position"), r["type"].alias("type"), error.alias("error"),
            )

        return _let(read, checked)

    # a plain cell, as most are, comes apart at its marks
    book, chapter, verse = _plain(cell)
    read, field = rule_book(book), F.substring_index(cell, "=", -1)
    known = field.isin(*HEBREW_TEXT_TYPES)
    none, wrong = F.lit(None), F.when(~known, "text type")
    kind = F.struct(field.alias("raw"), F.when(known, field).alias("base"), none.cast("string").alias("marker"), wrong.alias("error"))
    plain = F.struct(
        read["book"].alias("book"), read["status"].alias("status"), chapter.alias("chapter"), verse.alias("verse"), none.cast("int").alias("other_chapter"), none.cast("int").alias("other_verse"),
        _position(cell).alias("position"), kind.alias("type"), F.when(read["status"] == "unknown", "book").otherwise(wrong).alias("error"),
    )
    return F.when(F.coalesce(cell.rlike(_PLAIN + r"#[0-9]{1,6}=[A-Z]+$"), F.lit(False)), plain).otherwise(_let(_groups(cell, _HEBREW, 7), made))


#: A word's place in other editions, by its marks.
_OTHERS = {"kjv": r"\[([0-9]+)\.([0-9]+)\]", "na": r"\(([0-9]+)\.([0-9]+)\)", "alt": r"\{([0-9]+)\.([0-9]+)\}"}
#: Such places and nothing else, at least one or any number of them, and two of a kind.
_SOME_OTHERS = rf"(?:{'|'.join(_OTHERS.values())})++"
_ALL_OTHERS, _REPEAT = rf"^(?:{_SOME_OTHERS})?\z", r"\[.*\[|\(.*\(|\{.*\{"


def _other_places(text: Column) -> list[Column]:
    """Chapter and verse of the first place of each kind. What has no such mark isn't searched: a failing cast of an empty string costs more than all the rest."""
    return [F.when(F.contains(text, F.lit(pattern[1])), F.regexp_extract(text, pattern, at)).try_cast("int").alias(f"{name}_{part}") for name, pattern in _OTHERS.items() for at, part in ((1, "chapter"), (2, "verse"))]


def greek_ref(cell: Column) -> Column:
    """struct(book, status, chapter, verse, kjv_*, na_*, alt_*, position, type, error): [kjv], (na) and {other} in any order, each once."""

    def made(parts: Column) -> Column:
        matched = F.coalesce(F.size(parts) == 6, F.lit(False))
        part = lambda i: F.when(matched, F.nullif(F.get(parts, F.lit(i)), F.lit("")))
        number_at = lambda i: part(i).try_cast("int")
        read = F.struct(matched.alias("ok"), rule_book(part(0)).alias("book"), number_at(1).alias("chapter"), number_at(2).alias("verse"), F.coalesce(part(3), F.lit("")).alias("others"))

        def checked(r: Column) -> Column:
            some = r["others"] != ""  # most cells have none, and nothing is searched then
            error = (
                F.when(~r["ok"], "form").when(some & ~r["others"].rlike(_ALL_OTHERS), "leftover").when(some & r["others"].rlike(_REPEAT), "repeat")
                .when(r["book"]["status"] == "unknown", "book").when(r["chapter"].isNull() | r["verse"].isNull(), "number")
            )
            return F.struct(r["book"]["book"].alias("book"), r["book"]["status"].alias("status"), r["chapter"].alias("chapter"), r["verse"].alias("verse"), *_other_places(r["others"]), number_at(4).alias("position"), part(5).alias("type"), error.alias("error"))

        return _let(read, checked)

    none = F.lit(None)
    sound = lambda others: F.coalesce(cell.rlike(_PLAIN + others + r"#[0-9]{1,6}=[A-Za-z()]+$"), F.lit(False))

    def simple(verse: Column, wrong: Column, others: list[Column]) -> Column:
        """Of a cell that comes apart at its marks."""
        book, chapter, _ = _plain(cell)
        read = rule_book(book)
        error = F.coalesce(wrong, F.when(read["status"] == "unknown", "book"))
        return F.struct(read["book"].alias("book"), read["status"].alias("status"), chapter.alias("chapter"), verse.alias("verse"), *others, _position(cell).alias("position"), F.substring_index(cell, "=", -1).alias("type"), error.alias("error"))

    plain = simple(_plain(cell)[2], none.cast("string"), [none.cast("int").alias(f"{name}_{part}") for name in _OTHERS for part in ("chapter", "verse")])
    place = F.substring_index(cell, "#", 1)
    placed = simple(F.regexp_extract(cell, _PLAIN.replace("[0-9]{1,6}", "([0-9]{1,6})"), 2).try_cast("int"), F.when(place.rlike(_REPEAT), "repeat"), _other_places(place))
    return F.when(sound(""), plain).when(sound(_SOME_OTHERS), placed).otherwise(_let(_groups(cell, _GREEK, 6), made))


def canonical_ref(ref: Column, greek: bool) -> Column:
    """The id that a word belongs to: the primary numbering, or for Greek the [kjv] one where given; null for excluded books."""
    chapter = F.coalesce(ref["kjv_chapter"], ref["chapter"]) if greek else ref["chapter"]
    verse = F.coalesce(ref["kjv_verse"], ref["verse"]) if greek else ref["verse"]
    return make_id(ref["book"], chapter, verse)


def xref(token: Column) -> Column:
    """struct(book, status, chapter, verse, error); a chapter or verse of zero is an error."""

    def made(parts: Column) -> Column:
        matched = F.coalesce(F.size(parts) == 3, F.lit(False))
        part = lambda i: F.when(matched, F.get(parts, F.lit(i)))
        read = F.struct(matched.alias("ok"), xref_book(part(0)).alias("book"), part(1).try_cast("int").alias("chapter"), part(2).try_cast("int").alias("verse"))

        def checked(r: Column) -> Column:
            error = F.when(~r["ok"], "form").when(r["book"]["status"] == "unknown", "book").when(r["chapter"].isNull() | r["verse"].isNull(), "number").when((r["chapter"] == 0) | (r["verse"] == 0), "zero")
            return F.struct(r["book"]["book"].alias("book"), r["book"]["status"].alias("status"), r["chapter"].alias("chapter"), r["verse"].alias("verse"), error.alias("error"))

        return _let(read, checked)

    book, chapter, verse = _plain(token)
    read = xref_book(book)
    plain = F.struct(read["book"].alias("book"), read["status"].alias("status"), chapter.alias("chapter"), verse.alias("verse"), F.when(read["status"] == "unknown", "book").when((chapter == 0) | (verse == 0), "zero").alias("error"))
    sound = F.coalesce(token.rlike(r"^[0-9A-Za-z]{2,8}\.[0-9]{1,6}\.[0-9]{1,6}$"), F.lit(False))
    return F.when(sound, plain).when(token.isNotNull(), _let(_groups(token, _XREF, 3), made)).otherwise(_no_ref())


def _no_ref() -> Column:
    none = F.lit(None)
    return F.struct(none.cast("string").alias("book"), F.lit("unknown").alias("status"), none.cast("int").alias("chapter"), none.cast("int").alias("verse"), F.lit("form").alias("error"))
