"""Table schemas, closed vocabularies and keys. Field order is the order of serialised keys."""

from __future__ import annotations

from pyspark.sql import types as T

# The closed vocabularies of the data model.
OLD_BOOKS = tuple("GEN EXO LEV NUM DEU JOS JDG RUT 1SA 2SA 1KI 2KI 1CH 2CH EZR NEH EST JOB PSA PRO ECC SNG ISA JER LAM EZK DAN HOS JOL AMO OBA JON MIC NAM HAB ZEP HAG ZEC MAL".split())
NEW_BOOKS = tuple("MAT MRK LUK JHN ACT ROM 1CO 2CO GAL EPH PHP COL 1TH 2TH 1TI 2TI TIT PHM HEB JAS 1PE 2PE 1JN 2JN 3JN JUD REV".split())
BOOKS = OLD_BOOKS + NEW_BOOKS
CANON_STATUS = ("protestant", "deuterocanonical")
ACCESS_LEVELS = ("public", "curated")
LANGUAGES = ("hebrew", "greek")
EDGE_KINDS = ("tsk", "thematic", "manual")
REPORT_STATUS = ("open", "triaged", "resolved", "rejected")
RULE_ACTIONS = ("Keep verse", "Renumber verse", "Renumber title", "Concatenation", "DividedPrev verse", "DividedNext verse", "MergedPrev verse", "MergedNext verse", "IfEmpty verse", "Psalm title", "CopiedFrom verse", "MovedFrom verse")
HEBREW_TEXT_TYPES = ("L", "LA", "LB", "LH", "LAH", "LAB", "LBH", "Q", "X", "R")

# Book codes of the sources, in the order of BOOKS, and the codes that are known and left out.
RULE_BOOKS = tuple("Gen Exo Lev Num Deu Jos Jdg Rut 1Sa 2Sa 1Ki 2Ki 1Ch 2Ch Ezr Neh Est Job Psa Pro Ecc Sng Isa Jer Lam Ezk Dan Hos Jol Amo Oba Jon Mic Nam Hab Zep Hag Zec Mal Mat Mrk Luk Jhn Act Rom 1Co 2Co Gal Eph Php Col 1Th 2Th 1Ti 2Ti Tit Phm Heb Jas 1Pe 2Pe 1Jn 2Jn 3Jn Jud Rev".split())
RULE_EXCLUDED = tuple("1Es 2Es 3Es 4Es 1Ma 2Ma 3Ma 4Ma Ade Bar Bel Esg Jdt Lje LJe Man Oda Ps2 Sir Sus Tob Wis".split())
XREF_BOOKS = tuple("Gen Exod Lev Num Deut Josh Judg Ruth 1Sam 2Sam 1Kgs 2Kgs 1Chr 2Chr Ezra Neh Esth Job Ps Prov Eccl Song Isa Jer Lam Ezek Dan Hos Joel Amos Obad Jonah Mic Nah Hab Zeph Hag Zech Mal Matt Mark Luke John Acts Rom 1Cor 2Cor Gal Eph Phil Col 1Thess 2Thess 1Tim 2Tim Titus Phlm Heb Jas 1Pet 2Pet 1John 2John 3John Jude Rev".split())
XREF_EXCLUDED = tuple("Tob Jdt Wis Sir Bar EpJer 1Macc 2Macc 3Macc 4Macc 1Esd 2Esd PrMan AddEsth PrAzar Sus Bel Ps151 Odes PssSol EpLao".split())

S, I, B, D, L = T.StringType(), T.IntegerType(), T.BooleanType(), T.DoubleType(), T.LongType()


def _table(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in fields])


TABLES: dict[str, T.StructType] = {
    "canonical_verses": _table(("id", S, False), ("book", S, False), ("chapter", I, False), ("verse", I, False), ("canonStatus", S, False), ("theologicalCategory", S, True)),
    "verse_texts": _table(
        ("canonicalId", S, False), ("translation", S, False), ("text", S, False), ("embeddingModel", S, True), ("thematicTags", T.ArrayType(S, False), False),
        ("culturalContext", S, True), ("humanReviewed", B, False), ("reviewedBy", S, True), ("authorizedLevels", T.ArrayType(S, False), False),
    ),
    "original_words": _table(("canonicalId", S, False), ("position", I, False), ("lexeme", S, False), ("strongId", S, True), ("strongRaw", S, True), ("morphology", S, True), ("edition", S, True)),
    "strongs": _table(("id", S, False), ("language", S, False), ("lemma", S, False), ("transliteration", S, True), ("definition", S, False)),
    "edges": _table(("sourceId", S, False), ("targetId", S, False), ("kind", S, False)),
    "embeddings": _table(("canonicalId", S, False), ("translation", S, False), ("embedding", T.ArrayType(D, False), False), ("embeddingModel", S, False)),
    "curation_log": _table(("canonicalId", S, False), ("field", S, False), ("newValue", S, False), ("author", S, False), ("timestamp", T.TimestampType(), False)),
    "reports": _table(("canonicalId", S, False), ("kind", S, False), ("comment", S, False), ("reportedBy", S, False), ("timestamp", T.TimestampType(), False), ("status", S, False)),
    "interpretations": _table(("canonicalId", S, False), ("viewLabel", S, False), ("text", S, False), ("tradition", S, True), ("source", S, True), ("humanReviewed", B, False), ("reviewedBy", S, True)),
    "passage_texts": _table(("passageId", S, False), ("book", S, False), ("chapter", I, False), ("verseStart", I, False), ("verseEnd", I, False), ("translation", S, False), ("text", S, False), ("embedding", T.ArrayType(D, False), True), ("embeddingModel", S, True)),
}

#: Primary keys.
KEYS = {
    "canonical_verses": ("id",),
    "verse_texts": ("canonicalId", "translation"),
    "original_words": ("canonicalId", "position"),
    "strongs": ("id",),
    "edges": ("sourceId", "targetId", "kind"),
    "embeddings": ("canonicalId", "translation"),
    "passage_texts": ("passageId",),
}

#: Foreign keys: (table, column, referenced table, referenced column); a null reference passes.
FOREIGN_KEYS = (
    ("verse_texts", "canonicalId", "canonical_verses", "id"),
    ("original_words", "canonicalId", "canonical_verses", "id"),
    ("original_words", "strongId", "strongs", "id"),
    ("edges", "sourceId", "canonical_verses", "id"),
    ("edges", "targetId", "canonical_verses", "id"),
    ("curation_log", "canonicalId", "canonical_verses", "id"),
    ("reports", "canonicalId", "canonical_verses", "id"),
    ("interpretations", "canonicalId", "canonical_verses", "id"),
)

#: The tables that a build writes, in the order in which foreign keys allow loading.
BUILT = ("canonical_verses", "strongs", "verse_texts", "original_words", "edges")

#: Intermediate records.
TAGGED_WORD = TABLES["original_words"]
RAW_VERSE = _table(("book", S, False), ("chapter", I, False), ("verse", I, False), ("verse_end", I, False), ("text", S, False), ("translation", S, False), ("tradition", S, False))
MAPPED_REF = _table(("book", S, False), ("chapter", I, False), ("verse", I, False), ("subverse", S, True))


def key_order(table: str) -> list[str]:
    return TABLES[table].fieldNames()
