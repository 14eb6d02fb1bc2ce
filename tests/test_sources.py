"""Readers of the sources, on texts of our own."""

import pytest
from pyspark.sql import functions as F

from lectern.errors import RuleError
from lectern.functions import grammar
from lectern.sources import tabular, xml
from lectern.sources.lines import numbered_lines


def lines(spark, text):
    return numbered_lines(spark.createDataFrame([(text,)], "value string")).cache()


BOOK = """﻿<usfx><book id="FRT"><p>front</p></book><book id="PSA"><h>head <f>x</f></h><c id="3"/><d>A song</d><d>of praise</d>
<v id="1" bcv="PSA.3.1"/>One  <add>two</add><f>note <zz/></f> three<ve/><v id="2-3"/>bridge<ve/><v id="4"/><ve/></book></usfx>"""


def test_usfx():
    rows = {(r[0], r[1], r[2], r[3], r[4]): r[5] for r in xml.parse_usfx(BOOK)}
    assert rows[("verse", "PSA", 3, 1, 1)] == "One two three"
    assert rows[("verse", "PSA", 3, 2, 3)] == "bridge"
    assert rows[("verse", "PSA", 3, 4, 4)] == ""
    assert rows[("chapter", "PSA", 3, None, 4)] == "A song of praise"
    assert ("skipped", "FRT", None, None, None) in rows


@pytest.mark.parametrize("bad", ['<usfx><book id="GEN"><zz/></book></usfx>', '<usfx><book id="GEN"><c id="1"/><v id="1" bcv="GEN.1.2"/>a<ve/></book></usfx>', '<usfx><book id="GEN"><c id="1"/><v id="3-2"/>a<ve/></book></usfx>', '<usfx><book id="GEN"><c id="1"/><v id="1"/>a<ve/><v id="1"/>b<ve/></book></usfx>', "<usfx></usfx>", "<usfx>"])
def test_usfx_fails_loudly(bad):
    with pytest.raises(RuleError):
        xml.parse_usfx(bad)


def test_usfx_dataframe(spark):
    rows = xml.rows_of(spark.createDataFrame([(BOOK,)], "value string"), xml.parse_usfx, xml.USFX_ROWS)
    got = xml.raw_verses(rows, "kjv", "Eng").collect()
    assert sorted((r.verse, r.verse_end, r.text) for r in got) == [(1, 1, "One two three"), (2, 3, "bridge")]


def test_lexicons():
    hebrew = '<osis><div type="x"><p/></div><div type="entry" n="7"><w ID="H7" lemma="L" xlit="l" xml:lang="arc"/>to <foreign xml:lang="x">gone</foreign><list><item>a  b</item></list><note type="x-typo">no<hi>no</hi></note><note type="translation">yes</note></div></osis>'
    assert xml.parse_hebrew_lexicon(hebrew) == [("H0007", "hebrew", "L", "l", "to a byes", 0)]
    greek = '<lex><entry strongs="00012"><strongs>12</strongs><greek unicode="U" translit="t"/>def <see language="GREEK"/><strongs_def>one <greek unicode="V"/></strongs_def></entry><entry strongs="13"><latin>alone</latin></entry></lex>'
    assert xml.parse_greek_lexicon(greek) == [("G0012", "greek", "U", "t", "def one", 0), ("G0013", "greek", "alone", None, "alone", 1)]
    for parse, bad in ((xml.parse_hebrew_lexicon, hebrew.replace("<hi>", "<zz>").replace("</hi>", "</zz>")), (xml.parse_hebrew_lexicon, hebrew.replace('"translation"', '"odd"')), (xml.parse_greek_lexicon, "<lex/>"), (xml.parse_greek_lexicon, greek.replace("00012", "0"))):
        with pytest.raises(RuleError):
            parse(bad)


def test_reference_grammar():
    got = grammar.parse_refs("Gen.1:2-4,6; 3:1!a; Psa.3:Title")
    assert [(i["kind"], i["start"]["book"], i["start"]["chapter"], i["start"]["verse"], i["start"]["subverse"], i["start"]["is_title"]) for i in got] == [
        ("range", "Gen", 1, 2, None, False), ("single", "Gen", 1, 6, None, False), ("single", "Gen", 3, 1, "a", False), ("single", "Psa", 3, None, None, True)]
    assert grammar.parse_refs("Gen.1:30-2:3")[0]["end"] | {"x": 1} == {"book": "Gen", "chapter": 2, "chapter_letter": None, "verse": 3, "is_title": False, "subverse": None, "x": 1}
    assert grammar.parse_refs("Gen.1:5a-c")[0]["end"]["subverse"] == "c"
    assert grammar.parse_refs("Esg.A:1")[0]["start"]["chapter_letter"] == "A"
    assert grammar.parse_refs("Esg.A:??")[0]["kind"] == "raw"
    for bad in ("Gen.1:??", "Gen.1:1a!b", "Psa.3:Title-2", "Xyz.1:1", "Gen.1:1; Exo.2", "1:1", ""):
        with pytest.raises(grammar.GrammarError):
            grammar.parse_refs(bad)


def test_predicate_grammar():
    got = grammar.parse_tests("Gen.1:31=Last && Gen.2:1=NotExist & Psa.3:TextBeforeV1=Exist & Gen.1:1*2+1:2 < Gen.1:3", "Gen")
    assert [(t["kind"], t["expected"]) for t in got] == [("last", True), ("exists", False), ("text_before", True), ("compare", None)]
    assert [(x["ref"]["verse"], x["factor"]) for x in got[3]["left"]] == [(1, 2), (2, 1)] if got[3]["left"][1]["ref"]["chapter"] else True
    assert grammar.parse_tests("") == grammar.parse_tests(None) == []
    for bad in ("Psa.3:TextBeforeV2=Exist", "Psa.3:TextBeforeV1=Last", "Gen.1:1=Maybe", "Gen.1:1*0 < Gen.1:2"):
        with pytest.raises(grammar.GrammarError):
            grammar.parse_tests(bad)


RULES = """notes
#DataStart(Expanded)
SourceType\tSourceRef\tStandardRef\tAction\tNoteMarker\tRN\tVN\tAV\tTests
'----
# comment
Hebrew\tPsa.3:2\tPsa.3:1\tRenumber verse*\t\t\t\t\tPsa.3:TextBeforeV1=NotExist
Hebrew+Greek\tGen.32:1\tGen.31:55\tRenumber verse\t\t\t\t\t
Greek\tBar.1:1\tBar.1:1\tKeep verse\t\t\t\t\t
\t\t\t
#DataEnd(Expanded)
Hebrew\tnonsense
"""


def test_rules(spark):
    rules, skipped = tabular.read_rules(lines(spark, RULES))
    assert sorted((r.line_no, r.source_type, r.action, r.starred, len(r.tests)) for r in rules.collect()) == [(6, "Hebrew", "Renumber verse", True, 1), (7, "Hebrew+Greek", "Renumber verse", False, 0)]
    assert [(r.line_no) for r in skipped.collect()] == [8]
    with pytest.raises(RuleError, match="Odd"):
        tabular.read_rules(lines(spark, RULES.replace("Keep verse", "Odd")))
    with pytest.raises(RuleError):
        tabular.read_rules(lines(spark, RULES.replace("#DataEnd(Expanded)", "")))


def hebrew_line(ref, lexeme="w", tag="{H0001}", morph="M"):
    return "\t".join([ref, lexeme, "", "", tag, morph, *[""] * 11])


def test_hebrew_words(spark):
    text = "\n".join(["header #1=x" if False else "header", hebrew_line("Gen.1.1#01=L", tag="H9003/{H0430}"), hebrew_line("Gen.1.1#02=Q(K)", tag="{H0001}\\\\H9014"), hebrew_line("Gen.1.1#02=L", lexeme=""), hebrew_line("Gen.1.2(1.1)#01=R", tag="")])
    words, stats = tabular.read_hebrew_words(lines(spark, text))
    assert sorted((r.canonicalId, r.position, r.strongId, r.edition) for r in words.collect()) == [("GEN_1_1", 1, "H0430", "L"), ("GEN_1_1", 2, "H0001", "Q(K)"), ("GEN_1_2", 1, None, "R")]
    assert stats == {"word_lines": 4, "skipped_books": 0, "skipped_empty": 1, "produced": 3}
    for bad in (hebrew_line("Gen.1.1#01=ZZ"), hebrew_line("Gen.1.1#01=L", tag="G0001"), hebrew_line("Gen.1.1#01=L") + "\tx", hebrew_line("Zzz.1.1#01=L")):
        with pytest.raises(RuleError):
            tabular.read_hebrew_words(lines(spark, bad))


def test_greek_words(spark):
    rows = ["Mat.1.1#01=NKO\tw\tg\tG0976=N-NSF", "Mat.17.15[17.14]#01=k\tx\tg\tG20447=V", "Mat.1.1(1.2){3.4}#02=N(K)\ty\tg\tG0001=A"]
    words, stats = tabular.read_greek_words(lines(spark, "\r\n".join(["# head", *rows])))
    got = sorted((r.canonicalId, r.position, r.strongId, r.strongRaw, r.morphology, r.edition) for r in words.collect())
    assert got == [("MAT_17_14", 1, None, "G20447", "V", "k"), ("MAT_1_1", 1, "G0976", "G0976", "N-NSF", "NKO"), ("MAT_1_1", 2, "G0001", "G0001", "A", "N(K)")]
    assert stats["produced"] == 3
    counts = tabular.edition_counts(words).first()
    assert (counts.received, counts.critical, counts.received_only, counts.critical_only) == (3, 2, 1, 0)
    for bad in ("Mat.1.1#01=NKO\t\tg\tG0976=N", "Mat.1.1#01=NKO\tw\tg\t", "Mat.1.1[1.2][1.3]#01=N\tw\tg\tG0976=N", "Mat.1.1#01=NN\tw\tg\tG0976=N", "Mat.1.1#01=N\tw\tg\tH0976=N"):
        with pytest.raises(RuleError):
            tabular.read_greek_words(lines(spark, bad))


HEAD = "From Verse\tTo Verse\tVotes\t#note\n"


def test_xrefs(spark):
    body = "Gen.1.1\tJohn.1.1-John.1.3\t5\nGen.1.1\tJohn.1.1\t-2\n\nGen.1.2\tPs.1.6-Ps.2.1\t1\nGen.1.3\tTob.1.1\t1\nGen.1.3\tGen.1.3\t1\n"
    direct, ranges, stats = tabular.read_xrefs(lines(spark, HEAD + body), ceiling=0.5)
    assert sorted(map(tuple, direct.collect())) == [("GEN_1_1", "JHN_1_1"), ("GEN_1_1", "JHN_1_2"), ("GEN_1_1", "JHN_1_3"), ("GEN_1_3", "GEN_1_3")]
    assert list(map(tuple, ranges.collect())) == [("GEN_1_2", "PSA_1_6", "PSA_2_1")]
    assert (stats["lines"], stats["discarded"], stats["negative_votes"], stats["expanded"]) == (5, 1, 1, 3)
    for bad in ("Gen.1.1\tJohn.1.3-John.1.1\t1\n", "Gen.1.1\tJohn.1.1\tx\n", "Gen.0.1\tJohn.1.1\t1\n", "Zzz.1.1\tJohn.1.1\t1\n", "Gen.1.1\tJohn.1.1\n", "Gen.1.1\tTob.1.1\t1\n"):
        with pytest.raises(RuleError):
            tabular.read_xrefs(lines(spark, HEAD + bad))
    with pytest.raises(RuleError):
        tabular.read_xrefs(lines(spark, body))


def test_line_numbers(spark):
    got = lines(spark, "﻿a\r\nb\n\nc").collect()
    assert [(r.line_no, r.line) for r in got] == [(1, "a"), (2, "b"), (3, ""), (4, "c")]


def test_native_lines_stay_lazy(spark):
    assert "line" in lines(spark, "x").select(F.col("line")).columns


def test_lists_inherit_from_segments():
    at = lambda i: tuple(i[k][f] for k in ("start", "end") if i[k] for f in ("book", "chapter", "verse", "subverse"))
    assert [at(i) for i in grammar.parse_refs("Gen.1:2-2:3,5")] == [("Gen", 1, 2, None, "Gen", 2, 3, None), ("Gen", 1, 5, None)]
    assert [at(i) for i in grammar.parse_refs("1Ki.12:24; 11:19, 21-22;; ,3")] == [("1Ki", 12, 24, None), ("1Ki", 11, 19, None), ("1Ki", 11, 21, None, "1Ki", 11, 22, None), ("1Ki", 11, 3, None)]
    assert [at(i) for i in grammar.parse_refs("Dan.4:34; 4:37a-c2,38")] == [("Dan", 4, 34, None), ("Dan", 4, 37, "a", "Dan", 4, 37, "c2"), ("Dan", 4, 38, None)]
    assert [at(i) for i in grammar.parse_refs("Gen.1:35*a,1!0,1.2,7-9!b")] == [("Gen", 1, 35, "a"), ("Gen", 1, 1, "0"), ("Gen", 1, 1, "2"), ("Gen", 1, 7, None, "Gen", 1, 9, "b")]
    assert grammar.parse_refs("Ade.10:4-13: 11:1")[0]["raw"] == "Ade.10:4-13: 11:1"
    for bad in ("Gen.1:5*", "Gen.1:5!A", "Gen.1:2,2:3", "Gen.1:", "Gen.1:2x3!", ";", "Gen.1:2-3:", "Esg.1"):
        with pytest.raises(grammar.GrammarError):
            grammar.parse_refs(bad)
