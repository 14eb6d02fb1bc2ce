"""Splits, one file a table, hashes, places of range ends, versions, records of XML, many searches and the curation state."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.errors import RuleError
from lectern.functions import ordering, text
from lectern.operators import builders, search
from lectern.schemas import BUILT
from lectern.sinks import jsonl, snapshots, tables
from lectern.sources import hashes, lines, xml
from lectern.sources import jsonl as source
from lectern.streaming import curation_log


@pytest.fixture
def small_splits(spark):
    """Files come in splits of 64 bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


FILES = {
    "a.txt": "﻿one\r\ntwo\n\nthree " + "x" * 200 + "\r\nlast\r", "b.txt": "x\n" * 100, "d.txt": "é\n" * 33 + "end", "e.txt": "\n", "f.txt": "﻿\n",
    "g.txt": "﻿abc", "h.txt": "\r\n" * 40, "i.txt": "y" * 63 + "\n" + "z" * 64 + "\n",
}


def test_lines_keep_their_numbers_over_splits(spark, tmp_path, small_splits):
    for name, body in FILES.items():
        (tmp_path / name).write_bytes(body.encode())
    (tmp_path / "empty.txt").write_bytes(b"")
    got = {}
    for r in lines.read_lines(spark, str(tmp_path)).collect():
        got.setdefault(r.path.rsplit("/", 1)[1], []).append((r.line_no, r.line))
    for name, body in FILES.items():
        want = [(i, x.removesuffix("\r")) for i, x in enumerate(body.removeprefix("﻿").split("\n"), 1)]
        assert sorted(got.pop(name)) == want, name
    assert got == {}
    assert lines.read_pieces(spark, str(tmp_path / "a.txt")).rdd.getNumPartitions() > 4


def test_hashes_are_those_of_the_bytes(spark, tmp_path, small_splits):
    bodies = {n: b.encode() for n, b in FILES.items()} | {"empty.txt": b"", "binary.bin": np.random.default_rng(1).bytes(300_000), "bare.txt": b"\n\n"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    got = {r.path.rsplit("/", 1)[1]: r.sha256 for r in hashes.file_hashes(spark, *(str(tmp_path / n) for n in bodies)).collect()}
    assert got == {n: hashlib.sha256(b).hexdigest() for n, b in bodies.items()}


def _texts(spark, n):
    rows = [(f"{b}_{c}_{v}", "one", f"{b} {c}:{v} é", None, ["b", "a"], None, False, None, ["public"]) for b in ("GEN", "1SA", "REV") for c in (1, 2, 11) for v in range(1, n)]
    return spark.createDataFrame(rows[::-1], "canonicalId string, translation string, text string, embeddingModel string, thematicTags array<string>, culturalContext string, humanReviewed boolean, reviewedBy string, authorizedLevels array<string>").repartition(5)


def test_one_ordered_file_for_each_book(spark, tmp_path):
    df = _texts(spark, 40)
    for _ in range(2):
        assert jsonl.write_by_book(df.withColumn("thematicTags", text.set_array(F.col("thematicTags"))), str(tmp_path / "out" / "verse_texts"), "verse_texts") == ["GEN", "1SA", "REV"]
        assert sorted(p.name for p in (tmp_path / "out" / "verse_texts").iterdir() if not p.name.startswith(".")) == ["1SA.jsonl", "GEN.jsonl", "REV.jsonl"]
    body = (tmp_path / "out" / "verse_texts" / "GEN.jsonl").read_text().splitlines()
    assert [json.loads(x)["canonicalId"] for x in body] == [f"GEN_{c}_{v}" for c in (1, 2, 11) for v in range(1, 40)]
    (tmp_path / "out" / "verse_texts" / "notes.txt").write_text("not a table")
    assert source.read_table(spark, str(tmp_path / "out" / "verse_texts"), "verse_texts").count() == 3 * 3 * 39
    jsonl.write_table(df, str(tmp_path / "all.jsonl"), "verse_texts")
    assert hashlib.sha256((tmp_path / "all.jsonl").read_bytes()).hexdigest() == jsonl.digest(df, "verse_texts")
    assert [p.name for p in tmp_path.iterdir() if "__" in p.name] == []


def test_broken_lines_are_named(spark, tmp_path, small_splits):
    good = '{"sourceId":"GEN_1_1","targetId":"GEN_1_2","kind":"tsk"}'
    (tmp_path / "x.jsonl").write_text("".join(f"{good.replace('GEN_1_2', f'GEN_1_{i}')}\n" for i in range(2, 50)) + good.replace("kind", "kinds") + "\n")
    with pytest.raises(RuleError) as e:
        source.read_table(spark, str(tmp_path / "x.jsonl"), "edges")
    assert e.value.rule == "edges: a line has the table's keys" and e.value.sample[0]["line_no"] == 49


def test_ranges_as_of_their_ends(spark):
    rng = np.random.default_rng(2)
    there = sorted({(b, int(c), int(v)) for b in ("GEN", "EXO", "REV") for c, v in rng.integers(1, 12, (40, 2))} | {("GEN", 50, 26), ("EXO", 1, 1), ("EXO", 1, 0)}, key=lambda x: (("GEN", "EXO", "REV").index(x[0]), *x[1:]))
    inventory = spark.createDataFrame([(f"{b}_{c}_{v}", v) for b, c, v in there], "id string, verse int")
    key = lambda x: (("GEN", "EXO", "REV").index(x[0]), *x[1:])
    ends = [(("GEN", "EXO", "REV")[rng.integers(0, 3)], int(rng.integers(1, 60)), int(rng.integers(0, 30))) for _ in range(120)]
    pairs = [tuple(sorted(p, key=key)) for p in zip(ends[::2], ends[1::2], strict=True)] + [(("GEN", 50, 26), ("EXO", 1, 1)), (("GEN", 51, 1), ("GEN", 60, 1)), (("GEN", 1, 1), ("REV", 99, 99))]
    ranges = spark.createDataFrame([(f"S{i}", f"{a[0]}_{a[1]}_{a[2]}", f"{b[0]}_{b[1]}_{b[2]}") for i, (a, b) in enumerate(pairs)], "sourceId string, startId string, endId string")
    found = builders.expand_ranges(ranges, inventory)
    want = sorted((f"S{i}", f"{x[0]}_{x[1]}_{x[2]}", x[2]) for i, (a, b) in enumerate(pairs) for x in there if key(a) <= key(x) <= key(b))
    assert sorted(map(tuple, found.collect())) == want
    with pytest.raises(RuleError):
        builders.expand_ranges(spark.createDataFrame([("S", "GEN_2_1", "GEN_1_9")], ranges.schema), inventory)


def test_counts_up_to_over_ranges(spark):
    rows = [(int(k), bool(k % 3)) for k in np.random.default_rng(4).integers(0, 500, 900)]
    got = {r.k: r.n for r in ordering.counts_up_to(spark.createDataFrame(rows, "k long, f boolean").repartition(7), "k", "f", "n").collect()}
    flagged = {k for k, f in rows if f}
    assert got == {k: sum(x <= k for x in flagged) for k, _ in rows}


def test_a_load_that_dies_leaves_one_version(spark, monkeypatch):
    database = "versions_test"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    verse = lambda note: spark.createDataFrame([("GEN_1_1", "GEN", 1, 1, "protestant", note)], "id string, book string, chapter int, verse int, canonStatus string, theologicalCategory string")

    def made(note):
        word = spark.createDataFrame([("GEN_1_1", 1, "w", "H0001", "H0001", note, "L")], "canonicalId string, position int, lexeme string, strongId string, strongRaw string, morphology string, edition string")
        entry = spark.createDataFrame([("H0001", "hebrew", "l", None, note)], "id string, language string, lemma string, transliteration string, definition string")
        edge = spark.createDataFrame([("GEN_1_1", "GEN_1_1", "tsk")], "sourceId string, targetId string, kind string")
        return {"canonical_verses": verse(note), "strongs": entry, "verse_texts": _texts(spark, 2).filter("canonicalId = 'GEN_1_1'").withColumn("text", F.lit(note)), "original_words": word, "edges": edge}

    def notes():
        t = tables.open_tables(spark, database)
        return {t["canonical_verses"].first()["theological_category"], t["strongs"].first()["definition"], t["verse_texts"].first()["text"], t["original_words"].first()["morphology"]}

    tables.load(spark, database, made("old"))
    assert notes() == {"old"}

    class Dies(Exception):
        pass

    def die(*_, **__):
        raise Dies

    steps = [(snapshots.Snapshots, "stage"), (tables, "enforce"), (snapshots.Snapshots, "switch"), (snapshots.Store, "write"), (snapshots.Store, "claim")]
    for owner, step in steps:
        with monkeypatch.context() as m:
            m.setattr(owner, step, die)
            with pytest.raises(Dies):
                tables.load(spark, database, made("new"))
        assert notes() == {"old"}, step
    with monkeypatch.context() as m:  # after the switch: names of the catalogue lag, readers of a version don't
        m.setattr(tables, "point", die)
        with pytest.raises(Dies):
            tables.load(spark, database, made("new"))
    assert notes() == {"new"} and spark.table(f"{database}.strongs").first()["definition"] == "old"
    tables.point(spark, database)
    assert {spark.table(f"{database}.{t}").count() for t in BUILT} == {1} and spark.table(f"{database}.strongs").first()["definition"] == "new"
    with pytest.raises(RuleError):
        tables.load(spark, database, {**made("bad"), "edges": spark.createDataFrame([("GEN_1_1", "GEN_9_9", "tsk")], "sourceId string, targetId string, kind string")})
    assert notes() == {"new"}
    left = tables.snapshots(spark, database)
    left.clean(1)
    assert notes() == {"new"} and len(left.store.names(f"{left.root}/versions")) == 1
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_two_writers(spark, tmp_path):
    versions = snapshots.Snapshots(spark, str(tmp_path / "v"))
    one, two = (versions.stage({"t": spark.range(n)})[0] for n in (1, 2))
    first = versions.switch(one, {"t": 1}, None)
    with pytest.raises(RuleError):
        versions.switch(two, {"t": 2}, None)
    assert versions.read()["t"].count() == 1
    versions.switch(two, {"t": 2}, first)
    assert versions.read()["t"].count() == 2 and versions.read(first)["t"].count() == 1


BOOK = '<book id="{}"><c id="1"/>\n<d>A title</d><v id="1"/>one <f>no <q>note</q></f>\n<w>word</w><ve/>\n<v id="2"/>two<ve/></book>\n'


def test_books_are_parsed_apart(spark, tmp_path, small_splits):
    body = '<?xml version="1.0"?>\n<usfx>\n<languageCode>en</languageCode>' + "".join(BOOK.format(b) for b in ("GEN", "FRT", "EXO", "REV")) + "</usfx>\n"
    (tmp_path / "b.xml").write_text(body)
    assert lines.read_pieces(spark, str(tmp_path / "b.xml")).rdd.getNumPartitions() > 4
    got = [tuple(r) for r in xml.read_usfx(spark, str(tmp_path / "b.xml")).orderBy("seq").collect()]
    assert got == [(*r[:6], i) for i, r in enumerate(xml.parse_usfx(body))]
    for bad, rule, line in (
        (body.replace("</usfx>", BOOK.format("GEN") + "</usfx>"), "a book stands once", None), (body.replace('<v id="2"/>two<ve/></book>\n<book id="REV">', '<v id="2"/><zz/>two<ve/></book>\n<book id="REV">'), "elements are known", 14),
        (body.replace("</book>\n<book id=\"REV\">", "\n<book id=\"REV\">"), "a record is whole", None), (body.replace("</usfx>", ""), "the file is well-formed XML", None), ("<usfx>\n</usfx>", "there are books", None),
    ):
        (tmp_path / "bad.xml").write_text(bad)
        with pytest.raises(Exception) as e:
            xml.read_usfx(spark, str(tmp_path / "bad.xml"))
        assert rule in str(e.value) and (line is None or f"(line {line})" in str(e.value)), (rule, str(e.value)[-600:])


def test_entries_are_parsed_apart(spark, tmp_path, small_splits):
    hebrew = "<osis>\n<div type='glossary'>\n" + "".join(f'<div n="{i}" type="entry"><w ID="H{i}" lemma="l{i}" xml:lang="heb"/> to <note type="exegesis">be {i}</note></div>\n' for i in range(1, 40)) + "</div></osis>"
    greek = "<lexicon><prologue>x</prologue>\n" + "".join(f'<entry strongs="{i}"><strongs>{i}</strongs> <greek unicode="u{i}"/> def {i}</entry>\n' for i in range(1, 40)) + "</lexicon>"
    (tmp_path / "h.xml").write_text(hebrew)
    (tmp_path / "g.xml").write_text(greek)
    got = sorted(map(tuple, xml.read_lexicon(spark, str(tmp_path / "h.xml"), str(tmp_path / "g.xml")).collect()))
    assert got == sorted(r[:5] for r in [*xml.parse_hebrew_lexicon(hebrew), *xml.parse_greek_lexicon(greek)])


def test_many_searches_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    vectors = rng.integers(-2, 3, (400, 6)).astype(float)  # many ties
    rows = [(f"k{i % 390:03d}", f"t{i % 3}", None if i == 5 else [1.0] if i == 6 else v.tolist()) for i, v in enumerate(vectors)]
    asked = [(q, rng.integers(-2, 3, 6).astype(float).tolist() if q != 3 else [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], int(rng.integers(1, 12)), None if q % 2 else f"t{q % 3}") for q in range(45)]
    df = spark.createDataFrame(rows, "canonicalId string, translation string, embedding array<double>").repartition(6)
    found = search.nearest_many(df, spark.createDataFrame(asked, "id int, vector array<double>, limit int, only string"), ("canonicalId", "translation"), group="translation")
    assert found._jdf.queryExecution().toString().count("MapInArrow") >= 1
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.canonicalId, r.translation))
    for q, vector, limit, only in asked:
        near = []
        for k, t, v in rows:
            if v and len(v) == 6 and any(v) and any(vector) and only in (None, t):
                fold = lambda xs: float(np.add.accumulate(xs)[-1])
                size = np.sqrt(fold([x * x for x in vector])) * np.sqrt(fold([x * x for x in v]))
                near.append((1 - fold([x * y for x, y in zip(vector, v, strict=True)]) / size, k, t))
        assert got.get(q, []) == [n[1:] for n in sorted(near)[:limit]], q


def test_gate(spark, tmp_path):
    golden = spark.createDataFrame([(1, ["a"]), (2, ["b", "c"])], "id int, expectedIds array<string>")
    rows = lambda *x: spark.createDataFrame(list(x), "id int, rank int, canonicalId string, distance double")
    right = lambda: rows((1, 1, "a", 0.25), (2, 1, "c", 0.5), (2, 2, "b", 0.75))
    at = str(tmp_path / "golden.jsonl")
    for _ in range(2):
        assert {(r.id, r.covered, r.strict) for r in search.gate(golden, right, at).collect()} == {(1, True, True), (2, True, False)}
    with pytest.raises(RuleError, match="snapshot"):
        search.gate(golden, lambda: rows((1, 1, "a", 0.25), (2, 1, "c", 0.5), (2, 2, "b", 0.7500001)), at)
    with pytest.raises(RuleError, match="expected ids"):
        search.gate(golden, lambda: rows((1, 1, "a", 0.25), (2, 1, "c", 0.5)))
    with pytest.raises(RuleError, match="expected ids"):
        search.gate(golden, right, strict=True)
    runs = iter([right(), rows((1, 1, "a", 0.25), (2, 1, "b", 0.5), (2, 2, "c", 0.75))])
    with pytest.raises(RuleError, match="run twice"):
        search.gate(golden, lambda: next(runs))


def test_units_of_strings(spark):
    values = ["～", "\U0001f600", "z", "", "퟿", "é"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    want = sorted(values, key=lambda v: v.encode("utf-16-be"))
    assert [r.v for r in df.orderBy(ordering.units(F.col("v"))).collect()] == want
    assert df.agg(text.set_array(F.concat(F.collect_list("v"), F.collect_list("v"))).alias("s")).first().s == want


def test_curation_state(spark, tmp_path):
    at, entry = tmp_path / "log", lambda i, value, second: json.dumps({"canonicalId": f"k{i}", "field": "f", "newValue": value, "author": "u", "timestamp": f"2024-01-01T00:00:{second:02d}Z"}) + "\n"
    at.mkdir()

    def run():
        curation_log.keep_latest(curation_log.read_log(spark, str(at)), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination(120)
        return {r.canonicalId: r.newValue for r in curation_log.read_latest(spark, str(tmp_path / "t")).collect()}

    assert curation_log.read_latest(spark, str(tmp_path / "t")).count() == 0
    (at / "1.json").write_text("".join(entry(i, "one", 10) for i in range(30)))
    assert set(run().values()) == {"one"}
    (at / "2.json").write_text(entry(1, "two", 20) + entry(2, "older", 5) + entry(1, "two", 20))
    assert run() == {f"k{i}": "two" if i == 1 else "one" for i in range(30)}
    changed = spark.read.parquet(str(max((tmp_path / "t" / "changes").glob("batch=*"), key=lambda p: int(p.name[6:]))))
    assert {r.canonicalId for r in changed.collect()} <= {"k1", "k2"}  # a batch writes what it touches, not all
    assert curation_log.compact(spark, str(tmp_path / "t")) >= 2 and curation_log.compact(spark, str(tmp_path / "t")) == 0
    (at / "3.json").write_text(entry(3, "three", 30))
    assert run()["k3"] == "three" and len(run()) == 30
