"""Versification, builders, retrieval, loading, and a whole build from files of our own."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lectern.errors import RuleError
from lectern.operators import builders, curation, embedding, quality, retrieval, versification
from lectern.plans import build as plan
from lectern.schemas import BUILT, TABLES
from lectern.sinks import jsonl, tables
from lectern.sources import jsonl as source
from lectern.sources import provenance, tabular, xml
from lectern.sources.lines import numbered_lines


def usfx(spark, *chapters):
    """Chapters (book, number, title, {verse: text})."""
    books = {}
    for book, number, title, verses in chapters:
        body = f'<c id="{number}"/>' + (f"<d>{title}</d>" if title else "") + "".join(f'<v id="{v}"/>{t}<ve/>' for v, t in verses.items())
        books[book] = books.get(book, "") + body
    text = "<usfx>" + "".join(f'<book id="{b}">{x}</book>' for b, x in books.items()) + "</usfx>"
    return text, xml.rows_of(spark.createDataFrame([(text,)], "value string"), xml.parse_usfx, xml.USFX_ROWS).cache()


def rules(spark, *rows):
    text = "\n".join(["#DataStart(Expanded)", *["\t".join([kind, src, dst, "Renumber verse", "", "", "", "", tests]) for kind, src, dst, tests in rows], "#DataEnd(Expanded)"])
    return tabular.read_rules(numbered_lines(spark.createDataFrame([(text,)], "value string")))[0]


def mapped(spark, edition, made, master, tradition="Hebrew"):
    verses = edition.filter("kind = 'verse'").select("book", "chapter", "verse")
    rows = versification.map_verses(verses, made, versification.features(edition), versification.last_verses(master), tradition).collect()
    return {(r.book, r.chapter, r.verse): [(t.book, t.chapter, t.verse) for t in r.targets] for r in rows}


@pytest.fixture(scope="module")
def master(spark):
    return usfx(spark, ("GEN", 31, None, {v: "a b" for v in range(1, 56)}), ("GEN", 32, None, {1: "a b c", 2: "d", 3: "e"}), ("PSA", 3, "T", {1: "x", 2: "y z", 3: ""}))[1]


def test_identity_and_renumbering(spark, master):
    got = mapped(spark, master, rules(spark, ("Hebrew", "Gen.32:1", "Gen.31:55", "Gen.32:1=Exist"), ("Hebrew", "Gen.32:2", "Gen.32:1", "Gen.32:9=Exist")), master)
    assert got[("GEN", 32, 1)] == [("GEN", 31, 55)]
    assert got[("GEN", 32, 2)] == [("GEN", 32, 2)]
    assert got[("PSA", 3, 1)] == [("PSA", 3, 1)]


@pytest.mark.parametrize(("test", "holds"), [("Gen.32:3=Last", True), ("Gen.32:2=Last", False), ("Psa.3:3=Exist", False), ("Psa.3:3=NotExist", True), ("Psa.3:Title=Exist", True), ("Psa.3:TextBeforeV1=Exist", True), ("Gen.32:TextBeforeV1=NotExist", True), ("Gen.32:1 > Gen.32:2", True), ("Gen.32:2*3 > Gen.32:1", False), ("Gen.32:2*3 < Gen.32:1", False), ("Gen.32:2+32:3 < Gen.32:1", True), ("Gen.32:1!a=Exist", False), ("Gen.32:1=Exist & Gen.32:9=Exist", False), ("", True)])
def test_predicates(spark, master, test, holds):
    made = rules(spark, ("Hebrew", "Gen.32:1", "Gen.32:2", test))
    assert bool(versification.active_rules(made, versification.features(master)).count()) is holds


def test_ranges_and_traditions(spark, master):
    one = mapped(spark, master, rules(spark, ("Hebrew", "Gen.32:1", "Gen.31:54-32:2", "")), master)
    assert one[("GEN", 32, 1)] == [("GEN", 31, 54), ("GEN", 31, 55), ("GEN", 32, 1), ("GEN", 32, 2)]
    agree = mapped(spark, master, rules(spark, ("Hebrew", "Gen.32:1", "Gen.32:2", ""), ("Greek", "Gen.32:1", "Gen.32:2", "")), master)
    assert agree[("GEN", 32, 1)] == [("GEN", 32, 2)]
    tie = rules(spark, ("Eng+Hebrew", "Gen.32:1", "Gen.32:2", ""), ("Greek", "Gen.32:1", "Gen.32:3", ""))
    assert mapped(spark, master, tie, master)[("GEN", 32, 1)] == [("GEN", 32, 2)]
    with pytest.raises(RuleError, match="agree"):
        mapped(spark, master, tie, master, "Latin")
    adding = mapped(spark, master, rules(spark, ("Hebrew", "Gen.32:1!a", "Gen.32:1", ""), ("Hebrew", "Gen.32:1!b", "Gen.32:2", "")), master)
    assert adding[("GEN", 32, 1)] == [("GEN", 32, 1), ("GEN", 32, 2)]
    for bad in ("Gen.31:3-Exo.1:2", "Gen.32:3-2", "Gen.40:1-41:2"):
        with pytest.raises(RuleError):
            mapped(spark, master, rules(spark, ("Hebrew", "Gen.32:1", bad, "")), master)


def test_texts(spark, master):
    inventory = builders.canonical_verses(master).cache()
    known, last = versification.features(master), versification.last_verses(master)
    none = rules(spark, ("Hebrew", "Exo.1:1", "Exo.1:2", "Exo.1:1=Exist"))
    texts, stats = builders.verse_texts(master, "kjv", "Hebrew", none, known, last, inventory)
    assert inventory.count() == 62 and stats == {"attempted": 61, "dropped": 0, "drop_rate": 0.0}
    assert texts.filter("canonicalId = 'PSA_3_0'").first().text == "T"
    with pytest.raises(RuleError, match="one text"):
        builders.verse_texts(master, "kjv", "Hebrew", rules(spark, ("Hebrew", "Gen.32:1", "Gen.32:2", "")), known, last, inventory)
    other = usfx(spark, ("EXO", 1, None, {1: "z"}))[1]
    with pytest.raises(RuleError, match="outside"):
        builders.verse_texts(other, "x", "Hebrew", none, versification.features(other), last, inventory)
    bridge = xml.rows_of(spark.createDataFrame([('<usfx><book id="GEN"><c id="1"/><v id="1-2"/>a<ve/></book></usfx>',)], "value string"), xml.parse_usfx, xml.USFX_ROWS)
    with pytest.raises(RuleError, match="bridge"):
        builders.canonical_verses(bridge)


def test_edges(spark, master):
    inventory = builders.canonical_verses(master).cache()
    pairs = [("GEN_32_1", "GEN_32_1"), ("GEN_32_1", "GEN_32_2"), ("GEN_32_1", "EXO_1_1")]
    direct = spark.createDataFrame(pairs, "sourceId string, targetId string")
    ranges = spark.createDataFrame([("GEN_31_1", "GEN_32_2", "PSA_3_1")], "sourceId string, startId string, endId string")
    made, stats = builders.edges(direct, ranges, inventory, ceiling=0.5)
    assert sorted((r.sourceId, r.targetId) for r in made.collect()) == [("GEN_31_1", "GEN_32_2"), ("GEN_31_1", "GEN_32_3"), ("GEN_31_1", "PSA_3_1"), ("GEN_32_1", "GEN_32_2")]
    assert (stats["candidates"], stats["discarded"], stats["self_loops"], stats["expanded"], stats["skipped_titles"], stats["final"]) == (6, 1, 1, 3, 1, 4)
    with pytest.raises(RuleError):
        builders.edges(direct, ranges, inventory)
    with pytest.raises(RuleError, match="ascends"):
        builders.edges(direct, ranges.select("sourceId", F.col("endId").alias("startId"), F.col("startId").alias("endId")), inventory)


def walk_by_paths(edges, start, hops):
    found, paths = {}, [(start,)]
    for depth in range(1, hops + 1):
        paths = [(*p, t) for p in paths for s, t in edges if s == p[-1] and t not in p]
        for p in paths:
            found.setdefault((p[-2], p[-1]), depth)
    return sorted((d, s, t) for (s, t), d in found.items())


@pytest.mark.parametrize("seed", range(4))
def test_walk_equals_paths(spark, seed):
    import random

    r = random.Random(seed)
    edges = sorted({(r.randrange(7), r.randrange(7)) for _ in range(14)})
    df = spark.createDataFrame([(s, t, "tsk") for s, t in edges], "sourceId long, targetId long, kind string")
    for hops in (1, 2, 3):
        assert [(x.depth, x.source, x.target) for x in retrieval.walk(df, 0, hops).collect()] == walk_by_paths(edges, 0, hops)
    for bad in (0, 4):
        with pytest.raises(RuleError):
            retrieval.walk(df, 0, bad)


def test_vector_search(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0], ["public"]), (2, [1.0, 0.0], ["curated"]), (3, [0.0, 1.0], ["public"]), (4, None, ["public"]), (5, [0.0, 0.0], ["public"])], "id long, v array<double>, levels array<string>")
    got = retrieval.nearest(rows, "v", [1.0, 0.0], 2, ("id",), retrieval.may_see(F.col("levels"), ["public"])).collect()
    assert [(r.id, r.distance) for r in got] == [(1, 0.0), (3, 1.0)]
    strict = rows.filter(retrieval.may_see(F.col("levels"), ["public", "curated"], superset=True))
    assert strict.count() == 0
    with pytest.raises(RuleError):
        retrieval.nearest(rows, "v", [1.0, 0.0], 51)


def test_guards(spark):
    parent, child = spark.createDataFrame([("a",)], "id string"), spark.createDataFrame([("a",), ("b",), (None,)], "ref string")
    assert [r.ref for r in quality.orphans(child, "ref", parent, "id").collect()] == ["b"]
    with pytest.raises(RuleError) as e:
        quality.enforce({"one": quality.orphans(child, "ref", parent, "id"), "two": quality.duplicates(child.union(child), ["ref"])})
    assert "one: 1" in str(e.value) and "two: 3" in str(e.value)
    quality.check_rate("rate", 5, 1000)
    with pytest.raises(RuleError):
        quality.check_rate("rate", 6, 1000)
    with pytest.raises(RuleError):
        quality.validate(spark.createDataFrame([("GEN_1_1", "GEN", 0, 1, "protestant", None)], TABLES["canonical_verses"]), "canonical_verses")


def test_embedding(spark):
    embedder = embedding.HashEmbedder(8)
    texts = spark.createDataFrame([(f"GEN_1_{i}", "kjv", f"word {i}") for i in range(1, 70)], "canonicalId string, translation string, text string")
    rows = embedding.embed_texts(texts, embedder, "hash", "1", 8, size=32).collect()
    assert len(rows) == 69 and all(abs(sum(x * x for x in r.embedding) - 1) < 1e-9 for r in rows)
    with pytest.raises(RuleError):
        embedding.embed_texts(texts, embedder, "hash", "2", 8)
    with pytest.raises(Exception, match="pinned size"):
        embedding.embed_texts(texts, embedder, "hash", "1", 9).collect()
    assert embedding.batch_size(None) == 32 and embedding.batch_size("7") == 7
    for bad in ("0", "x", "513"):
        with pytest.raises(RuleError):
            embedding.batch_size(bad)


def test_curation(spark):
    log = spark.createDataFrame([("a", "theologicalCategory", "x", "u", 1), ("a", "theologicalCategory", "y", "u", 2)], "canonicalId string, field string, newValue string, author string, timestamp long")
    rows = spark.createDataFrame([("a", None), ("b", "z")], "canonicalId string, theologicalCategory string")
    got = curation.apply_log(rows, log, {"theologicalCategory": "string"}).collect()
    assert sorted((r.canonicalId, r.theologicalCategory) for r in got) == [("a", "y"), ("b", "z")]


def hebrew(ref, tag):
    return "\t".join([ref, "w", "", "", tag, "M", *[""] * 11])


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sources")
    text, _ = usfx(spark, ("GEN", 1, None, {1: "In", 2: "And"}), ("PSA", 3, "Song", {1: "Lord"}), ("MAT", 1, None, {1: "Book"}))
    contents = {
        "kjv.xml": text, "web.xml": text.replace("In", "At"),
        "rules.txt": "#DataStart(Expanded)\nHebrew\tGen.9:1\tGen.9:2\tKeep verse\t\t\t\t\tGen.9:1=Exist\n#DataEnd(Expanded)\n",
        "h.txt": "\n".join([hebrew("Gen.1.1#01=L", "H0001"), hebrew("Gen.1.1#02=L", "H0002")]), "g.txt": "Mat.1.1#01=NKO\tw\tg\tG0001=N",
        "h.xml": '<o><div type="entry"><w ID="H1" lemma="a" xlit="b" xml:lang="heb"/>one</div><div type="entry"><w ID="H2" lemma="a" xml:lang="heb"/>two</div></o>',
        "g.xml": '<l><entry strongs="1"><greek unicode="c" translit="d"/>def</entry></l>',
        "x.txt": "From Verse\tTo Verse\tVotes\nGen.1.1\tMatt.1.1\t1\nGen.1.2\tGen.1.1-Ps.3.1\t2\n",
    }
    for name, body in contents.items():
        (at / name).write_text(body)
    (at / "manifest.json").write_text(json.dumps({"sources": {"all": {"files": {n: hashlib.sha256(b.encode()).hexdigest() for n, b in contents.items()}}, "bad": {"file": "kjv.xml", "sha256": "0"}, "held": {"file": "none.xml", "sha256": "0", "status": "quarantined"}}}))
    return at


def sources(at, **more):
    p = lambda n: str(at / n)
    return plan.Sources((plan.Edition("kjv", p("kjv.xml")), plan.Edition("web", p("web.xml"))), p("rules.txt"), (p("h.txt"),), (p("g.txt"),), p("h.xml"), p("g.xml"), p("x.txt"), manifest=p("manifest.json"), pinned=("all",), **more)


def test_whole_build(spark, files, tmp_path):
    made, manifest = plan.build(spark, sources(files), str(files))
    assert manifest["counts"] == {"canonical_verses": 5, "edges": 3, "original_words": 3, "strongs": 3, "verse_texts": 10}
    assert manifest["verseTextsByTranslation"] == {"kjv": 5, "web": 5} and manifest["strongsByLanguage"] == {"greek": 1, "hebrew": 2}
    assert sorted((r.sourceId, r.targetId) for r in made["edges"].collect()) == [("GEN_1_1", "MAT_1_1"), ("GEN_1_2", "GEN_1_1"), ("GEN_1_2", "PSA_3_1")]
    out = str(tmp_path / "out")
    for _ in range(2):
        plan.write(spark, made, manifest, out)
    back = source.read_canonical(spark, out)
    for name in BUILT:
        assert jsonl.digest(back[name], name) == jsonl.digest(made[name], name)
        assert quality.set_difference(back[name].select(*TABLES[name].fieldNames()), made[name].select(*TABLES[name].fieldNames())).count() == 0
    for _ in range(2):
        assert tables.load(spark, "corpus", back) == {"canonical_verses": 5, "strongs": 3, "verse_texts": 10, "original_words": 3, "edges": made["edges"].count()}
    assert tables.add_column(spark, "corpus.edges", "note", "string") and not tables.add_column(spark, "corpus.edges", "note", "string")
    embedded = embedding.embed_texts(back["verse_texts"], embedding.HashEmbedder(64), "hash", "1", 64).cache()
    full = tables.with_embeddings(back["verse_texts"], embedded, "hash@1")
    got = retrieval.search_by_theme(full, back["canonical_verses"], embedding.HashEmbedder(64), "Lord", ["public"], "web", 1).first()
    assert (got.canonicalId, got.translation, round(got.distance, 6)) == ("PSA_3_1", "web", 0.0)
    for bad in (embedded.limit(3), embedded.union(embedded)):
        with pytest.raises(RuleError):
            tables.with_embeddings(back["verse_texts"], bad)
    with pytest.raises(RuleError):
        tables.with_embeddings(back["verse_texts"], embedded, "hash@2")
    empty = spark.createDataFrame([], TABLES["interpretations"])
    verse = retrieval.exegesis("GEN_1_1", ["public"], back["canonical_verses"], back["verse_texts"], back["original_words"], back["strongs"], empty).first()
    assert [w.definition for w in verse.originalWords] == ["one", "two"] and len(verse.texts) == 2 and verse.interpretations == []
    assert retrieval.get_verse("GEN_9_9", ["public"], back["canonical_verses"], back["verse_texts"], back["original_words"], empty).count() == 0


def test_jsonl_fails_loudly(spark, tmp_path):
    good = '{"sourceId":"GEN_1_1","targetId":"GEN_1_2","kind":"tsk"}'
    for i, body in enumerate((good, good + "\n\n" + good + "\n", good.replace(',"kind":"tsk"', "") + "\n", good.replace("tsk", "odd") + "\n", "nonsense\n", good.replace("}", ',"x":1}') + "\n")):
        path = tmp_path / f"{i}.jsonl"
        path.write_text(body)
        with pytest.raises(RuleError):
            source.read_table(spark, str(path), "edges")
    (tmp_path / "ok.jsonl").write_text(good + "\n")
    assert source.read_table(spark, str(tmp_path / "ok.jsonl"), "edges").count() == 1
    (tmp_path / "empty.jsonl").write_text("")
    assert source.read_table(spark, str(tmp_path / "empty.jsonl"), "edges").count() == 0
    with pytest.raises(RuleError):
        source.read_table(spark, str(tmp_path / "missing.jsonl"), "edges")


def test_provenance(spark, files):
    manifest = provenance.read_manifest(spark, str(files / "manifest.json"))
    assert [n for n, _ in provenance.verify_sources(spark, str(files), manifest, ["all"])] == ["all"]
    with pytest.raises(RuleError) as e:
        provenance.verify_sources(spark, str(files), manifest, ["bad", "held", "absent"])
    assert all(x in str(e.value) for x in ("another hash", "quarantined", "is missing", "not in the manifest"))


def test_mappings_are_compared(spark):
    side = lambda *rows: spark.createDataFrame(list(rows), "k string, ids array<string>")
    left = side(("a", ["GEN_1_1"]), ("b", ["GEN_1_1", "GEN_1_2"]), ("c", ["GEN_1_1"]), ("d", ["GEN_1_1"]), ("e", ["GEN_1_1"]))
    right = side(("a", ["GEN_1_1"]), ("b", ["GEN_1_2", "GEN_1_3"]), ("c", ["GEN_2_1"]), ("d", ["GEN_1_2"]))
    accepted = spark.createDataFrame([("c", "conflict"), ("b", "conflict")], "k string, kind string")
    got = {r.k: r.kind for r in versification.compare_mappings(left, right, "k", accepted).collect()}
    assert got == {"b": "granularity", "d": "conflict", "e": "conflict"}


def test_registered_queries_match_their_sql(spark):
    """Each query against its SQL in DuckDB, on the smallest tables."""
    import glob
    import os

    import duckdb

    from lectern.plans import catalog

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    shown = lambda v: "" if v is None else repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    for name, query in catalog.QUERIES.items():
        df = query(spark, sf)
        own = sorted(tuple(shown(r[c]) for c in sorted(df.columns)) for r in df.collect())
        cursor = con.execute(catalog.ORACLES[name])
        names = [d[0] for d in cursor.description]
        order = sorted(range(len(names)), key=lambda i: names[i])
        assert [names[i] for i in order] == sorted(df.columns), name
        assert own == sorted(tuple(shown(r[i]) for i in order) for r in cursor.fetchall()), name


def test_manifest_keys():
    with pytest.raises(RuleError):
        jsonl.manifest_text({"version": 1})


def test_stream(spark, tmp_path):
    from lectern.streaming.curation_log import keep_latest, read_latest, read_log

    folder = tmp_path / "log"
    folder.mkdir()
    entry = lambda value, at: json.dumps({"canonicalId": "a", "field": "f", "newValue": value, "author": "u", "timestamp": at}) + "\n"
    (folder / "1.json").write_text(entry("x", "2024-01-01T00:00:00Z") * 2)
    keep_latest(read_log(spark, str(folder)), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination(120)
    (folder / "2.json").write_text(entry("y", "2024-01-01T01:00:00Z"))
    keep_latest(read_log(spark, str(folder)), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination(120)
    assert [r.newValue for r in read_latest(spark, str(tmp_path / "t")).collect()] == ["y"]
