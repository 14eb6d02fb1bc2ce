"""What must grow with the input alone, and hold at every size."""

import uuid

import numpy as np
import pandas as pd
import pytest
from lectern.operators import builders
from lectern.plans import catalog
from lectern.sources import tabular, xml
from pyspark.sql import functions as F


@pytest.fixture
def staged_rows(monkeypatch):
    """Rows of what the builders stage."""
    seen, own = [], builders.staged

    def counted(df, name):
        out = own(df, name)
        seen.append(out.count())
        return out

    monkeypatch.setattr(builders, "staged", counted)
    return seen


def test_edges_are_written_out_last(spark, staged_rows):
    inventory = spark.createDataFrame([(f"GEN_{c}_{v}", v) for c in range(1, 6) for v in range(0, 300)], "id string, verse int")
    ranges = spark.createDataFrame([(f"GEN_{c}_1", f"GEN_{c}_1", f"GEN_{c + 1}_299") for c in range(1, 5)], "sourceId string, startId string, endId string")
    direct = ranges.select("sourceId", F.lit("GEN_1_0").alias("targetId"))
    made, stats = builders.edges(direct, ranges, inventory, 1.0)
    assert stats["expanded"] == 4 * 598 and stats["skipped_titles"] == 4 and made.count() == stats["final"] == 4 * 597 + 4
    assert max(staged_rows) < 50  # runs, spans and pieces, no verses


def test_edges_equal_brute_force_in_order(spark):
    rng = np.random.default_rng(5)
    books = ("GEN", "EXO", "REV")
    there = {(books[b], int(c), int(v)) for b, c, v in zip(rng.integers(0, 3, 150), rng.integers(1, 6, 150), rng.integers(0, 9, 150), strict=True)}
    key = lambda i: (books.index(i[:3]), *map(int, i.split("_")[1:]))
    ids = sorted({f"{b}_{c}_{v}" for b, c, v in there} | {"GEN_01_3", "GEN_1_3", "EXO_2_04"}, key=lambda i: (key(i), i))
    verse = {i: key(i)[2] for i in ids}
    pick = lambda: ids[rng.integers(0, len(ids))]
    ranges = [(s, *sorted((pick(), pick()), key=key)) for s in [pick() for _ in range(25)] * 2 + ["GEN_01_3", "GEN_1_3", "GEN_40_1"]]
    direct = [(pick(), pick()) for _ in range(80)] + [(s, s) for s in ids[:5]] + [("GEN_1_3", "REV_99_9"), ("none", ids[0])]
    written = [(s, i) for s, a, b in ranges for i in ids if key(a) <= key(i) <= key(b)]
    candidates = set(direct) | {(s, i) for s, i in written if verse[i] > 0}
    outside = {p for p in candidates if not set(p) <= set(ids)}
    want = sorted((p for p in candidates - outside if p[0] != p[1]), key=lambda p: (key(p[0]), key(p[1]), p))
    made, stats = builders.edges(spark.createDataFrame(direct, "sourceId string, targetId string"), spark.createDataFrame(ranges, "sourceId string, startId string, endId string"), spark.createDataFrame(list(verse.items()), "id string, verse int"), 1.0)
    assert [(r.sourceId, r.targetId) for r in made.collect()] == want
    loops = sum(a == b for a, b in candidates - outside)
    assert (stats["candidates"], stats["discarded"], stats["self_loops"], stats["final"]) == (len(candidates), len(outside), loops, len(want))
    assert (stats["expanded"], stats["skipped_titles"], stats["ranges"], stats["direct"]) == (sum(verse[i] > 0 for _, i in written), sum(verse[i] == 0 for _, i in written), len(ranges), len(direct))


def test_small_records_share_a_frame():
    n = 500
    entries = [f'<entry strongs="{i}"><greek unicode="w"/>d</entry>\n' for i in range(1, n + 1)]
    batch = pd.DataFrame({"path": "p", "nth": range(1, n + 1), "before": range(1, n + 1), "last": False, "opening": "<lexicon>\n", "record": entries})
    frames = list(xml._frames(iter([batch]), xml.GREEK))
    assert len(frames) == 1 and list(frames[0]["id"]) == [f"G{i:04d}" for i in range(1, n + 1)] and list(frames[0]["nth"]) == list(range(1, n + 1))


@pytest.fixture
def many_verses(spark, tmp_path):
    """Tables of parts with over 150 verses in each of a book's first chapters."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE part AS SELECT k + layer * 33000 AS p_partkey, 'name ' || k AS p_name FROM range(50) a(k), range(17) b(layer)")
    con.execute(f"COPY part TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT 0::BIGINT AS r_regionkey) TO '{tmp_path}/region.parquet' (FORMAT parquet)")
    return con, str(tmp_path)


@pytest.mark.parametrize("name", ["verse_texts_build", "verse_texts_counts"])
def test_texts_outside_the_inventory_at_every_size(spark, many_verses, name):
    con, folder = many_verses
    found = sorted(map(tuple, catalog.QUERIES[name](spark, folder).collect()))
    assert found == sorted(con.execute(catalog.ORACLES[name]).fetchall())


def test_rules_meet_verses_by_place(spark):
    from lectern.operators import versification

    ref = lambda c, v: {"book": "Gen", "chapter": c, "chapter_letter": None, "verse": v, "is_title": False, "subverse": None}
    point = "struct<book:string,chapter:int,chapter_letter:string,verse:int,is_title:boolean,subverse:string>"
    items = [(1, [{"kind": "single", "start": ref(2, 3), "end": None}]), (2, [{"kind": "range", "start": ref(1, 8), "end": ref(3, 2)}]), (3, [{"kind": "range", "start": ref(3, 2), "end": ref(3, 2)}]), (4, [{"kind": "range", "start": ref(3, 2), "end": ref(3, 1)}])]
    rules = spark.createDataFrame(items, f"line_no int, source array<struct<kind:string,start:{point},end:{point}>>")
    verses = [("GEN", c, v) for c in range(1, 5) for v in range(1, 10)]
    made = versification.matching_rules(spark.createDataFrame(verses, "book string, chapter int, verse int"), rules)
    spans = {1: (2003, 2003), 2: (1008, 3002), 3: (3002, 3002)}
    assert sorted(map(tuple, made.collect())) == sorted((b, c, v, n) for b, c, v in verses for n, (low, high) in spans.items() if low <= c * 1000 + v <= high)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 2 and all(line.count(" = ") >= 2 for line in joins)  # by book and place or chapter, never by book alone


def test_a_large_group_is_numbered_in_many_tasks(spark):
    from lectern.functions import ordering

    rows = [("hot" if i % 4 else f"g{i % 12}", (i * 7919) % 4001) for i in range(4001)]
    made = ordering.spread_position(spark.createDataFrame(rows, "g string, n long").repartition(6), "g", "n", small=10)
    want = [(g, n, at) for g in {g for g, _ in rows} for at, n in enumerate(sorted(n for h, n in rows if h == g), 1)]
    assert sorted(map(tuple, made.select("g", "n", "position").collect())) == sorted(want)
    assert "row_number" not in made._jdf.queryExecution().optimizedPlan().toString()


def _jobs(spark, work):
    """What work returns, and how many jobs it ran."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_greek_words_are_parsed_and_counted_in_one_job(spark):
    rows = [(n, f"Mat.1.{n % 3 + 1}{'[2.2]' if n % 4 == 0 else ''}#01=NKO\tw{n}\tg\tG0976=N") for n in range(1, 40)] + [(40, "Tob.1.1#01=N\tw\tg\tG0001=N"), (41, "# a note"), (42, None)]
    (words, stats), jobs = _jobs(spark, lambda: tabular.read_greek_words(spark.createDataFrame(rows, "line_no long, line string")))
    assert jobs == 1 and stats == {"word_lines": 40, "skipped_books": 1, "produced": 39}
    ids = [(n, "MAT_2_2" if n % 4 == 0 else f"MAT_1_{n % 3 + 1}") for n in range(1, 40)]
    want = [(i, [m for m, j in ids if j == i].index(n) + 1, f"w{n}") for n, i in ids]
    assert sorted(map(tuple, words.select("canonicalId", "position", "lexeme").collect())) == sorted(want)
    none, stats = tabular.read_greek_words(spark.createDataFrame([], "line_no long, line string"))
    assert none.count() == 0 and stats == {"word_lines": 0, "skipped_books": 0, "produced": 0}


def test_hebrew_words_are_parsed_and_counted_in_one_job(spark):
    line = lambda n, lexeme="w", book="Gen": (n, "\t".join([f"{book}.1.{n % 3 + 1}#01=L", lexeme, "", "", "H0001", "N", *[""] * 11]))
    rows = [line(n) for n in range(1, 30)] + [line(30, " "), line(31, book="Tob"), line(32, "", "Tob"), (33, None)]
    (words, stats), jobs = _jobs(spark, lambda: tabular.read_hebrew_words(spark.createDataFrame(rows, "line_no long, line string")))
    assert jobs == 1 and stats == {"word_lines": 32, "skipped_books": 2, "skipped_empty": 1, "produced": 29}
    assert sorted(map(tuple, words.select("canonicalId", "position").collect())) == sorted((f"GEN_1_{n % 3 + 1}", (n + 2) // 3) for n in range(1, 30))


def test_a_large_table_is_sorted_once_and_joined_once(spark):
    from lectern import scratch
    from lectern.functions import ordering

    rows = [(None if i % 7 == 0 else "hot" if i % 4 else f"g{i % 12}", None if i % 50 == 0 else i) for i in range(1, 2001)]
    df = scratch.staged(spark.createDataFrame(rows, "g string, n long").repartition(6), "words")
    made, jobs = _jobs(spark, lambda: ordering.spread_position(df, "g", "n", small=10, rows=len(rows)))
    placed = {}
    for r in sorted(made.collect(), key=lambda r: r.position):
        placed.setdefault(r.g, []).append((r.position, r.n))
    assert sum(map(len, placed.values())) == len(rows)
    for g, found in placed.items():
        own = sorted((n for h, n in rows if h == g), key=lambda n: (n is not None, n))
        assert found == [*enumerate(own, 1)]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Aggregate" not in plan  # the sorted rows and where groups begin, which is written
    assert jobs <= 7


@pytest.mark.parametrize("name", ["exegesis_lookup", "title_rows_union"])
def test_tasks_grow_with_the_rows(spark, monkeypatch, name):
    from lectern import scratch

    monkeypatch.setattr(scratch.tasks_of, "__defaults__", (500,))
    made = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    dealt = -(-spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count() // 500)
    assert dealt > 8 and f", {dealt})" in made._jdf.queryExecution().executedPlan().toString()


def test_a_lexicon_of_any_size_has_unique_ids(spark):
    from lectern.plans import catalog_sources

    made = {"supplier": spark.range(10050).selectExpr("id AS s_suppkey", "'s' AS s_name"), "lineitem": spark.range(5).selectExpr("id AS l_orderkey", "id AS l_partkey", "id * 2500 AS l_suppkey", "1 AS l_linenumber", "1.0D AS l_extendedprice")}
    lexicon = catalog_sources._words(made.get)[1]
    assert lexicon.count() == lexicon.select("id").distinct().count() == 10051


def test_what_is_sorted_is_worked_out_once(spark):
    from lectern.functions import ordering

    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def noted(x):
        seen.add(1)
        return x

    made = ordering.global_position(spark.range(100), noted(-F.col("id")), small=10)
    assert sorted(map(tuple, made.collect())) == [(i, 100 - i) for i in range(100)] and seen.value == 100


def test_verses_of_few_ranges_are_written_by_many_tasks(spark):
    from lectern.operators import versification

    point = "struct<book:string,chapter:int,chapter_letter:string,verse:int,is_title:boolean,subverse:string>"
    ref = lambda c, v: {"book": "Gen", "chapter": c, "chapter_letter": None, "verse": v, "is_title": False, "subverse": None}
    rules = spark.createDataFrame([(n, "Hebrew", [{"kind": "range", "start": ref(1, 1), "end": ref(2, 2)}]) for n in range(100)], f"line_no int, source_type string, standard array<struct<kind:string,start:{point},end:{point}>>")
    made = versification.standard_targets(rules, spark.createDataFrame([("GEN", 1, 50), ("GEN", 2, 50)], "book string, chapter int, last_verse int"))
    assert made.count() == 100 * 52
    assert made.select(F.spark_partition_id()).distinct().count() > 8


def test_repeated_keys_and_references_of_a_table_by_its_runs(spark, monkeypatch):
    from lectern.operators import quality

    keys = ["sourceId", "targetId", "kind"]
    rows = [(f"GEN_1_{s}", f"EXO_1_{t}", "tsk") for s in range(40) for t in range(30)]
    cases = {
        "none": rows, "side by side": [*rows, rows[-1]], "in a run": [*rows[:1200], rows[1170]], "in another run": [*rows, rows[0]], "nulls": [*rows, (None, "EXO_1_1", None), (None, "EXO_1_1", None)],
        "many": rows + rows, "another kind": [*rows, (*rows[-1][:2], "manual")], "empty": [],
    }
    for run in (quality.RUN, 7):
        monkeypatch.setattr(quality, "RUN", run)
        monkeypatch.setattr(quality, "SEEN", run)
        for name, made in cases.items():
            df = spark.createDataFrame(made, "sourceId string, targetId string, kind string").coalesce(2)
            marked = quality.marks(df, keys)
            assert sorted(map(str, quality.suspected(df, keys, marked).collect())) == sorted(map(str, quality.duplicates(df, keys).collect())), name
            for i, c in enumerate(keys):
                assert {r["ref"] for r in marked.filter(f"column = {i}").collect()} == {r[c] for r in df.collect()}, (name, c)


def test_edges_are_checked_without_a_shuffle_of_all(spark, monkeypatch):
    import uuid

    import pytest
    from lectern.errors import RuleError
    from lectern.operators import quality
    from lectern.schemas import TABLES
    from lectern.sinks import tables

    shuffled, plain = [], quality.duplicates
    count = lambda df, keys: (shuffled.append(df.count()) if tuple(keys) == ("sourceId", "targetId", "kind") else None, plain(df, keys))[1]
    monkeypatch.setattr(quality, "duplicates", count)
    monkeypatch.setattr(tables, "duplicates", count)
    verses = [(f"GEN_1_{i}", "GEN", 1, i, "protestant", None) for i in range(1, 51)]
    edges = [(a[0], b[0], "tsk") for a in verses for b in verses if a != b]
    made = {name: spark.createDataFrame([], TABLES[name]) for name in ("strongs", "verse_texts", "original_words")} | {"canonical_verses": spark.createDataFrame(verses, TABLES["canonical_verses"])}
    database = f"marks_{uuid.uuid4().hex}"
    try:
        assert tables.load(spark, database, {**made, "edges": spark.createDataFrame(edges, TABLES["edges"]).coalesce(1)})["edges"] == 2450
        assert shuffled == [0]
        for more, rule in ((edges[0], "the key is unique"), (("GEN_1_1", "GEN_9_9", "tsk"), "references are whole"), (("GEN_9_9", "GEN_1_1", "tsk"), "references are whole")):
            with pytest.raises(RuleError, match=rule):
                tables.load(spark, database, {**made, "edges": spark.createDataFrame([*edges, more], TABLES["edges"])})
        assert tables.open_tables(spark, database)["edges"].count() == 2450
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_roundtrip_of_more_entries_than_a_lexicon_has_numbers(spark, tmp_path):
    import duckdb
    from lectern.plans import catalog

    for name, sql in {
        "supplier": "SELECT k AS s_suppkey, 'S' || k AS s_name FROM range(20050) r(k)", "region": "SELECT 0::BIGINT AS r_regionkey", "part": "SELECT k AS p_partkey, 'P' || k AS p_name FROM range(60) r(k)",
        "lineitem": "SELECT k // 3 AS l_orderkey, k % 60 AS l_partkey, k * 7 % 20050 AS l_suppkey, (k % 3 + 1)::INTEGER AS l_linenumber, k::DOUBLE AS l_extendedprice FROM range(9000) r(k)",
    }.items():
        duckdb.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        duckdb.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet')")
    found = sorted(map(tuple, catalog.QUERIES["dataset_roundtrip"](spark, str(tmp_path)).collect()))
    assert found == sorted(map(tuple, duckdb.sql(catalog.ORACLES["dataset_roundtrip"]).fetchall()))
    assert ("strongs", 20051, True) in found


def test_compared_counts_repeats_and_nulls(spark):
    from lectern.operators import quality

    rows = lambda *r: spark.createDataFrame([*r], "a int, b array<string>")
    one, none = (1, ["x"]), (None, None)
    assert quality.compared(rows(one, none, none), rows(none, one, none)) == (3, True)
    for left, right in ((rows(one, none), rows(one)), (rows(one), rows(one, one)), (rows(one, one, none), rows(one, none, none)), (rows(), rows(none))):
        assert quality.compared(left, right) == (left.count(), False)
    assert quality.compared(rows(), rows()) == (0, True)


def test_verses_are_not_broadcast_for_their_texts(spark):
    from lectern.plans import catalog

    made = catalog.QUERIES["verse_texts_build"](spark, "/root/testdata/sf0.001")
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
