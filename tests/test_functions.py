"""Scalar functions, orders and serialisation."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lectern.errors import RuleError
from lectern.functions import ids, ordering, refs, tags, text
from lectern.schemas import BOOKS, KEYS, RULE_BOOKS, TABLES, XREF_BOOKS
from lectern.sinks import jsonl


def test_vocabularies():
    assert len(BOOKS) == len(set(BOOKS)) == len(RULE_BOOKS) == len(XREF_BOOKS) == 66
    assert all(set(KEYS[t]) <= set(TABLES[t].fieldNames()) for t in KEYS)


def test_ids(spark):
    rows = spark.createDataFrame([("GEN_1_1",), ("GEN_01_1",), ("XXX_1_1",), ("GEN_1_1000",), ("REV_22_21",), (None,), ("gen_1_1",)], "id string")
    got = [(r.v, r.k, r.p and tuple(r.p)) for r in rows.select(ids.valid_id(F.col("id")).alias("v"), ids.id_key(F.col("id")).alias("k"), ids.parse_id(F.col("id")).alias("p")).collect()]
    assert got == [(True, 1001, ("GEN", 1, 1)), (True, 1001, ("GEN", 1, 1)), (False, None, None), (False, None, None), (True, 65022021, ("REV", 22, 21)), (False, None, None), (False, None, None)]
    made = spark.range(1).select(ids.make_id(F.lit("GEN"), F.lit(1), F.lit(1000)).alias("a"), ids.make_id(F.lit("PSA"), F.lit(3), F.lit(0)).alias("b")).first()
    assert (made.a, made.b) == (None, "PSA_3_0")


def test_lexicon_ids(spark):
    rows = spark.createDataFrame([("1",), ("00012",), ("9999",), ("10000",), ("0",), ("x1",), (None,)], "d string")
    assert [r[0] for r in rows.select(ids.lexicon_id(F.lit("H"), F.col("d"))).collect()] == ["H0001", "H0012", "H9999", None, None, None, None]


def test_collapse(spark):
    rows = spark.createDataFrame([("  a \t\n b  ",), ("　",), ("﻿x y",), ("",), (None,)], "t string")
    got = rows.select(text.collapse(F.col("t")).alias("c"), text.word_count(F.col("t")).alias("n")).collect()
    assert [(r.c, r.n) for r in got] == [("a b", 2), ("", 0), ("x y", 2), ("", 0), (None, None)]


def test_tags(spark):
    rows = spark.createDataFrame([("{H1234A}",), ("H9001/H0001",), ("H0001/H0002",), ("G0001",), ("H12",), ("",), (None,)], "t string")
    got = rows.select(tags.classify(F.col("t"), F.lit("H")).alias("c")).collect()
    assert [tuple(r.c) for r in got] == [("H1234", None), ("H0001", None), (None, "roots"), (None, "language"), (None, "form"), (None, None), (None, None)]
    composite = spark.createDataFrame([("h0001+//H9002\\\\H0003",)], "t string").select(tags.hebrew_roots(F.col("t")).alias("r")).first().r
    assert (composite.root, composite.roots, composite.error) == ("H0001", ["H0001", "H0003"], None)
    extended = spark.createDataFrame([("G5624",), ("G5625",), ("G8999",), ("G9000",), ("H6000",), (None,)], "i string")
    assert [r[0] for r in extended.select(tags.without_entry_nulled(F.col("i"))).collect()] == ["G5624", None, None, "G9000", "H6000", None]


def test_word_types(spark):
    got = spark.createDataFrame([("N(k)O",), ("NN",), ("Nx",), ("",)], "t string").select(tags.word_type(F.col("t")).alias("w")).collect()
    assert (tuple(got[0].w.na), tuple(got[0].w.tr), tuple(got[0].w.other), got[0].w.error) == ((False, False), (True, True), (False, False), None)
    assert [r.w.error for r in got[1:]] == ["repeat", "form", "empty"]


def test_refs(spark):
    got = spark.createDataFrame([("Gen.1.2(3.4)#05=LA(x)",), ("Gen.1.2#05=ZZ",), ("Tob.1.1#01=L",), ("nonsense",)], "c string").select(refs.hebrew_ref(F.col("c")).alias("r")).collect()
    assert (got[0].r.book, got[0].r.other_chapter, got[0].r.type.base, got[0].r.type.marker) == ("GEN", 3, "LA", "x")
    assert [r.r.error for r in got] == [None, "text type", None, "form"]
    assert got[2].r.status == "excluded"


def test_greek_refs(spark):
    cells = {
        "Mat.1.2#01=NKO": (None, None, None, None), "Mat.17.15[17.14](1.2){3.4}#01=N(K)": ((17, 14), (1, 2), (3, 4), None), "Mat.1.2{3.4}#1=k": (None, None, (3, 4), None),
        "Mat.1.2[1.2][1.3]#01=N": ((1, 2), None, None, "repeat"), "Mat.1.2[1.2)#01=N": (None, None, None, "leftover"), "Mat.1.2[][3.4]#01=N": ((3, 4), None, None, "leftover"),
        "Mat.1.2(1.99999999999)#01=N": (None, (1, None), None, None), "Zzz.1.2(3.4)#01=N": (None, (3, 4), None, "book"), "Mat.1.2(1.2)(1.2)#01=N\n": (None, (1, 2), None, "repeat"), "nonsense": (None, None, None, "form"), None: (None, None, None, "form"),
    }
    made = spark.createDataFrame([(c,) for c in cells], "c string").select("c", refs.greek_ref(F.col("c")).alias("r")).collect()
    place = lambda c, v: None if c is None and v is None else (c, v)
    assert {r.c: (place(r.r.kjv_chapter, r.r.kjv_verse), place(r.r.na_chapter, r.r.na_verse), place(r.r.alt_chapter, r.r.alt_verse), r.r.error) for r in made} == cells
    codes = ["Gen", "Rev", "Tob", "Zzz", "", "Gen,Exo", "Gen=GEN", ",", None]
    books = spark.createDataFrame([(c,) for c in codes], "c string").select(ids.rule_book(F.col("c")).alias("b")).collect()
    assert [tuple(r.b) for r in books] == [("GEN", "known"), ("REV", "known"), (None, "excluded"), *[(None, "unknown")] * 6]


def test_refs_are_read_once_a_row(spark):
    from lectern.plans import catalog

    plan = catalog.QUERIES["ref_parse"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 2 and plan.count("RLIKE") < 10  # each use of a reference would read it again: 24


def test_total_order_is_independent_of_partitions(spark):
    rows = [("PSA_3_1", "GEN_1_1", "tsk"), ("GEN_1_2", "REV_1_1", "manual"), ("GEN_1_2", "REV_1_1", "tsk"), ("GEN_1_10", "EXO_1_1", "tsk")] * 1
    digests = set()
    for order in (rows, rows[::-1]):
        for n in (1, 8):
            digests.add(jsonl.digest(spark.createDataFrame(order, TABLES["edges"]).repartition(n), "edges"))
    assert len(digests) == 1
    lines = [r.line for r in jsonl.lines(spark.createDataFrame(rows, TABLES["edges"]), "edges").collect()]
    assert lines[0] == '{"sourceId":"GEN_1_2","targetId":"REV_1_1","kind":"tsk"}'
    assert digests == {hashlib.sha256("".join(x + "\n" for x in lines).encode()).hexdigest()}


def test_global_position(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    for small in (10, 10_000):
        assert sorted((r.k, r.n) for r in ordering.global_position(df, "k", out="n", small=small).collect()) == [(i, i + 1) for i in range(1000)]


def test_json_keys(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(jsonl.json_line(df, ["y", "x"])).first()[0] == '{"y":null,"x":"a"}'
    for keys in (["x"], ["x", "y", "z"]):
        with pytest.raises(RuleError):
            jsonl.json_line(df, keys)
