"""A database inside the driver's process as a sink."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from lectern.schemas import TABLES
from lectern.sinks import relational

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"

CLUSTER = """
import sys
from pyspark.sql import SparkSession
import __spark_entry__
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.checkpoint.dir", sys.argv[1]).config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("found", sorted(map(tuple, __spark_entry__.queries()["relational_load"](spark, "/root/testdata/sf0.001").collect())))
spark.stop()
"""


def test_load_from_tasks_of_other_processes(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    run = subprocess.run([sys.executable, "-c", CLUSTER, str(tmp_path)], cwd=tmp_path, env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    want = [("canonical_verses", 200, "kept", 200), ("edges", 199, "refused", 199), ("original_words", 200, "kept", 200), ("strongs", 10, "kept", 10), ("verse_texts", 400, "kept", 400)]
    assert f"found {want}" in run.stdout, run.stderr[-2000:]


@pytest.fixture
def database(spark, tmp_path):
    url = f"jdbc:derby:directory:{tmp_path}/db;create=true"
    yield url
    relational.close(spark, url, DRIVER)


def test_values_come_through_the_files(spark, database):
    odd = ["", " a ", 'q"u"o', '"', "a,b", "back\\slash", "line\nbreak", "cr\r\nlf", "\U0001f600～", "NULL", "tab\t", "'", "\\N"]
    tables = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    tables["canonical_verses"] = spark.createDataFrame([(f"GEN_1_{i}", "GEN", 1, i, "protestant", None if i == 0 else x) for i, x in enumerate(odd)], TABLES["canonical_verses"])
    tables["verse_texts"] = spark.createDataFrame([(f"GEN_1_{i}", "one", x, None, [x, "b"], None, i % 2 == 0, None, []) for i, x in enumerate(odd)], TABLES["verse_texts"])
    assert relational.load(spark, tables, database, DRIVER) == {"canonical_verses": len(odd), "strongs": 0, "verse_texts": len(odd), "original_words": 0, "edges": 0}
    for name in ("canonical_verses", "verse_texts"):
        found = relational.read(spark, name, database, DRIVER)
        assert sorted(found.collect(), key=str) == sorted(relational.encoded(tables[name], name).collect(), key=str)


def test_lexicon_of_the_stand_in_beyond_four_digits(spark, tmp_path):
    import duckdb
    from lectern.plans import catalog

    for name, sql in {
        "supplier": "SELECT k AS s_suppkey, 'S' || k AS s_name FROM range(10050) r(k)", "region": "SELECT 0::BIGINT AS r_regionkey",
        "part": "SELECT k AS p_partkey, 'P' || k AS p_name FROM range(30) r(k)",
    }.items():
        duckdb.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    found = {r["name"]: r["n"] for r in catalog.QUERIES["relational_load"](spark, str(tmp_path)).collect()}
    assert found["strongs"] == 10050


def _verses(spark, n: int, book: str = "GEN") -> dict:
    tables = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    tables["canonical_verses"] = spark.createDataFrame([(f"{book}_1_{i}", book, 1, i, "protestant", None) for i in range(1, n + 1)], TABLES["canonical_verses"])
    return tables


def test_staged_tables_take_the_places_of_the_old_ones(spark, database, monkeypatch):
    monkeypatch.setattr(relational, "_refill", lambda statement: pytest.fail("rows are inserted one by one"))
    assert relational.load(spark, _verses(spark, 3), database, DRIVER)["canonical_verses"] == 3
    assert relational.load(spark, _verses(spark, 5), database, DRIVER)["canonical_verses"] == 5
    broken = {  # a vocabulary, a reference and a key
        "23513": {"canonical_verses": spark.createDataFrame([("EXO_1_1", "EXO", 1, 1, "other", None)], TABLES["canonical_verses"])}, "X0Y45": {"edges": spark.createDataFrame([("GEN_1_1", "EXO_1_1", "tsk")], TABLES["edges"])},
        "23505": {"canonical_verses": spark.createDataFrame([("EXO_1_1", "EXO", 1, 1, "protestant", None)] * 2, TABLES["canonical_verses"])},
    }
    for state, rows in broken.items():
        with pytest.raises(Exception) as said:
            relational.load(spark, {**_verses(spark, 1, "EXO"), **rows}, database, DRIVER)
        assert state in str(said.value) or (state == "23513" and "X0Y59" in str(said.value))
        assert relational.counts(spark, database, DRIVER)["canonical_verses"] == 5
    with relational.transaction(spark, database, DRIVER) as statement:
        assert relational._plain(statement)  # with all keys, vocabularies and references
    with pytest.raises(Exception, match="23503"), relational.transaction(spark, database, DRIVER) as statement:
        statement.execute("INSERT INTO edges VALUES ('GEN_1_1', 'GEN_9_9', 'tsk')")


@pytest.mark.parametrize("other", ["CREATE VIEW firsts AS SELECT \"id\" FROM canonical_verses", "CREATE INDEX by_book ON canonical_verses (\"book\")", "ALTER TABLE strongs ADD COLUMN note VARCHAR(10)"])
def test_what_others_have_added_stays(spark, database, other):
    relational.load(spark, _verses(spark, 3), database, DRIVER)
    with relational.transaction(spark, database, DRIVER) as statement:
        statement.execute(other)
    assert relational.load(spark, _verses(spark, 5), database, DRIVER)["canonical_verses"] == 5
    with relational.transaction(spark, database, DRIVER) as statement:
        assert not relational._plain(statement)
