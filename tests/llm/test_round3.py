"""Operators 11 to 13: against plain versions, and in hard cases."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import filter_audit, importance, queries, sharding, toxicity, window_dedup

LONG = "lorem ipsum dolor 42 " * 30_000
ODD = "`doc id` long, text string, `a.b` string, rank int, part string, gram long, `o` int, __n int, fails int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def letters(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


# 11


def plain_features(text, longest):
    w = letters(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ09 é日\U0001f600-_\n@[`{", max_size=60)), max_size=8), st.integers(1, 3))
def test_features(texts, longest):
    row, bucket, many = importance.features(pa.array(texts, pa.string()), 10_000, longest)
    for i, t in enumerate(texts):
        assert sorted(bucket[row == i].tolist()) == sorted(zlib.crc32(f.encode()) % 10_000 for f in plain_features(t, longest))
        assert many[i] == len(letters(t))


def test_features_of_many_long_words_and_slices():
    texts = pa.array(["x", *("w" * n for n in range(200)), "é" * 5000, None, LONG]).slice(1)
    row, bucket, many = importance.features(texts, 997, 2)
    for i, t in enumerate(texts.to_pylist()):
        assert Counter(bucket[row == i].tolist()) == Counter(zlib.crc32(f.encode()) % 997 for f in plain_features(t, 2))


def plain_resample(rows, target, percent, least, longest):
    s, t = (Counter(zlib.crc32(f.encode()) % 10_000 for x in texts for f in plain_features(x, longest)) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    out = []
    for key, text in rows:
        own = [zlib.crc32(f.encode()) % 10_000 for f in plain_features(text, longest)]
        gains = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in own]
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gains) // len(gains) if gains else 0
        out.append((key, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(letters(text))))
    order = sorted((i for i, r in enumerate(out) if r[4] >= least), key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0, out[i][1], out[i][2]))
    rank = {i: n + 1 for n, i in enumerate(order[: len(order) * percent // 100])}
    return [(*r[:4], rank.get(i)) for i, r in enumerate(out)]


def test_resample(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 290, " ".join(rng.choice(["Law", "court", "tax", "ball", "goal", "é"], rng.integers(0, 40)))) for i in range(300)]
    rows += [(None, None), (None, "a b " * 20), (None, "a b " * 20), (7, ""), (8, LONG), (9, "?!")]
    target = ["law court tax " * 30, None, ""]
    df = spark.createDataFrame([(a, b, "x", 1, "p", 2, 3, 4, 5) for a, b in rows], ODD).repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for longest in (1, 2):
        got = importance.resample(df, importance.fit(df, goal, longest=longest), key="doc id", percent=25, least_words=20).collect()
        assert got[0].__fields__ == ["doc id", "n_features", "weight", "score", "rank"]
        want = plain_resample(rows, target, 25, 20, longest)
        sort = lambda r: tuple((x is None, x or 0) for x in r)
        assert sorted(map(tuple, got), key=sort) == sorted(want, key=sort)
    assert importance.resample(df.limit(0), importance.fit(df.limit(0), goal.limit(0)), key="doc id").collect() == []


# 12


def plain_audit(rows, labels):
    label = {}
    for key, q, t in labels:
        a, b = label.get(key, (0, 0))
        label[key] = (max(a, int(q == 1)), max(b, int(t == 1)))
    out = Counter()
    fails, parts = [], set()
    for key, text, source in rows:
        w, t = words(text), text or ""
        bad = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t))}
        bad["E"] = key is not None and any(k is not None and k < key and (x or "") == t for k, x, _ in rows)
        fails.append((source or "", {f for f in bad if bad[f]}, label.get(key, (0, 0)) if key is not None else (0, 0)))
        parts.add(source or "")
    for order in map("".join, permutations("ABCDE")):
        for part, bad, (good, toxic) in fails:
            first = next((i for i, f in enumerate(order) if f in bad), 5)
            for step, f in enumerate(order):
                out[part, order, step + 1, "kept"] += step < first
                out[part, order, step + 1, "removed"] += step == first
                out[part, order, step + 1, "redundant"] += f in bad and step > first
                out[part, order, step + 1, "unique_fails"] += bad == {f}
                out[part, order, step + 1, "good_lost"] += good * (step == first)
                out[part, order, step + 1, "toxic_lost"] += toxic * (step == first)
                out[part, f, "shapley"] += step == first
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {(p, o, s): (*(out[p, o, s, n] for n in names), out[p, o[s - 1], "shapley"]) for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)}


def audit_rows():
    rng = np.random.default_rng(5)
    texts = ["", None, "Tax #1 ", "a b c d " * 60, " ".join(map(str, range(250))), "X" * 300, " ".join(f"w{i} % É" for i in range(200)), LONG, "\U0001f600 | \x0b a"]
    rows = [(int(i), texts[rng.integers(0, len(texts) - 1)], [None, "", "web", "book"][rng.integers(0, 4)]) for i in rng.integers(0, 60, 90)]
    rows += [(None, "a b c d " * 60, "web"), (None, None, None), (61, LONG, "hot"), (62, LONG, "hot"), (3, "twice", "web"), (3, "twice", "web")]
    return rows, [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (4, None, 1), (None, 1, 1), (62, 1, None), (5, 1, 0), (6, 1, 0), (7, 0, 1)]


def test_audit(spark):
    rows, labels = audit_rows()
    df = spark.createDataFrame([(a, b, s, 7, "y", "x", 1, "p", 2, 3, 4, 5) for a, b, s in rows], f"id long, body string, site string, {ODD}").repartition(4)
    known = spark.createDataFrame([(*r, 1) for r in labels], "id long, quality int, toxic int, part int")
    got = filter_audit.audit(df, known, "id", "body", "site").collect()
    want = plain_audit(rows, labels)
    assert len(got) == len(want) and {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want
    assert filter_audit.audit(df.limit(0), known, "id", "body", "site").collect() == []


def test_audit_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 3)
    rows = [(i, "a" if i % 3 else "B|", f"part{i % 150}") for i in range(600)]
    got = filter_audit.audit(spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == plain_audit(rows, [])


# 13


def plain_removed(rows, span=window_dedup.SPAN):
    least = {}
    for key, text in rows:
        w = words(text)
        for i in range(len(w) - span + 1):
            if key is not None:
                g = tuple(w[i : i + span])
                least[g] = min(key, least.get(g, key))
    out = []
    for key, text in rows:
        w = words(text)
        gone = {j for i in range(len(w) - span + 1) if key is not None and least[tuple(w[i : i + span])] < key for j in range(i, i + span)}
        spans = [(i, i) for i in sorted(gone) if i - 1 not in gone]
        spans = [(a, next(j for j in range(a, len(w) + 1) if j not in gone)) for a, _ in spans]
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), spans, hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def sorted_rows(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:3], r[4]))


def removed(df, **more):
    return sorted_rows((r[0], r.n_words, r.n_removed, [(s.start, s.end) for s in r.spans], r.kept_sha256, r.kept) for r in window_dedup.remove_repeated_windows(df, **more).collect())


def test_windows(spark):
    rng = np.random.default_rng(13)
    pool = [" ".join(rng.choice(list("abcdefghij"), 400)) for _ in range(6)]
    fresh = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**9, n))
    rows = []
    for i in range(150):
        w = words(pool[rng.integers(0, 6)])
        a, n = rng.integers(0, 300), rng.integers(20, 100)
        rows.append((int(rng.integers(0, 120)), f"{fresh(rng.integers(0, 30))}\x0b {' '.join(w[a : a + n])}\n{fresh(rng.integers(0, 60))}"))
    edited = words(pool[0])
    for i in range(40):  # near copies, with a word changed in each
        edited[9 * i] = f"changed{i}"
        rows.append((200 + i, " ".join(edited)))
    rows += [(300, pool[1])] * 3 + [(301, pool[1]), (None, pool[1]), (None, pool[1]), (None, None), (302, None), (303, ""), (304, "a " * 60), (305, "a " * 70), (306, "a " * 49), (307, "A " * 60)]
    rows += [(400, LONG), (401, "Ω " + LONG), (402, "x " * 3000 + pool[2])]
    df = spark.createDataFrame([(a, b, "x", 1, "p", 2, 3, 4, 5) for a, b in rows], ODD).repartition(6)
    want = plain_removed(rows)
    assert sum(0 < r[2] < r[1] for r in want) > 60
    assert removed(df, key="doc id") == sorted_rows(want)
    assert removed(df.limit(0), key="doc id") == []


def test_rolling_hashes_know_windows_by_their_words_alone():
    text = " ".join(np.random.default_rng(1).choice(list("abc"), 500))
    roll = window_dedup.Rolling(pa.array(["x y", text, None, "z " + text]))
    n = len(words(text))
    for size in (1, 16, 50):
        at = np.arange(n - size + 1)
        a, b = roll.of(roll.bounds[1] + at, roll.bounds[1] + at + size), roll.of(roll.bounds[3] + 1 + at, roll.bounds[3] + 1 + at + size)
        assert (a == b).all() and len(set(a.tolist())) == len({tuple(words(text)[i : i + size]) for i in at})


def test_intervals():
    assert window_dedup.intervals(np.array([9, 0, 4, 20]), np.array([12, 5, 9, 21])) == [(0, 12), (20, 21)]
    assert window_dedup.intervals(np.array([], np.int64), np.array([], np.int64)) == []


# all three


def test_queries_equal_their_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    for name in ("op11_importance", "op12_filter_audit", "op13_window_dedup"):
        df = queries.QUERIES[name](spark, sf)
        want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES[name]})").fetchall()
        assert Counter(map(tuple, df.collect())) == Counter(want), name


# 9, what is new in it


def test_stems_and_repeated_keys_in_training(spark):
    """Toxic words of one stem, each seen too seldom by itself; a key's least text is learned from, however often the key stands."""
    rng = np.random.default_rng(9)
    plain_words = [f"w{x}" for x in rng.integers(0, 10**6, 3000)]

    def prose(i, toxic):
        w = list(rng.choice(plain_words, 40))
        if toxic:
            for at in rng.choice(40, 3, replace=False):
                w[int(at)] = f"vexorq{rng.integers(0, 10**9)}"
        return " ".join(w).translate(str.maketrans("0123456789", "abcdefghij"))

    rows = [(i, prose(i, i % 4 == 0)) for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, "`doc id` long, text string")
    docs = df.withColumnRenamed("doc id", "doc_id")
    model = toxicity.train(docs, labels)
    assert "vexor" in model.stems and not any(w.startswith("vexor") for w in model.insults)
    got = {r["doc id"]: r.score for r in toxicity.score(df, model, key="doc id").collect()}
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i, _ in rows) > 1190
    again = docs.unionByName(spark.createDataFrame([(i, "~" + t) for i, t in rows] * 3, docs.schema))
    assert toxicity.train(again, labels) == model


# 4, what is new in it


def test_walks_end_however_short_the_first_one(spark, monkeypatch):
    for n in (2, 3, 5, 7, 50, 1010):
        whole = [r.y for r in sharding.permute(spark.range(n), "id", n, "y").orderBy("id").collect()]
        with monkeypatch.context() as m:
            m.setattr(sharding, "WALK", 1)
            assert [r.y for r in sharding.permute(spark.range(n), "id", n, "y").orderBy("id").collect()] == whole
        assert sorted(whole) == list(range(n))
