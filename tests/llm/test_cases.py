"""Hot keys, repeated ids, clashing names, and plain versions of what SQL cannot express."""

import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm import common, mixing, ordering, records, secrets, sharding, simhash, suffix_dedup, toxicity
from lectern.llm import sampling_fingerprints as icws

SF = "/root/testdata/sf0.001"
HOT = 100_000


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n=5):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def representatives(texts):
    """The least key of each component of texts with a Jaccard similarity of 0.8 or more, by comparing all pairs."""
    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4 and sets[a] & sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d for d in root if find(d) == d}


def test_pipeline_by_shingles(spark):
    """The whole pipeline against its stages done plainly, near-duplicates by the similarity of shingles themselves."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {d: r for d, r in rows.items() if plain_score(r.text, model) < 0.5}
    kept = representatives({d: r.text for d, r in clean.items()})
    assert 0 < len(kept) < len(clean) < len(rows)
    stage = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(list(clean.values()), docs.schema), SF)
    assert {r.doc_id for r in stage.collect()} == kept

    blotted = {d: plain_blot(rows[d].text) for d in kept}
    changed = spark.createDataFrame([(d, blotted[d], rows[d].lang, rows[d].source, rows[d].n_chars) for d in sorted(kept)], docs.schema)
    copies = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, changed, SF).collect())
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, filled = defaultdict(int), defaultdict(int)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] += r.length
        filled[r.sequence_id] += r.length
    assert dict(got) == {d: n * (len(own.encode(blotted[d], add_special_tokens=False).ids) + 1) for d, n in copies.items()}
    assert max(filled.values()) <= 1024


def plain_blot(text):
    spans = sorted((m.start(), k, m.end()) for k, r in enumerate(secrets.RULES) for m in re.finditer(r.pattern, text) if len(m[r.group]) >= r.least)
    out, at = "", 0
    for start, k, end in spans:
        if start >= at:
            out += text[at:start] + f"[{secrets.RULES[k].kind}]"
        at = max(at, end)
    return out + text[at:]


def plain_score(text, model):
    """The score without machines: each insult or threat looks at the words around it in its clause."""
    found = defaultdict(float)
    strongest, matched = 0.0, 0
    clauses = [[]]
    for piece in re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:,\n\"“”«»()|]", (text or "").lower()):
        if piece[0].isalpha():
            clauses[-1].append(piece)
        else:
            clauses.append([])
    for clause in clauses:
        stem = [next((w[:n] for n in toxicity.STEMS if w[:n] in model.stems), None) for w in clause]
        closed = model.insults.keys() | toxicity.REPORTS | toxicity.NEGATIONS | toxicity.TARGETS | toxicity.THREATS
        own_weight = [model.insults.get(w, 1.0) if w in closed or s is None else model.stems[s] for w, s in zip(clause, stem, strict=True)]
        tags = ["insult" if w in model.insults or (w not in closed and s) else "report" if w in toxicity.REPORTS else "negation" if w in toxicity.NEGATIONS else "target" if w in toxicity.TARGETS else "threat" if w in toxicity.THREATS else "other" for w, s in zip(clause, stem, strict=True)]
        weight, any_hit = 0.0, False
        for i, (w, tag) in enumerate(zip(clause, tags, strict=True)):
            if tag not in ("insult", "threat"):
                continue
            any_hit = True
            own = own_weight[i]
            if "negation" in tags[max(0, i - 3) : i]:
                kind, factor = "negated", 0.5
            elif "report" in tags[:i]:
                kind, factor = "reported", 0.5
            elif "target" in tags[max(0, i - 4) : i] + tags[i + 1 : i + 5]:
                kind, factor = "directed", 1.5
            else:
                kind, factor = "", 1.0
            found[tag, kind] += own
            weight += own * factor
        strongest, matched = max(strongest, weight), matched + any_hit
    x = [math.log1p(found[t, k]) for t in ("insult", "threat") for k in ("", "directed", "negated", "reported")] + [math.log1p(strongest), math.log1p(matched)]
    z = model.weights[-1] + (sum(a * b for a, b in zip(x, model.weights, strict=False)) if matched else 0.0)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_equal_plain_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    insult = next(iter(model.insults))
    more = [f"you {insult}", f"she is not a {insult}", f"he said you {insult}", f"{insult}, kill them", f"I will kill you. Never {insult}", "", None]
    df = spark.createDataFrame([*texts.items(), *[(10**6 + i, t) for i, t in enumerate(more)]], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    for d, t in [*texts.items(), *[(10**6 + i, t) for i, t in enumerate(more)]]:
        assert got[d] == pytest.approx(plain_score(t, model), abs=1e-9)


def test_weights_by_counts_equal_repeated_rows():
    r = np.random.default_rng(3)
    x, y, times = np.abs(r.standard_normal((40, 4))), r.integers(0, 2, 40), r.integers(1, 9, 40)
    once = toxicity.fit_weights(np.repeat(x, times, axis=0), np.repeat(y, times), np.ones(times.sum()))
    assert toxicity.fit_weights(x, y, times) == pytest.approx(once, abs=1e-6)


def plain_signature(text, samples):
    """A term at a time, a position at a time."""
    u = np.uint64
    counts, out = Counter(w.lower() for w in (text or "").encode().split()), []
    for position in range(1, samples + 1):
        best = None
        with np.errstate(over="ignore"):
            for term, n in counts.items():
                x = icws._mixed(np.array([u(xxhash.xxh64_intdigest(term)) ^ u(position) * icws._A]))
                y = icws._mixed(x + icws._A)
                r = -np.log(icws._uniform(x, 0)) - np.log(icws._uniform(x, 1))
                c = -np.log(icws._uniform(x, 2)) - np.log(icws._uniform(y, 0))
                t = np.floor(np.log(np.array([n], np.float32)) / r + icws._uniform(y, 1))
                rank = float((np.log(c) - r * (t - icws._uniform(y, 1) + np.float32(1)))[0])
                value = int(icws._mixed(x ^ t.astype(np.int64).view(u))[0] >> u(48))
                best = min(best or (rank, value), (rank, value))
        out.append(best[1] if best else 0)
    return out


def test_signatures_equal_plain_ones(monkeypatch):
    r = np.random.default_rng(7)
    texts = [" ".join(r.choice([f"w{i}" for i in range(40)], int(n))) for n in (1, 5, 60, 200)] + ["", None]
    signs = icws.signatures(pa.array(texts), 48)
    assert np.mean([signs[i].tolist()[k] == v for i, t in enumerate(texts) for k, v in enumerate(plain_signature(t, 48))]) > 0.99
    monkeypatch.setattr(icws, "MOST_PAIRS", 10)  # as a text with very many distinct words has it
    assert (icws.signatures(pa.array(texts), 48) == signs).all()


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_repeated_ids_are_rows_of_their_own(spark, parts):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    df = spark.createDataFrame([(5, a), (5, b), (3, b)], "doc_id long, text string").repartition(parts)
    assert {(r.doc_id, r.text) for r in simhash.keep_one(df).collect()} == {(5, a), (3, b)}


def test_mixing_with_any_other_names(spark):
    rows = [(i, f"word {i} " * (i % 5), f"s{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wanted = sorted((r.doc_id, r.taken) for r in mixing.mix(df, mixing.word_count(F.col("text"))).collect())
    for name in ("o_s", "o_c", "o_b", "t_s", "c_s", "f_s", "n", "first", "rows", "words", "weight", "size", "copies"):
        df = df.withColumn(name, F.lit("x"))
    assert sorted((r.doc_id, r.taken) for r in mixing.mix(df, mixing.word_count(F.col("text"))).collect()) == wanted
    df = df.withColumn("secrets", F.lit("x")).withColumn("rules", F.lit("x")).withColumn("bucket", F.lit("x"))
    assert secrets.find_secrets(df).count() == 60 and sharding.shard(df).count() == 60 and simhash.keep_one(df).count() <= 60


@pytest.fixture(scope="module")
def hot(spark):
    """100,000 rows of one null id, a third of them the same, and some others."""
    i = F.col("id")
    text = F.when(i % 3 == 0, F.lit("the very same text")).otherwise(F.concat_ws(" ", F.lit("text"), i.cast("string"), F.md5(i.cast("string"))))
    null = spark.range(HOT).select(F.lit(None).cast("long").alias("doc_id"), text.alias("text"), F.lit("s").alias("source"))
    other = spark.range(1000).select(i.alias("doc_id"), text.alias("text"), F.concat(F.lit("o"), (i % 3).cast("string")).alias("source"))
    path = common.scratch(spark, "hot")
    null.union(other).repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def largest_share(spark, df, column):
    return df.groupBy(column).count().agg(F.max("count") / F.sum("count")).first()[0]


def test_one_hot_key_is_many_ranges(spark, hot):
    n = HOT + 1000
    numbered, total = common.row_numbers(hot, [common.order_hash("doc_id"), F.col("doc_id")], "n", bucket_rows=5000)
    assert total == n and numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (0, n - 1, n)
    ranged = numbered.select(F.spark_partition_id().alias("p"))
    assert ranged.count() == n
    cuts = ordering.ranges(hot, bucket_rows=5000)
    placed = ordering.bucketed(hot, cuts).cache()
    assert len(cuts.bounds) >= 15 and largest_share(spark, placed, "bucket") < 0.2
    # buckets keep the order: no row of a bucket comes before one of the bucket before
    at = F.struct("o_null", "o_key", "o_begin", "o_hash")
    spans = [tuple(r) for r in placed.groupBy("bucket").agg(F.min(at), F.max(at)).orderBy("bucket").collect()]
    assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:], strict=False))


def test_operators_on_a_hot_key(spark, hot, tmp_path):
    n = HOT + 1000
    mixed = mixing.mix(hot, mixing.word_count(F.col("text")), bucket_rows=5000)
    rows = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert len(rows) == 4 and all(abs(r.taken - r.target) <= 10 and r.most <= 3 for r in rows)
    sharded = sharding.shard(hot, 24, ties=("text",)).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("last")).collect()
    assert sum(r.n for r in sharded) == n and all(r.n == r.d == r["last"] + 1 for r in sharded) and max(r.n for r in sharded) - min(r.n for r in sharded) <= 1
    path = str(tmp_path / "records")
    shards = records.write_records(hot, path, public_tokenizers.path("word_bpe_49k.json"), 2, bucket_rows=5000)
    assert sum(s[1] for s in shards) == n and max(s[1] for s in shards) < 0.2 * n
    read = records.read_records(spark, path, shards).agg(F.count(F.lit(1)), F.count_distinct("start"), F.max(F.col("start") + F.col("n_tokens")), F.sum("n_tokens")).first()
    assert read[0] == read[1] == n and read[2] == read[3]
    compared = icws.compare_edited(hot, samples=4, bucket_rows=5000)
    counted = compared.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("near_next") == 1).alias("same")).first()
    assert counted.n == n and counted.same >= HOT // 3 - 1


def test_ids_over_the_width_are_errors():
    with pytest.raises(ValueError):
        records.record(1, np.array([70_000], np.uint32), 2)
    assert records.parse(records.record(1, np.array([70_000], np.uint32), 4)[12:-4])[1].tolist() == [70_000]


def test_hot_cluster_is_whole(spark):
    """1,200 near copies of one text and 200 of another that is half like it: no link between different texts is lost."""
    r = np.random.default_rng(12)
    base = [f"w{x}" for x in r.integers(0, 1 << 40, 200)]
    half = [*base[:100], *[f"h{x}" for x in r.integers(0, 1 << 40, 100)]]
    texts = {}
    for i in range(1400):
        w = list(base if i < 1200 else half)
        for at in r.choice(200, int(r.integers(1, 8)), replace=False):
            w[int(at)] = f"e{r.integers(0, 1 << 40)}"
        texts[i] = " ".join(w)
    wanted = representatives(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    for block in (64, 256):
        assert {x.doc_id for x in simhash.keep_one(df, block=block).collect()} == wanted


def test_stages_on_hard_rows(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "x " * 200_000, None, "s", 5), (2, "x " * 200_000, None, "s", 5), (3, "password=abcdefgh1 and more", "en", None, 26), (None, "one two three", None, None, None)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    df = spark.createDataFrame(rows, schema).withColumn("size", F.lit("x")).withColumn("secrets", F.lit(1)).withColumn("copy", F.lit(2))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == list(corpus_pipeline.COLUMNS) and stage(spark, df.limit(0), SF).count() == 0
        got = {(r.doc_id, r.text) for r in out.collect()}
        if stage is corpus_pipeline.blot_secrets:
            assert out.count() == 6 and (3, "[assign] and more") in got and (1, None) in got
        elif stage is corpus_pipeline.drop_near_duplicates:
            assert out.count() == 4 and {d for d, _ in got} == {1, 2, 3, None}
    packed = corpus_pipeline.pack_sequences(spark, df, SF).collect()
    assert sum(r.doc_id == 2 and r.start == 0 for r in packed) == 2 and corpus_pipeline.pack_sequences(spark, df.limit(0), SF).count() == 0


def test_block_sizes_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (sorted(map(tuple, suffix_dedup.remove_repeats(docs, *s).collect())) for s in ((None, None), (20_000, 30_000)))
    assert a == b and zlib.crc32(b"") == 0


def test_secrets_of_a_text_with_very_many(spark):
    """100,000 matches in one text, some overlapping, are found and blotted out in seconds."""
    part = ["é%032x " % i for i in range(99_990)] + ["token=" + "%032x" % 7 + " AKIAABCDEFGHIJKL "] * 5
    texts = ["".join(part), "😀 secret = 12345678 é", None]
    df = spark.createDataFrame(list(enumerate(texts)) * 2, "doc_id long, text string")
    secrets.find_secrets(df.limit(3)).collect()
    began = time.time()
    out = secrets.redact(secrets.find_secrets(df)).select("doc_id", "text", F.size("secrets").alias("n")).collect()
    assert time.time() - began < 10
    assert Counter((r.doc_id, r.n, r.text) for r in out) == Counter({(i, n, None if t is None else plain_blot(t)): 2 for i, (t, n) in enumerate(zip(texts, (100_005, 1, 0), strict=True))})
