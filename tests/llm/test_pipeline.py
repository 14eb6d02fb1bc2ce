"""The pipeline against its stages done plainly, and the registered queries."""

import hashlib
import zlib
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm import mixing, queries, secrets, toxicity
from test_cases import representatives

SF = "/root/testdata/sf0.001"


def test_registered():
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in queries.QUERIES) == 1
    assert queries.QUERIES["pipeline"] is corpus_pipeline.run and set(queries.ORACLES) <= set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {d for d, r in rows.items() if toxicity.probability(toxicity.features(r.text, model), model.weights) < 0.5}
    assert 0 < len(kept) < len(rows)

    kept = representatives({d: rows[d].text for d in kept})  # by the exact similarity of shingles, all pairs compared
    stage = corpus_pipeline.drop_near_duplicates(spark, corpus_pipeline.drop_toxic(spark, docs, SF), SF)
    assert {r.doc_id for r in stage.collect()} == kept

    clean = {r.doc_id: r for r in corpus_pipeline.blot_secrets(spark, docs, SF).collect()}
    for d, r in clean.items():
        assert (r.text == rows[d].text) == (not secrets_in(rows[d].text)) and r.n_chars == (len(r.text) if r.text != rows[d].text else rows[d].n_chars)

    mixed = corpus_pipeline.mix_sources(spark, spark.createDataFrame([clean[d] for d in sorted(kept)], docs.schema), SF)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= kept and max(copies.values()) <= mixing.CAP

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {d: len(own.encode(clean[d].text, add_special_tokens=False).ids) + 1 for d in copies}
    out = corpus_pipeline.run(spark, SF).collect()
    got = defaultdict(int)
    for r in out:
        got[r.doc_id] += r.length
    assert dict(got) == {d: n * tokens[d] for d, n in copies.items()}
    filled = defaultdict(int)
    for r in out:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024


def secrets_in(text):
    import re

    return any(any(len(m[r.group]) >= r.least for m in re.finditer(r.pattern, text)) for r in secrets.RULES)


def test_queries_run(spark):
    for name, query in queries.QUERIES.items():
        rows = query(spark, SF).collect()
        assert rows, name
    ids = {r.doc_id for r in queries.QUERIES["op5_records"](spark, SF).collect()}
    assert len(ids) == 200 and zlib.crc32(b"") == 0 and hashlib.sha256(b"").hexdigest().startswith("e3b0")
