"""The stages of the corpus pipeline: toxic documents go, near-duplicates go, secrets are blotted out, sources are mixed, and what is left is packed.

Each stage is one of the operators here; what it returns is written as Parquet and read again as the next
stage's documents. All stages take any rows: a null, empty or very long text, a null or repeated key and
repeated rows are treated as the operator's docstring says, an empty table gives an empty table, and
columns beside those of `documents` are dropped, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, mixing, packing, secrets, simhash, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar, trained on the labels, scores 0.5 or more go. Null and empty texts match nothing and stay."""
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs.select(*COLUMNS), model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (a similarity of 0.8 or more over five-word shingles, by SimHash) the smallest doc_id stays; a null one only if its group has no other. Texts without words are one group."""
    return simhash.keep_one(docs.select(*COLUMNS))


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each secret is replaced by its kind; all documents stay, null texts as null. n_chars is counted anew where the text changed."""
    clean = secrets.redact(secrets.find_secrets(docs.select(*COLUMNS)))
    changed = F.size("secrets") > 0
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that each source's words come to its target. A null source is one of its own; a document without words is repeated or left out like others."""
    mixed = mixing.mix(docs.select(*COLUMNS), mixing.word_count(F.col("text")))
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and offset. A null or empty text is one piece, the end id alone."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", blot_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL can encode with a tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; tables that nothing reads any more are deleted."""
    docs, before = common.table(spark, sf_dir, "documents"), len(common.MADE)
    for name, stage in STAGES:
        docs = common.cut(stage(spark, docs, sf_dir), name)
        common.release(spark, common.MADE[before:-1])  # all but what has just been written
    return docs
