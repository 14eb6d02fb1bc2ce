"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text falls into clauses at punctuation. A lexical transducer turns each word into a tag: insult, threat,
target (whom it addresses), negation, report (he said ...), or other; insults have weights of their own,
learned from labels. Its lexicon has words and stems, after which a word may go on in any way. Deterministic transducers over tags are composed: negation softens an insult or
threat within reach after it, a report softens what follows in its clause; a second machine, read from
right to left, marks those with a target near on either side as directed. The weighted outputs score
the clause; a document's score is a logistic function of what its matched clauses add up to.

Learning takes a bounded sample of labelled rows: half of it finds the lexicon (words that stand in many
different contexts of toxic texts and in hardly any of clean ones), the other half fits the weights.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import slices

#: Labelled rows that learning takes, at most; contexts and log odds that a word needs for the lexicon.
TRAIN_ROWS, LEAST_CONTEXTS, LEAST_ODDS = 20_000, 6, 2.5
#: Letters of stems, longest first; words that a worker remembers.
STEMS, REMEMBERED = (7, 5), 50_000

TAGS = ("other", "insult", "threat", "target", "negation", "report")
#: Outputs of the composed machines.
OUTPUTS = (*TAGS, "insult_negated", "threat_negated", "insult_reported", "threat_reported", "insult_directed", "threat_directed")
O, I, T, Y, N, R, IN, TN, IR, TR, ID, TD = range(len(OUTPUTS))

#: Closed word classes (fixed values).
TARGETS = frozenset("you your yours yourself u ur he she they him her them his their du dich dir dein deine euch ihr ihn ihnen sie er tu te toi ton ta tes vous votre vos il elle ils elles lui leur tú ti tuyo usted ustedes vosotros él ella ellos ellas le les".split())
NEGATIONS = frozenset("not no never neither nor without isn't aren't wasn't don't doesn't didn't nicht kein keine keinen nie niemals ohne ne pas jamais sans aucun ni nunca jamás sin ningún".split())
REPORTS = frozenset("said says say told claimed wrote writes called quoted quote reported allegedly sagte sagt schrieb behauptet nannte zitiert dit disait déclaré écrit appelé cité dijo dice escribió llamó citó".split())
THREATS = frozenset("kill murder destroy shoot stab strangle hang beat rape töten umbringen schlagen erschießen sterben tuer frapper crever mourir matar golpear disparar morir".split())

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_PIECE = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:,\n\"“”«»()|]")


@dataclass(frozen=True)
class Machine:
    """A deterministic transducer over tags: step[state][tag] = (state, output); it starts in state 0."""

    step: tuple[tuple[tuple[int, int], ...], ...]

    def run(self, tags: list[int]) -> list[int]:
        state, out = 0, []
        for tag in tags:
            state, done = self.step[state][tag]
            out.append(done)
        return out

    def then(self, other: Machine) -> Machine:
        """The composition: what this one puts out is read by the other."""
        width = len(other.step)
        rows = []
        for a in range(len(self.step)):
            for b in range(width):
                row = []
                for a2, out in self.step[a]:
                    b2, last = other.step[b][out]
                    row.append((a2 * width + b2, last))
                rows.append(tuple(row))
        return Machine(tuple(rows))


def negation_machine(reach: int = 3) -> Machine:
    """State: how many more words a negation reaches."""
    turned = {I: IN, T: TN}
    return Machine(tuple(tuple((reach if t == N else max(0, s - 1), turned.get(t, t) if s else t) for t in range(len(OUTPUTS))) for s in range(reach + 1)))


def report_machine() -> Machine:
    """State 1: the clause reports somebody's words."""
    turned = {I: IR, T: TR, IN: IN, TN: TN}
    return Machine(tuple(tuple((1 if s or t == R else 0, turned.get(t, t) if s else t) for t in range(len(OUTPUTS))) for s in range(2)))


def target_machine(reach: int = 4) -> Machine:
    """State: how many more words a target reaches."""
    turned = {I: ID, T: TD}
    return Machine(tuple(tuple((reach if t == Y else max(0, s - 1), turned.get(t, t) if s else t) for t in range(len(OUTPUTS))) for s in range(reach + 1)))


_FORWARD = negation_machine().then(report_machine()).then(target_machine())
_BACKWARD = target_machine()


@dataclass
class Model:
    """The insult lexicon with its weights (words, and stems), and a document's logistic weights (the last is the bias)."""

    insults: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = ()
    stems: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        tags = {w: T for w in THREATS} | {w: Y for w in TARGETS} | {w: N for w in NEGATIONS} | {w: R for w in REPORTS} | dict.fromkeys(self.insults, I)
        self.known = {w: (t, self.insults.get(w, 1.0)) for w, t in tags.items()}
        self.memory: dict[str, tuple[int, float]] = {}

    def of(self, word: str) -> tuple[int, float]:
        """A word's tag and weight: its own, or else an insult's by its longest stem."""
        found = self.known.get(word) or self.memory.get(word)
        if found is None:
            stem = next((word[:n] for n in STEMS if word[:n] in self.stems), None) if self.stems else None
            found = (O, 1.0) if stem is None else (I, self.stems[stem])
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[word] = found
        return found


#: Features: of each kind of match its clauses' weights together, then the strongest clause and the matched clauses.
_KINDS = (I, ID, IN, IR, T, TD, TN, TR)
FEATURES = len(_KINDS) + 2


def features(text: str | None, model: Model) -> np.ndarray | None:
    """None if no clause matches."""
    low = (text or "").lower()
    hits = {w for w in set(_WORD.findall(low)) if model.of(w)[0] in (I, T)}
    if not hits:
        return None
    total, strongest, matched = np.zeros(len(_KINDS)), 0.0, 0
    for clause in clauses(low):
        if hits.isdisjoint(clause):
            continue
        tagged = [model.of(w) for w in clause]
        outputs = _BACKWARD.run(_FORWARD.run([tag for tag, _ in tagged])[::-1])[::-1]
        weight = 0.0
        for (_, own), out in zip(tagged, outputs, strict=True):
            if out in _KINDS:
                total[_KINDS.index(out)] += own
                weight += own * (1.5 if out in (ID, TD) else 0.5 if out in (IN, TN, IR, TR) else 1.0)
        strongest, matched = max(strongest, weight), matched + 1
    return np.concatenate([np.log1p(total), [math.log1p(strongest), math.log1p(matched)]])


def clauses(low: str) -> Iterator[list[str]]:
    clause: list[str] = []
    for piece in _PIECE.findall(low):
        if piece[0].isalpha():
            clause.append(piece)
        elif clause:
            yield clause
            clause = []
    if clause:
        yield clause


def probability(x: np.ndarray | None, weights: tuple[float, ...]) -> float:
    z = weights[-1] + (0.0 if x is None else float(np.dot(x, weights[:-1])))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_weights(x: np.ndarray, y: np.ndarray, times: np.ndarray, penalty: float = 0.1, rounds: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression by Newton's method, each row counted so many times; no match counts in favour of a text: features that would are left out."""
    x = np.hstack([x, np.ones((len(x), 1))])
    used = np.ones(x.shape[1], bool)
    while True:
        part, w = x[:, used], np.zeros(used.sum())
        ridge = np.where(np.arange(used.sum()) < used.sum() - 1, penalty, 1e-3)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            hessian = (part * (times * p * (1 - p))[:, None]).T @ part + np.diag(ridge)
            move = np.linalg.solve(hessian, part.T @ (times * (p - y)) + ridge * w)
            w = w - move
            if np.abs(move).max() < 1e-6:
                break
        full = np.zeros(x.shape[1])
        full[used] = w
        if (full[:-1] >= 0).all():
            return tuple(full.tolist())
        used[:-1] &= full[:-1] >= 0


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learns from labelled rows that aren't held out; a key with several labels is toxic if any is, and of several documents of a key the least text is learned from. Without both labels the lexicon is empty."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = known.count()
    share = min(1.0, rows / max(1, n))
    some = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else known
    some = some.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)))
    sample = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # about `rows` rows of two numbers
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"), F.first("half").alias("half"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 0, 256, 500_000)):
            out: tuple[list, ...] = ([], [], [])
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _WORD.findall((text or "").lower())
                for before, word in set(zip(["", *words], words, strict=False)):
                    context = xxhash.xxh64_intdigest(before.encode()) >> 1
                    for entry in (word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)):
                        for column, value in zip(out, (entry, context, toxic), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())], names=["word", "before", "toxic"])

    seen = sample.filter("half = 0").select("text", "toxic").mapInArrow(contexts, "word string, before long, toxic int")
    # a context (the word before) counts once, however many copies of a text hold it
    once = seen.groupBy("word", "before").agg(F.max("toxic").alias("bad"), F.max(1 - F.col("toxic")).alias("good"))
    words = once.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter(F.col("bad") >= LEAST_CONTEXTS)
    counts = once.agg(F.sum("bad"), F.sum("good")).first()
    if not counts[0] or not counts[1]:
        return Model({}, (0.0,) * FEATURES + (-3.0,))
    odds = F.log((F.col("bad") + 0.5) / float(counts[0])) - F.log((F.col("good") + 0.5) / float(counts[1]))
    found = words.select("word", odds.alias("odds")).filter(F.col("odds") >= LEAST_ODDS).orderBy(F.desc("odds"), "word").collect()  # words of the sample
    entries = {r["word"]: round(r["odds"], 3) for r in found}
    model = Model({w: o for w, o in entries.items() if w[-1] != "*"}, (), {w[:-1]: o for w, o in entries.items() if w[-1] == "*"})

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(t, model) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([None if x is None else x.tolist() for x in got], pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    pairs = sample.filter("half = 1").select("text", "toxic").mapInArrow(measured, "x array<double>, toxic int").groupBy("x", "toxic").count().collect()
    if not pairs:
        return Model(model.insults, (0.0,) * FEATURES + (-3.0,), model.stems)
    x = np.array([r["x"] or [0.0] * FEATURES for r in pairs])
    y, times = np.array([r["toxic"] for r in pairs]), np.array([r["count"] for r in pairs])
    return Model(model.insults, fit_weights(x, y, times), model.stems)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row; a null or empty text matches nothing, a very long one is read whole. Repeated rows stay. An empty table gives an empty table, other columns are dropped."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [probability(features(t.as_py(), model), model.weights) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=[key, "score"])

    return docs.select(key, text).mapInArrow(scored, StructType([StructField(key, docs.schema[key].dataType), StructField("score", DoubleType())]))


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below the threshold, all columns as they are: nulls, ties and repeated rows too. An empty table gives an empty table."""
    at = docs.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [probability(features(t.as_py(), model), model.weights) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
