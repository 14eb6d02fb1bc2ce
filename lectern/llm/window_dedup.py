"""Removal of repeated passages: Rabin-Karp hashes of every window of `SPAN` words, counted in Spark.

A word goes if a window over it also starts in a document with a smaller id. The rolling hash of words
i..j is the difference of two prefix sums times a power of the base, modulo 2**64, so that the hashes of
all windows of a batch are a few array operations.

A row for each word of the corpus is more than it takes, since most windows are alone. Every window has
one anchor, the GRAM words in it with the least rolling hash, the leftmost of equals; equal windows have
equal anchors at the same offset. Neighbouring windows mostly share theirs: they are an entry, one for
some 18 words, known by its anchor and by the rolling hash of all its words. Counting goes from coarse to
fine, each time with the least and the greatest document of a key, combined before rows move:

1. anchors: those that one document alone has are done, and their windows with them;
2. entries, of anchors with several: where a smaller document has the entry, all its windows go;
3. windows, of the entries that are left (each in its least document): hashed one by one and counted.

Windows found in 2 and 3 merge into maximal intervals of words, which are cut out. Windows are told
apart by 128 bits (their anchor's and their own hash).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, cut, slices, table

SPAN, GRAM = 50, 16
_BASE = 0x9E3779B97F4A7C15
_MIX, _SALT = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _MIX
    x = (x ^ x >> np.uint64(27)) * _SALT
    return x ^ x >> np.uint64(31)


@lru_cache(maxsize=2)
def _powers(base: int, bits: int) -> np.ndarray:
    """The first 2 ** bits powers of the base."""
    factors = np.full(1 << bits, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


class Rolling:
    """Rolling hashes over the words of some texts, laid end to end; text i has the words bounds[i] to bounds[i + 1]."""

    def __init__(self, texts: pa.Array):
        import xxhash

        lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        known = coded.dictionary.to_pylist()
        own = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in known), np.uint64, len(known))
        codes = coded.indices.to_numpy()
        real = np.fromiter((w != "" for w in known), bool, len(known))[codes]
        self.bounds = np.concatenate([[0], np.cumsum(real)])[ends]
        self.words = own[codes[real]]
        bits = max(12, len(self.words).bit_length())
        self.powers, back = _powers(_BASE, bits), _powers(pow(_BASE, -1, 1 << 64), bits)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.words * back[: len(self.words)], dtype=np.uint64)])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the words first to last (exclusive)."""
        return _mixed((self.sums[last] - self.sums[first]) * self.powers[last])

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows with one anchor: first window, last window, anchor; windows never cross texts."""
        n = len(self.words)
        none = np.array([], np.int64)
        if n < SPAN:
            return none, none, none
        inside = np.zeros(n - SPAN + 1, bool)
        for start, end in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True):
            inside[start : max(start, end - SPAN + 1)] = True
        grams = np.arange(n - GRAM + 1)
        hashes = self.of(grams, grams + GRAM)
        found = [(none, none, none)]
        for at in range(0, len(inside), _STEP):
            least = hashes[at : at + _STEP + SPAN - GRAM]
            least = least & ~_PLACE | np.arange(len(least), dtype=np.uint64)
            width, need = 1, SPAN - GRAM + 1
            while width < need:
                by = min(width, need - width)
                least = np.minimum(least[:-by], least[by:])
                width += by
            window = np.flatnonzero(inside[at : at + len(least)])
            if len(window):
                anchor = (least[window] & _PLACE).astype(np.int64)
                breaks = np.flatnonzero((np.diff(window) != 1) | (np.diff(anchor) != 0))
                first, last = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(window) - 1]])
                found.append((window[first] + at, window[last] + at, anchor[first] + at))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def entries(docs: DataFrame) -> DataFrame:
    """(id, twin, gram, entry, first, last) of (id, twin, text): the windows first to last of a text share the anchor `gram`; entry tells their words and the anchor's place."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 2):
                roll = Rolling(rows.column(2))
                first, last, anchor = roll.entries()
                owner = np.searchsorted(roll.bounds, first, side="right") - 1
                gram = roll.of(anchor, anchor + GRAM)
                shape = (anchor - first + (last - first << 6)).astype(np.uint64)
                entry = _mixed(roll.of(first, last + SPAN) + _mixed(shape))
                begin = roll.bounds[owner]
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(owner)), rows.column(1).take(pa.array(owner)), _signed(gram), _signed(entry), pa.array((first - begin).astype(np.int32)), pa.array((last - begin).astype(np.int32))], names=["id", "twin", "gram", "entry", "first", "last"])

    return docs.select("id", "twin", "text").mapInArrow(made, "id long, twin long, gram long, entry long, first int, last int")


def shared_runs(found: DataFrame) -> DataFrame:
    """(id, twin, runs) of written entries: runs of windows that all go (open false), or of which each has to be counted (open true)."""
    least, most = F.min("id").alias("least"), F.max("id").alias("most")
    grams = found.groupBy("gram").agg(least, most, (F.min("entry") == F.max("entry")).alias("alike")).filter("least < most").drop("most")
    live = cut(found.join(cut(grams, "grams"), "gram"), "live")
    several = live.filter("NOT alike").groupBy("gram", "entry").agg(F.min("id").alias("own_least"))
    # written, so that the planner can split an entry that very many texts have
    known = live.join(cut(several, "several"), ["gram", "entry"], "left").withColumn("open", F.coalesce("own_least", "least") >= F.col("id")).filter("NOT (open AND alike)")
    return known.groupBy("id", "twin").agg(F.collect_set(F.struct("gram", "first", "last", "open")).alias("runs"))


def intervals(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal intervals of stretches of words, ascending; those that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]])) if len(starts) else np.array([], np.int64)
    return list(zip(starts[new].tolist(), reach[np.append(new[1:] - 1, len(reach) - 1)].tolist() if len(new) else [], strict=True))


def _without(text: str | None, spans: list[tuple[int, int]], keep_text: bool) -> tuple[int, int, list[dict], str, str | None]:
    """Number of words, number removed, spans, digest and text of what is kept."""
    words = (text or "").encode("utf-8", "surrogatepass").split()  # bytes: ASCII white space alone
    n = len(words)
    for start, end in reversed(spans):
        del words[start:end]
    kept = b" ".join(words)
    return n, n - len(words), [{"start": a, "end": b} for a, b in spans], hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if keep_text else None


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_DONE = [T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", _SPANS), T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.StringType())]
_OPEN = T.ArrayType(T.StructType([T.StructField("gram", T.LongType()), T.StructField("first", T.IntegerType()), T.StructField("hashes", T.ArrayType(T.LongType()))]))
_ARROW = {"spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), "kept_sha256": pa.string(), "kept": pa.string()}


def _done(rows: list[tuple]) -> list[pa.Array]:
    """Columns of _DONE but the id."""
    names = ("n_words", "n_removed", "spans", "kept_sha256", "kept")
    return [pa.array([r[i] for r in rows], _ARROW.get(c, pa.int64())) for i, c in enumerate(names)]


def first_cut(docs: DataFrame, runs: DataFrame, keep_text: bool) -> DataFrame:
    """Texts whose runs are all decided are done; of the others, `open` has the hashes of the windows to be counted, `text` the text, and spans what goes in any case."""
    begun, n_open = F.filter("runs", lambda r: ~r["open"]), F.filter("runs", lambda r: r["open"])
    joined = docs.join(runs, ["id", "twin"], "left").select("id", "twin", "text", *[F.coalesce(F.transform(x, lambda r: r[c]), F.array().cast("array<long>")).alias(f"{s}_{c}") for s, x in (("cut", begun), ("open", n_open)) for c in ("gram", "first", "last")])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 2):
                column = {c: rows.column(i) for i, c in enumerate(rows.schema.names)}
                many = pc.list_value_length(column["open_first"]).to_numpy()
                texts = column["text"].to_pylist()
                done = []
                for text, first, last, wait in zip(texts, column["cut_first"].to_pylist(), column["cut_last"].to_pylist(), many.tolist(), strict=True):
                    spans = intervals(np.array(first, np.int64), np.array(last, np.int64) + SPAN)
                    done.append((None, None, [{"start": a, "end": b} for a, b in spans], None, None) if wait else _without(text, spans, keep_text))
                waiting = np.flatnonzero(many)
                roll = Rolling(column["text"].take(pa.array(waiting)))
                first, last = (column[c].flatten().to_numpy().astype(np.int64) for c in ("open_first", "open_last"))
                sizes = last - first + 1
                before = np.cumsum(sizes) - sizes
                start = np.repeat(first - before + roll.bounds[np.repeat(np.arange(len(waiting)), many[waiting])], sizes) + np.arange(int(sizes.sum()))
                hashes = pa.ListArray.from_arrays(pa.array(np.append(before, int(sizes.sum())).astype(np.int32)), _signed(roll.of(start, start + SPAN)))
                each = pa.StructArray.from_arrays([column["open_gram"].flatten(), pa.array(first.astype(np.int32)), hashes], ["gram", "first", "hashes"])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), each)
                left = pa.array([t if w else None for t, w in zip(texts, many.tolist(), strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([column["id"], *_done(done), column["twin"], left, lists], names=[*[f.name for f in _DONE], "twin", "text", "open"])

    return joined.mapInArrow(made, T.StructType([*_DONE, T.StructField("twin", T.LongType()), T.StructField("text", T.StringType()), T.StructField("open", _OPEN)]))


def repeated_windows(waiting: DataFrame) -> DataFrame:
    """(id, twin, places) of rows with open windows: those that a smaller id has too."""
    each = waiting.select("id", "twin", F.explode("open").alias("o")).select("id", "twin", "o.gram", "o.first", F.posexplode("o.hashes").alias("nth", "hash"))
    each = each.select("id", "twin", "gram", "hash", (F.col("first") + F.col("nth")).alias("place"))
    common = each.groupBy("gram", "hash").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").drop("most")
    hits = each.join(cut(common, "windows"), ["gram", "hash"]).filter("least < id")
    return hits.groupBy("id", "twin").agg(F.collect_set("place").alias("places"))


def last_cut(waiting: DataFrame, hits: DataFrame, keep_text: bool) -> DataFrame:
    joined = waiting.select("id", "twin", "text", "spans").join(hits, ["id", "twin"], "left")
    joined = joined.select("id", "text", F.col("spans.start").alias("start"), F.col("spans.end").alias("end"), F.coalesce("places", F.array().cast("array<int>")).alias("places"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1):
                done = []
                for text, start, end, places in zip(*(rows.column(i).to_pylist() for i in range(1, 5)), strict=True):
                    places = np.array(places, np.int64)
                    spans = intervals(np.concatenate([np.array(start, np.int64), places]), np.concatenate([np.array(end, np.int64), places + SPAN]))
                    done.append(_without(text, spans, keep_text))
                yield pa.RecordBatch.from_arrays([rows.column(0), *_done(done)], names=[f.name for f in _DONE])

    return joined.mapInArrow(made, T.StructType(_DONE))


def remove_repeated_windows(df: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """(key, n_words, n_removed, spans, kept_sha256, kept) of each row: spans are the removed intervals of words, kept the others joined by one space (null without keep_text).

    Words are separated by ASCII white space, null counts as empty. Rows with equal keys take nothing
    from each other; a null key is neither smaller nor greater than any, so that its row stays whole and
    takes nothing from others. Identical rows have equal results. Texts of fewer than SPAN words stay
    whole. A very long text is one row of a batch by itself; its windows are hashed in stretches. An
    empty table gives an empty table. Other columns are dropped, whatever their names.
    """
    docs = df.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("twin"), F.col(text).alias("text"))
    found = cut(entries(docs.filter("id IS NOT NULL")), "entries")
    begun = cut(first_cut(docs, cut(shared_runs(found), "runs"), keep_text), "begun")
    waiting = begun.filter("text IS NOT NULL")
    done = begun.filter("text IS NULL").select(*[f.name for f in _DONE])
    return done.union(last_cut(waiting, repeated_windows(waiting), keep_text)).withColumnRenamed("id", key)


def query(spark, sf_dir: str) -> DataFrame:
    out = remove_repeated_windows(table(spark, sf_dir, "documents"), keep_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
p AS (SELECT r, doc_id, w, unnest(range(1, len(w) - {SPAN - 2})) AS p FROM d),
g AS (SELECT r, doc_id, p, array_to_string(w[p:p + {SPAN - 1}], ' ') AS g FROM p),
low AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT r, unnest(range(p, p + {SPAN})) AS i FROM g JOIN low USING (g) WHERE low.low < g.doc_id),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS w FROM d),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""
