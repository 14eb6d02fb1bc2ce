"""SimHash near-duplicates over a byte-position inverted index with count filtering.

A fingerprint has 8 positional bytes. Two that differ in at most `distance` = 2 bits share at least 6 of
them, and so at least 2 of the 4 aligned byte pairs: the index has a posting per two byte pairs (32 bits
of the fingerprint, 6 postings each), which every linked pair shares. Pairs that meet in a posting list
are tallied by their shared positional bytes, kept from 6 on, and verified by their differing bits.

Equal fingerprints are one entry. A posting list longer than `short` is not paired: its entries, which
share 32 bits already, are linked through midpoints, i.e. the entry itself and its 32 neighbours at one
bit: two entries have a common midpoint exactly if they differ in at most 2 bits. This takes 33 rows an
entry, whatever the length of the list, and loses no link.

Components come from alternating large-star and small-star steps over written tables.

The pipeline's stage asks for a similarity of texts instead of a number of bits, which 64 bits can't tell:
of two texts that share 80 % of their five-word shingles some 10 bits differ. `keep_one` therefore takes
40 fingerprints, of samples of a text's shingles, which are 320 positional bytes. The index has a posting
per eight of them, a whole fingerprint at its place, as a list by one byte would hold a 256th of all rows.
Entries that meet are then tallied by their shared positional bytes, in lists by place and value of a
byte, and kept from LEAST_SHARED on; pairs that are left are verified by their shingles themselves. Each
entry meets a leader first, then what is not connected yet meets all of its group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import MADE, cut, release, slices

#: Aligned byte pairs of a fingerprint, by their shift.
PAIRS = (0, 16, 32, 48)
DISTANCE = 2
LEAST_BYTES = 8 - DISTANCE
SHORT = 48


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of each word shingle, repeats included; one of the whole sequence if it is shorter, none without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space alone
    if not words:
        return np.array([], np.dtype("<u8"))
    n = max(1, len(words) - shingle + 1)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[starts[i] : stops[i + last]], 42) for i in range(n)], np.dtype("<u8"))


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the shingles' hashes, 0 for a text without words."""
    return _majority(shingle_hashes(text, shingle))


def with_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp): the fingerprint as a signed long."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 1):
                fps = np.array([fingerprint(t.as_py(), shingle) for t in rows.column(1)], np.uint64)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fps.view(np.int64))], names=[key, "fp"])

    return df.select(key, text).mapInArrow(made, T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("fp", T.LongType())]))


def _pair(fp: Column, shift: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(0xFFFF)


def shared_bytes(a: Column, b: Column) -> Column:
    """Number of equal positional bytes."""
    x = a.bitwiseXOR(b)
    return sum((F.when(F.shiftrightunsigned(x, 8 * i).bitwiseAND(0xFF) == 0, 1).otherwise(0) for i in range(1, 8)), F.when(x.bitwiseAND(0xFF) == 0, 1).otherwise(0))


def _midpoint_links(large: DataFrame) -> DataFrame:
    """Stars (a, b) over (t, k, fp, rest): entries of a list whose rests have a common midpoint, joined to the least entry at it."""
    near = F.concat(F.array(F.col("rest")), F.array(*[F.col("rest").bitwiseXOR(F.lit(1 << b)) for b in range(32)]))
    mids = large.select("t", "k", "fp", F.explode(near).alias("mid"))
    least = mids.groupBy("t", "k", "mid").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m")
    # at most 33 distinct rests meet in a midpoint of a list, so that this join has no hot key
    return mids.join(least, ["t", "k", "mid"]).filter(F.col("fp") != F.col("least")).select(F.col("least").alias("a"), F.col("fp").alias("b"))


def links(fps: DataFrame, short: int = SHORT) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (view, fp) of a view, whose closure is that of all links; midpoints may stand in as the smallest entry near them."""
    fp = F.col("fp")
    tables = list(enumerate(combinations(PAIRS, 2)))
    keyed = F.array(*[F.struct((F.col("view") * len(tables) + i).alias("t"), F.shiftleft(_pair(fp, x), 16).bitwiseOR(_pair(fp, y)).alias("k")) for i, (x, y) in tables])
    postings = fps.select("fp", F.explode(keyed).alias("p")).select("fp", "p.*")
    lists = cut(postings.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "lists")
    others = [tuple(p for p in PAIRS if p not in pair) for _, pair in tables]
    rest = F.element_at(F.array(*[F.shiftleft(_pair(fp, r), 16).bitwiseOR(_pair(fp, s)) for r, s in others]), (F.col("t") % len(tables) + 1).cast("int"))
    few = cut(postings.join(lists, ["t", "k"]).select("t", "k", "fp", rest.alias("rest"), "n"), "live")
    small = few.filter(F.col("n") <= short).select("t", "k", "fp")
    other = small.select(F.col("t").alias("t2"), F.col("k").alias("k2"), F.col("fp").alias("fp2"))
    met = small.join(other, (F.col("t") == F.col("t2")) & (F.col("k") == F.col("k2")) & (F.col("fp") < F.col("fp2")))
    kept = met.filter(shared_bytes(F.col("fp"), F.col("fp2")) >= LEAST_BYTES).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= DISTANCE)
    large = few.filter(F.col("n") > short)
    return kept.select(F.col("fp").alias("a"), F.col("fp2").alias("b")).union(_midpoint_links(large)).distinct()


#: The stage's rule: shared shingles as a share of all of two texts, as a fraction. Sampled views and shingles in each:
#: texts at the threshold have a view in common with a probability of 1 - (1 - 0.8 ** 6) ** 40, all but 1 in 190,000.
SIMILAR, SAMPLES, SAMPLED = (4, 5), 40, 6
#: Positional bytes, of 320, that a pair must share to be verified. Texts at the threshold share 127 on average, and
#: fewer than 40 once in 20 million times, mostly those without a view in common; at a similarity of 0.5 it is 30.
LEAST_SHARED = 40
#: Entries in a block of a group.
BLOCK = 256


def _turns() -> np.ndarray:
    return np.random.default_rng(6).integers(0, 2**63, SAMPLES * SAMPLED, np.uint64) * np.uint64(2) + np.uint64(1)


def sampled_views(shingles: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """SimHash fingerprints of samples of a text's distinct shingles, as signed longs: a sample is the least shingle under each of six hash orders."""
    least = np.full(len(turns), 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        least = np.minimum(least, (shingles[None, at : at + 1024] * turns[:, None]).min(axis=1))
    # back from products, whose leading bits are zero the more shingles there are, to the shingles that were least
    back = turns.copy()
    for _ in range(5):
        back *= np.uint64(2) - turns * back
    least *= back
    bits = np.unpackbits(least.view(np.uint8).reshape(SAMPLES, SAMPLED, 8), axis=2, bitorder="little").sum(axis=1, dtype=np.int64)
    return np.packbits(bits * 2 > SAMPLED, axis=1, bitorder="little").view(np.int64).ravel()


def postings_of(entries: DataFrame) -> DataFrame:
    """(k, id, least) of entries (id, views) that share the eight bytes of a view at one place, which k stands for, with another one; least is the least of them."""
    placed = entries.select("id", F.posexplode("views").alias("at", "view"))
    postings = placed.select("id", F.xxhash64("at", "view").alias("k"))
    # written, so that the planner joins by its size: without moving postings, or with long lists split
    lists = cut(postings.groupBy("k").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("least")).filter("m > 1").drop("m"), "lists")
    return cut(postings.join(lists, "k"), "postings")


def stars(postings: DataFrame) -> DataFrame:
    """Edges (a, b) from the least entry of each list to its others."""
    return postings.filter("id != least").select(F.col("least").alias("a"), F.col("id").alias("b"))


def leaders_of(postings: DataFrame) -> DataFrame:
    """(a, b): of the least entries of the lists of b that one, a, which most of them have, ties to the least."""
    tally = stars(postings).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    return tally.groupBy("b").agg(F.min(F.struct(-F.col("n"), "a")).alias("x")).select(F.col("x.a").alias("a"), "b")


def tallies(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each of the sets `left` the number of members that it shares with each of `right`, counted in lists by member."""
    order = np.argsort(members := np.concatenate(right), kind="stable")
    members, owner = members[order], np.repeat(np.arange(len(right)), [len(s) for s in right])[order]
    for s in left:
        first = np.searchsorted(members, s, "left")
        many = np.searchsorted(members, s, "right") - first
        places = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        yield np.bincount(owner[places], minlength=len(right))


def positional_bytes(views: np.ndarray) -> np.ndarray:
    """The bytes of each row of views, each with its place: place * 256 + value."""
    values = np.ascontiguousarray(views, np.dtype("<i8")).view(np.uint8).reshape(len(views), -1)
    return np.arange(values.shape[1], dtype=np.int32) * 256 + values


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of `left` the places in `right` of sets with a Jaccard similarity of SIMILAR or more, by counting all shared members."""
    sizes = np.array([len(s) for s in right], np.int64)
    for i, (s, shared) in enumerate(zip(left, tallies(left, right))):
        yield i, np.flatnonzero(shared * SIMILAR[1] >= (len(s) + sizes - shared) * SIMILAR[0])


def _compare(shingle: int):
    """Rows (block, id, comp, text, views) of a cell to edges (a, b): all pairs of its two blocks (or of its one) are tallied by their positional bytes; those with LEAST_SHARED or more are compared. Rows of one comp are connected already."""

    def cell(rows: pa.Table) -> pa.Table:
        ids, blocks, comps = (rows.column(c).to_numpy() for c in ("id", "block", "comp"))
        low, high = np.flatnonzero(blocks == blocks.min()), np.flatnonzero(blocks == blocks.max())
        placed = positional_bytes(rows.column("views").combine_chunks().flatten().to_numpy().reshape(len(ids), SAMPLES))
        passed = np.array([shared >= LEAST_SHARED for shared in tallies(list(placed[low]), list(placed[high]))])
        passed &= comps[low][:, None] != comps[high][None, :]
        # texts without such a pair are not looked at
        low, high, passed = low[one := passed.any(axis=1)], high[two := passed.any(axis=0)], passed[one][:, two]
        texts = rows.column("text")
        sets = {x: np.unique(shingle_hashes(texts[x].as_py(), shingle)) for x in np.union1d(low, high).tolist()}
        root = np.unique(comps, return_index=True)[1][np.unique(comps, return_inverse=True)[1]].tolist()
        edges = []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, near in similar_pairs([sets[x] for x in low.tolist()], [sets[y] for y in high.tolist()]) if len(low) else ():
            for j in near[passed[i, near]]:
                x, y = find(int(low[i])), find(int(high[j]))
                if x != y:  # what is connected already needs no further edge
                    root[y] = x
                    edges.append((ids[low[i]], ids[high[j]]))
        return pa.table([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return cell


def weight(text: Column) -> Column:
    """What a text counts for in a block: one, and one more for every 8 KB."""
    return F.lit(1) + F.floor(F.coalesce(F.octet_length(text), F.lit(0)) / 8192)


def led(texts: DataFrame, leaders: DataFrame, shingle: int, block: int) -> DataFrame:
    """Edges (a, b) of (id, text, views) and (a, b): entries b whose text is similar to that of their leader a. A leader's text goes once to each block of its entries."""
    own = texts.select("id", "text", "views", weight(F.col("text")).alias("w"))
    members = leaders.join(own, F.col("b") == F.col("id")).select("a", "b", "text", "views", "w")
    sizes = leaders.join(own.select("id", "w"), F.col("b") == F.col("id")).groupBy("a").agg(F.ceil(F.sum("w") / block).alias("blocks"))
    placed = members.join(sizes, "a").select("a", F.pmod(F.xxhash64("b", F.lit(3)), F.col("blocks")).cast("int").alias("at"), F.lit(1).alias("block"), F.col("b").alias("id"), F.col("b").alias("comp"), "text", "views")
    heads = sizes.join(own, F.col("a") == F.col("id")).select("a", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("at"), F.lit(0).alias("block"), "id", F.col("id").alias("comp"), "text", "views")
    return placed.unionByName(heads).groupBy("a", "at").applyInArrow(_compare(shingle), "a long, b long")


def cells_of(rows: DataFrame, block: int) -> DataFrame:
    """Rows (root, low, high, block, id, comp) of (root, id, comp, w): any two rows of a root and different comps meet in one cell.

    A comp of over `block` has blocks of its own, which need not meet each other; the others share blocks by comp.
    """
    large = rows.groupBy("root", "comp").agg(F.sum("w").alias("own")).withColumn("kind", F.when(F.col("own") > block, F.col("comp")))
    kinds = large.groupBy("root", "kind").agg(F.ceil(F.sum("own") / block).cast("int").alias("blocks"))
    # a row per large comp of a root, and one for all others
    by_root = Window.partitionBy("root")
    kinds = kinds.withColumn("first", F.sum("blocks").over(by_root.orderBy(F.col("kind").asc_nulls_first())) - F.col("blocks")).withColumn("all", F.sum("blocks").over(by_root))
    kinds = kinds.filter("all > 1 OR kind IS NULL").toDF("k_root", "k_kind", "blocks", "first", "all")
    placed = rows.join(large.select("root", "comp", "kind"), ["root", "comp"]).join(kinds, (F.col("root") == F.col("k_root")) & F.col("kind").eqNullSafe(F.col("k_kind")))
    at = F.pmod(F.xxhash64(F.when(F.col("kind").isNull(), F.col("comp")).otherwise(F.col("id")), F.lit(3)), F.col("blocks"))
    placed = placed.withColumn("block", (F.col("first") + at).cast("int"))
    others = F.filter(F.sequence(F.lit(0), (F.col("all") - 1).cast("int")), lambda b: F.col("kind").isNull() | (b < F.col("first")) | (b >= F.col("first") + F.col("blocks")))
    spread = placed.withColumn("with", F.explode(others))
    return spread.select("root", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "id", "comp")


def similar_components(postings: DataFrame, texts: DataFrame, shingle: int, block: int = BLOCK) -> DataFrame:
    """(node, root) of entries that are connected over pairs with a similarity of SIMILAR or more, of their lists (k, id, least) and (id, text, views).

    First each entry is held against one leader, of the least entries of its lists that of most lists: a row
    an entry, however long the list. What a leader connects need not be compared again. Lists all of whose
    entries are connected are done with; in each of the others, all entries that are not yet connected to
    each other are tallied, long lists in cells of two blocks, and compared if they share LEAST_SHARED
    positional bytes, as those with a leader are. Pairs without a common list never meet.
    Lists of the same entries, which near copies make many of, are compared once.
    """
    made = len(MADE)
    leaders = cut(leaders_of(postings), "leaders")
    near = cut(led(texts, leaders, shingle, block), "led")
    joined = cut(components(near), "joined")
    marked = cut(postings.join(joined, F.col("id") == F.col("node"), "left").select("k", "id", "least", F.coalesce("root", "id").alias("comp")), "marked")
    undone = cut(marked.groupBy("k").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("k"), "undone")
    open_lists = cut(marked.join(undone, "k"), "open")
    sets = open_lists.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    distinct = cut(sets.groupBy("n", "x", "y").agg(F.min("k").alias("k")).select("k"), "sets")
    rows = open_lists.join(distinct, "k").join(texts.select("id", weight(F.col("text")).alias("w")), "id").select(F.col("k").alias("root"), "id", "comp", "w")
    cells = cut(cells_of(cut(rows, "groups"), block), "cells")
    more = cells.join(texts, "id").groupBy("root", "low", "high").applyInArrow(_compare(shingle), "a long, b long")
    out = components(near.union(cut(more, "compared")))
    release(postings.sparkSession, MADE[made:-1])
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for all nodes that have an edge (a, b)."""
    spark, made = edges.sparkSession, len(MADE)
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        lows = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
        large = cut(both.join(lows, "u").filter("v > u AND v != low").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "large")
        lows = large.groupBy("u").agg(F.min("v").alias("low"))
        step = large.join(lows, "u")
        small = step.filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v")).union(step.select("u", F.col("low").alias("v")))
        edges = cut(small.distinct(), "small")
        release(spark, MADE[made:-1])
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def classes(fingerprinted: DataFrame, key: str = "doc_id", short: int = SHORT) -> DataFrame:
    """(fp, root, component_id) of each fingerprint in a written table of (key, fp)."""
    entries = cut(fingerprinted.groupBy("fp").agg(F.min(key).alias("least")), "entries")
    roots = components(links(entries.select(F.lit(0).alias("view"), "fp"), short))
    found = cut(entries.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "classes")
    return found.join(found.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", short: int = SHORT, shingle: int = 3) -> DataFrame:
    """(key, fp, component_id): component_id is the smallest key reachable over links, itself included.

    A null or word-less text has fingerprint 0 and links like any other. A row with a null key gets the
    smallest non-null key of its component, null if there is none. Repeated rows stay. A very long text
    counts with all its shingles. An empty table gives an empty table. Other columns are dropped.
    """
    made = len(MADE)
    docs = cut(with_fingerprints(df, key, text, shingle), "fingerprints")
    ids = cut(classes(docs, key, short), "components")
    release(df.sparkSession, MADE[made + 1 : -1])
    return docs.join(ids, "fp").select(key, "fp", "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, block: int = BLOCK) -> DataFrame:
    """One row of each component of texts with a similarity of 0.8 or more, all columns as they are: that of the smallest key; without any key, some row.

    The similarity is that of the sets of shingles (Jaccard). Null and word-less texts are copies of each other and like no other text.
    Of rows with the smallest key and the same shingles some one stays; rows with one key and other shingles are rows of their own.
    A very long text counts with all its shingles. An empty table gives an empty table. Names that begin with two underscores are reserved.
    """
    at = df.columns.index(text)

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        turns = _turns()
        for batch in batches:
            for rows in slices(batch, at):
                sets = [np.unique(shingle_hashes(t.as_py(), shingle)) for t in rows.column(at)]
                ids = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                views = [sampled_views(s, turns) if len(s) else [] for s in sets]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids), pa.array(views, pa.list_(pa.int64()))], names=[*rows.schema.names, "__id", "__views"])

    added = [T.StructField("__id", T.LongType()), T.StructField("__views", T.ArrayType(T.LongType()))]
    made = len(MADE)
    docs = cut(df.mapInArrow(beside, T.StructType([*df.schema.fields, *added])), "fingerprints")
    # entries: distinct sets of shingles
    entries = cut(docs.groupBy(F.col("__id").alias("id")).agg(F.min(key).alias("least"), F.min("__views").alias("views")), "entries")
    # names that no column of the documents has
    own = (F.col("__id") == F.col("__entry")) & F.col(key).eqNullSafe(F.col("__least"))
    postings = postings_of(entries)
    met = postings.select("id").distinct().join(entries, "id").select(F.col("id").alias("__entry"), F.col("least").alias("__least"))
    texts = cut(docs.join(met, own).select("__entry", F.col(text), "__views").toDF("id", "text", "views").dropDuplicates(["id"]), "texts")
    roots = similar_components(postings, texts, shingle, block)
    found = cut(entries.join(roots, F.col("id") == F.col("node"), "left").select("id", "least", F.coalesce("root", "id").alias("root")), "classes")
    release(df.sparkSession, MADE[made + 1 : -1])  # all but the rows with their entries, and the classes
    # the entry that has the smallest key of its component, null last
    first = found.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "id")).alias("x")).select(F.col("x.id").alias("__entry"), F.col("x.least").alias("__least"))
    kept = docs.join(first, own, "left_semi")
    if not docs.groupBy("__id", key).count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["__id"])
    return kept.select(*df.columns)


def query(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
