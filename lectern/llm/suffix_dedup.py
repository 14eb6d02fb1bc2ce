"""Removal of repeated passages over a range-partitioned, sparse suffix array.

A byte goes if a `SPAN`-byte string over it also starts in a document with a smaller id. Sorting every
suffix would move dozens of bytes for each byte of text, so the array is sparse. Every SPAN-byte window
has one anchor: the place in it of the GRAM-byte string with the least hash, the leftmost of equals. It
depends on the window's bytes alone, so that equal windows have their anchors at the same offset. About
one suffix in 18 starts at an anchor and is kept, with the bytes to its left that its windows reach.

1. Documents are dealt into blocks. A block finds its anchors; equal entries become one with the least
   and the greatest document id, so that hot passages shrink before anything moves.
2. Entries whose leading GRAM bytes no other document has cannot matter. Blocks send 40-bit hashes of
   these alone, and learn which ones another block has too (a clash keeps an entry in vain, no more).
3. Splitters sampled from leading 8-byte tokens range-partition the entries into buckets. A bucket sorts
   its suffixes, and their reversed left contexts, by multikey quicksort over 8-byte tokens and compares
   neighbours. Equal leading tokens never straddle a splitter, and windows are compared only between
   suffixes that share their leading GRAM bytes; so no pair of neighbours is cut apart by a boundary.
4. For every window the bucket knows the least document id that has it. Stretches of windows that some
   smaller document has are answered to the blocks, which mark the bytes they cover.

Documents' texts go through one exchange, read by steps 1, 3 and 4.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered

SPAN, GRAM = 50, 16
#: Bytes to the left of an anchor that its windows can reach; bytes of an entry, padded to whole tokens with its two offsets.
LEFT = SPAN - GRAM
ENTRY, WIDTH = LEFT + SPAN, 88
_STEP = 1 << 18
_POSITION = np.uint64((1 << 20) - 1)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
NEVER = np.iinfo(np.int64).max


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, last window, anchor (positions in data); windows never cross documents."""
    if len(data) < SPAN:
        return (np.array([], np.int64),) * 3
    inside = np.ones(len(data), bool)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        inside[max(start, end - SPAN + 1) : end] = False
    found: list[tuple] = []
    for at in range(0, len(data) - SPAN + 1, _STEP):
        x = data[at : at + _STEP + SPAN - 1].astype(np.uint64)
        for by in (1, 2, 4):  # little-endian 8-byte tokens at every place
            x = x[:-by] | x[by:] << np.uint64(8 * by)
        least = x[: 8 - GRAM] * _A + x[GRAM - 8 :] * _B
        least = (least ^ least >> np.uint64(29)) * _C
        least = (least & ~_POSITION) | np.arange(len(least), dtype=np.uint64)
        width, need = 1, SPAN - GRAM + 1
        while width < need:
            by = min(width, need - width)
            least = np.minimum(least[:-by], least[by:])
            width += by
        window = np.flatnonzero(inside[at : at + len(least)])
        anchor = (least[window] & _POSITION).astype(np.int64)
        if len(window):
            breaks = np.flatnonzero((np.diff(window) != 1) | (np.diff(anchor) != 0))
            first, last = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(window) - 1]])
            found.append((window[first] + at, window[last] + at, anchor[first] + at))
    if not found:
        return (np.array([], np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Block:
    """Documents of a block in ascending order of id and text, and their deduplicated suffix entries."""

    def __init__(self, table: pa.Table):
        table = table.select(["doc_id", "text"]).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.keys = table.column("doc_id").to_pylist()
        text = table.column("text").cast(pa.large_binary())
        text = text.combine_chunks() if text.num_chunks != 1 else text.chunk(0)
        text = pc.fill_null(text, b"") if text.null_count else text
        _, offsets, data = text.buffers()
        self.offsets = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        base = self.offsets[0]
        self.data = np.frombuffer(data, np.uint8)[base : self.offsets[-1]] if data is not None else np.array([], np.uint8)
        self.offsets = self.offsets - base

    def entries(self) -> None:
        """Sets rows (distinct entries in the order of their leading token), low, high (ids), lead, and the places that each entry stands for."""
        known = sum(k is not None for k in self.keys)  # null ids sort last; they are neither smaller nor greater than any
        ids = np.array(self.keys[:known], np.int64)
        first, last, anchor = anchors(self.data[: self.offsets[known]], self.offsets[: known + 1])
        doc = np.searchsorted(self.offsets[: known + 1], first, side="right") - 1
        rows = np.zeros((len(anchor), WIDTH), np.uint8)
        column = np.arange(-LEFT, SPAN, dtype=np.int64)[None, :]
        for at in range(0, len(anchor), 8192):
            a, f, z = (v[at : at + 8192, None] for v in (anchor, first, last))
            place = a + column
            rows[at : at + 8192, :ENTRY] = self.data[np.clip(place, 0, len(self.data) - 1)] * ((place >= f) & (place < z + SPAN))
        rows[:, ENTRY], rows[:, ENTRY + 1] = anchor - last, anchor - first
        tokens = rows.view("<u8")
        mixed = np.zeros(len(rows), np.uint64)
        for i in range(WIDTH // 8):
            mixed = (mixed ^ tokens[:, i]) * _A
            mixed ^= mixed >> np.uint64(31)
        order = np.argsort(mixed, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = mixed[order[1:]] != mixed[order[:-1]]
        same = np.flatnonzero(~new)
        new[same] = (tokens[order[same]] != tokens[order[same - 1]]).any(axis=1)
        starts = np.flatnonzero(new)
        lead = _tokens(rows[order[starts]], LEFT, 1)[:, 0]
        rank = np.argsort(lead, kind="stable")
        self.lead, self.rows = lead[rank], rows[order[starts[rank]]]
        owner = ids[doc[order]] if len(order) else np.array([], np.int64)
        self.low = (np.minimum.reduceat(owner, starts) if len(starts) else owner)[rank]
        self.high = (np.maximum.reduceat(owner, starts) if len(starts) else owner)[rank]
        self.first_place, self.places = starts[rank], np.diff(np.append(starts, len(order)))[rank]
        self.place_anchor, self.place_id = anchor[order], owner

    def gram_hashes(self) -> np.ndarray:
        """40 bits of a hash of each entry's leading GRAM bytes."""
        grams, mixed = _tokens(self.rows, LEFT, GRAM // 8), np.zeros(len(self.rows), np.uint64)
        for i in range(grams.shape[1]):
            mixed = (mixed ^ grams[:, i]) * _A
            mixed ^= mixed >> np.uint64(29)
        return (mixed * _C) >> np.uint64(24)


def _tokens(rows: np.ndarray, at: int, n: int) -> np.ndarray:
    """n big-endian 8-byte tokens from column `at` on, zeros after the last column."""
    part = np.zeros((len(rows), 8 * n), np.uint8)
    have = min(8 * n, rows.shape[1] - at)
    part[:, :have] = rows[:, at : at + have]
    return part.view(">u8").astype(np.uint64)


def multikey_order(tokens: np.ndarray) -> np.ndarray:
    """The order of rows of tokens: sorted by the first, and only runs of equals by the next, and so on."""
    order = np.argsort(tokens[:, 0], kind="stable")
    tied = np.arange(len(order))
    run = np.zeros(len(order), np.int64)
    run[1:] = np.cumsum(tokens[order[1:], 0] != tokens[order[:-1], 0])
    for depth in range(1, tokens.shape[1]):
        size = np.bincount(run)
        keep = size[run] > 1
        tied, run = tied[keep], run[keep]
        if not len(tied):
            break
        column = tokens[order[tied], depth]
        inner = np.lexsort((column, run))
        order[tied] = order[tied][inner]
        column = column[inner]
        run = np.concatenate([[0], np.cumsum((column[1:] != column[:-1]) | (run[1:] != run[:-1]))])
    return order


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix lengths of neighbours in the order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for at in range(1, len(order), 16384):
        here = order[at : at + 16384]
        differ = rows[here] != rows[order[at - 1 : at - 1 + len(here)]]
        out[at : at + len(here)] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def least_ids(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches (row, from, to, id): windows that begin from..to bytes before the row's anchor are in document `id` < high too."""
    right, left = rows[:, LEFT:ENTRY], np.ascontiguousarray(rows[:, LEFT - 1 :: -1] if LEFT else rows[:, :0])
    orders = [multikey_order(_tokens(part, 0, -(-part.shape[1] // 8))) for part in (right, left)]
    commons = [_common(part, order) for part, order in zip((right, left), orders, strict=True)]
    least = np.full((len(rows), LEFT + 2), NEVER, np.int64)
    name = np.empty(len(rows), np.int64)
    for j in range(LEFT + 1):
        use = np.flatnonzero((rows[:, ENTRY] <= j) & (j <= rows[:, ENTRY + 1]))
        if len(use) < 1:
            continue
        key = np.zeros(len(use), np.int64)
        for length, order, common in ((SPAN - j, orders[0], commons[0]), (j, orders[1], commons[1])):
            name[order] = np.cumsum(common < length)
            key = key * (len(rows) + 1) + name[use]
        order = np.argsort(key, kind="stable")
        key, use = key[order], use[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        found = np.repeat(np.minimum.reduceat(low[use], starts), np.diff(np.append(starts, len(use))))
        least[use, j] = np.where(found < high[use], found, NEVER)
    changes = np.ones(least.shape, bool)
    changes[:, 1:] = least[:, 1:] != least[:, :-1]
    row, start = np.nonzero(changes)
    value = least[row, start]
    end = np.append(start[1:], 0) - 1  # the last column is NEVER, so that every other run ends in its row
    keep = value != NEVER
    return row[keep], start[keep], end[keep], value[keep]


def _squeezed(*parts: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(p).tobytes() for p in parts))


def _raw(blob: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(blob)


def _opened(blob: bytes, *kinds: tuple[str, int]) -> list[np.ndarray]:
    """Arrays of equal row counts: (type, columns) each."""
    data = _raw(blob)
    n = len(data) // sum(np.dtype(k).itemsize * c for k, c in kinds)
    out, at = [], 0
    for kind, columns in kinds:
        out.append(np.frombuffer(data, kind, n * columns, at).reshape(n, columns) if columns > 1 else np.frombuffer(data, kind, n, at))
        at += n * columns * np.dtype(kind).itemsize
    return out


_ENTRIES = (("u1", WIDTH), ("<i8", 1), ("<i8", 1), ("<u4", 1))
_ANSWERS = (("<u4", 1), ("u1", 1), ("u1", 1), ("<i8", 1))


def _shares(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of each bucket's share of sorted 40-bit hashes."""
    edges = (np.arange(buckets + 1, dtype=np.uint64) << np.uint64(40)) // np.uint64(buckets)
    return np.searchsorted(hashes, edges)


def _announce(buckets: int):
    def announce(table: pa.Table) -> pa.Table:
        """Step 2 at a block: its distinct gram hashes, dealt by range, as planes of the bytes of their differences."""
        block = Block(table)
        block.entries()
        hashes = np.unique(block.gram_hashes())
        bounds = _shares(hashes, buckets)
        full = np.flatnonzero(np.diff(bounds))
        planes = [np.diff(hashes[bounds[b] : bounds[b + 1]], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, :5].T for b in full.tolist()]
        return pa.table({"bucket": pa.array(full, pa.int64()), "block": pa.array([table.column("block")[0].as_py()] * len(full), pa.int64()), "grams": pa.array(map(_squeezed, planes), pa.binary())})

    return announce


def meet(table: pa.Table) -> pa.Table:
    """Step 2 at a bucket: of each block's hashes, in their order, which ones another block has."""
    each = []
    for blob in table.column("grams").to_pylist():
        planes = np.frombuffer(_raw(blob), np.uint8).reshape(5, -1)
        wide = np.zeros((planes.shape[1], 8), np.uint8)
        wide[:, :5] = planes.T
        each.append(np.cumsum(wide.view("<u8")[:, 0], dtype=np.uint64))
    everything = np.concatenate(each)
    order = np.argsort(everything, kind="stable")
    equal = everything[order[1:]] == everything[order[:-1]]
    common = np.zeros(len(order), bool)
    common[order[1:]] |= equal
    common[order[:-1]] |= equal
    ends = np.cumsum([len(x) for x in each])
    bits = [np.packbits(common[e - len(x) : e]).tobytes() for x, e in zip(each, ends.tolist(), strict=True)]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _send(splitters: np.ndarray, buckets: int):
    def send(docs: pa.Table, met: pa.Table) -> pa.Table:
        """Step 3 at a block: the entries that matter, dealt by their leading token."""
        block = Block(docs)
        block.entries()
        hashes, which = np.unique(block.gram_hashes(), return_inverse=True)
        bounds = _shares(hashes, buckets)
        common = np.zeros(len(hashes), bool)
        for bucket, bits in zip(met.column("bucket").to_pylist(), met.column("bits").to_pylist(), strict=True):
            lo, hi = bounds[bucket], bounds[bucket + 1]
            common[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
        low, high = np.full(len(hashes), NEVER, np.int64), np.full(len(hashes), -NEVER, np.int64)
        np.minimum.at(low, which, block.low)
        np.maximum.at(high, which, block.high)
        kept = np.flatnonzero((common | (low < high))[which]) if len(which) else np.array([], np.int64)
        bounds = np.concatenate([[0], np.searchsorted(block.lead[kept], splitters), [len(kept)]])
        full = np.flatnonzero(np.diff(bounds))
        parts = [kept[bounds[b] : bounds[b + 1]] for b in full.tolist()]
        blobs = [_squeezed(block.rows[x], block.low[x], block.high[x], x.astype(np.uint32)) for x in parts]
        number = docs.column("block")[0].as_py() if docs.num_rows else -1
        return pa.table({"bucket": pa.array(full, pa.int64()), "block": pa.array([number] * len(full), pa.int64()), "entries": pa.array(blobs, pa.binary())})

    return send


#: Entries compared at a time; a gram with more of them stays in one piece.
_CHUNK = 60_000


def compare(table: pa.Table) -> pa.Table:
    """Steps 3 and 4 for one bucket: entries of all blocks in, answers to the blocks out."""
    blocks = table.column("block").to_numpy()
    opened = [_opened(blob, *_ENTRIES) for blob in table.column("entries").to_pylist()]
    sizes = np.array([len(x[1]) for x in opened])
    rows, low, high, nth = (np.concatenate([x[i] for x in opened]) for i in range(4))
    del opened
    sender = np.repeat(np.arange(len(blocks)), sizes)
    grams = _tokens(rows, LEFT, GRAM // 8)
    order = multikey_order(grams)
    starts = np.flatnonzero(np.concatenate([[True], (grams[order[1:]] != grams[order[:-1]]).any(axis=1)]))
    count = np.diff(np.append(starts, len(order)))
    shared = np.minimum.reduceat(low[order], starts) < np.maximum.reduceat(high[order], starts)
    order, count = order[np.repeat(shared, count)], count[shared]
    found: list[tuple] = []
    ends = np.cumsum(count)
    at = 0
    while at < len(order):
        to = int(ends[min(np.searchsorted(ends, at + _CHUNK), len(ends) - 1)])
        pick = order[at:to]
        row, start, end, value = least_ids(rows[pick], low[pick], high[pick])
        found.append((sender[pick[row]], nth[pick[row]], start, end, value))
        at = to
    out: dict[str, list] = {"block": [], "bucket": [], "answers": []}
    if found:
        who, *parts = (np.concatenate(x) for x in zip(*found, strict=True))
        rank = np.argsort(who, kind="stable")
        bounds = np.searchsorted(who[rank], np.arange(len(blocks) + 1))
        bucket = table.column("bucket")[0].as_py()
        for i in np.flatnonzero(np.diff(bounds)).tolist():
            own = rank[bounds[i] : bounds[i + 1]]
            out["block"].append(int(blocks[i]))
            out["bucket"].append(bucket)
            out["answers"].append(_squeezed(*(p[own].astype(k) for p, (k, _) in zip(parts, _ANSWERS, strict=True))))
    return pa.table({"block": pa.array(out["block"], pa.int64()), "bucket": pa.array(out["bucket"], pa.int64()), "answers": pa.array(out["answers"], pa.binary())})


def _covered(block: Block, answers: pa.Table) -> np.ndarray:
    """Which bytes of a block go."""
    steps = np.zeros(len(block.data) + 1, np.int32)
    if answers.num_rows:
        block.entries()
        for blob in answers.column("answers").to_pylist():
            entry, start, end, value = _opened(blob, *_ANSWERS)
            start, end = start.astype(np.int64), end.astype(np.int64)
            many = block.places[entry]
            which = np.repeat(np.arange(len(entry)), many)
            place = np.repeat(block.first_place[entry] - (np.cumsum(many) - many), many) + np.arange(len(which))
            keep = block.place_id[place] > value[which]
            place, which = place[keep], which[keep]
            np.add.at(steps, block.place_anchor[place] - end[which], 1)
            np.add.at(steps, block.place_anchor[place] - start[which] + SPAN, -1)
    return np.cumsum(steps[:-1]) > 0


def _cut(keep_text: bool):
    def cut_out(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(docs)
        gone = _covered(block, answers)
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for key, start, end in zip(block.keys, block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True):
            mask, data = gone[start:end], block.data[start:end]
            removed = int(np.count_nonzero(mask))
            kept = data[~mask].tobytes() if removed else data.tobytes()
            spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[0]) if removed else 0
            for k, v in zip(out, (key, end - start, removed, spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None), strict=True):
                out[k].append(v)
        return pa.table({k: pa.array(v, pa.string() if k == "kept_sha256" else pa.binary() if k == "kept" else pa.int64()) for k, v in out.items()})

    return cut_out


#: Documents sampled for splitters, and leading tokens taken of each.
SAMPLE_DOCUMENTS, SAMPLE_TOKENS = 2000, 64


def sample_splitters(docs: DataFrame, n: int, buckets: int) -> np.ndarray:
    """buckets - 1 splitters at most, from leading tokens of a bounded sample of documents; they bear on balance alone."""
    if buckets < 2:
        return np.array([], np.uint64)

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = Block(pa.Table.from_batches([batch]))
            _, _, anchor = anchors(block.data, block.offsets)
            pick = anchor[:: max(1, len(anchor) // (SAMPLE_TOKENS * max(1, batch.num_rows)))]
            rows = block.data[pick[:, None] + np.arange(8)] if len(pick) else np.zeros((0, 8), np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array(_tokens(rows, 0, 1)[:, 0].view(np.int64))], names=["lead"])

    share = max(1, n // SAMPLE_DOCUMENTS)
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select("doc_id", "text")
    got = np.array([r[0] for r in some.mapInArrow(leads, "lead long").collect()], np.int64).view(np.uint64)
    return np.unique(np.quantile(got, np.arange(1, buckets) / buckets, method="lower")) if len(got) else np.array([], np.uint64)


#: Blocks and buckets grow with the corpus between these sizes: fewer messages between them, but each still in one task's memory.
BLOCK_BYTES, BUCKET_BYTES, MOST_BLOCKS = (2_000_000, 32_000_000), (8_000_000, 128_000_000), 5000


def remove_repeats(df: DataFrame, block_bytes: int | None = None, bucket_bytes: int | None = None, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of each row of (doc_id, text).

    Texts are UTF-8 bytes, null counts as empty. Rows with equal ids take nothing from each other; a null
    id is neither smaller nor greater than any, so that its row stays whole and takes nothing from
    others. Identical rows are one entry each of their block, which is dealt by id and text. A very long
    text is one row of its block, its anchors being found in stretches. An empty table gives an empty
    table. Other columns are dropped.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    size = int(total["bytes"])
    sized = lambda given, bounds: given or min(max(bounds[0], size // MOST_BLOCKS), bounds[1])
    blocks, buckets = size // sized(block_bytes, BLOCK_BYTES) + 1, size // sized(bucket_bytes, BUCKET_BYTES) + 1
    splitters = sample_splitters(docs, total["n"], buckets)
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    dealt = gathered(dealt, "block", size)
    grams = dealt.groupBy("block").applyInArrow(_announce(buckets), "bucket long, block long, grams binary")
    met = gathered(grams, "bucket", size // 4).groupBy("bucket").applyInArrow(meet, "block long, bucket long, bits binary")
    entries = dealt.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(_send(splitters, buckets), "bucket long, block long, entries binary")
    answers = gathered(entries, "bucket", size).groupBy("bucket").applyInArrow(compare, "block long, bucket long, answers binary")
    out = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_cut(keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if keep_text else out.drop("kept")


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
w AS (SELECT doc_id, p, substr(hx, (2 * p + 1)::BIGINT, {2 * SPAN}) AS g FROM (SELECT doc_id, hx, unnest(range(0, length(hx) // 2 - {SPAN - 1})) AS p FROM d)),
low AS (SELECT g, min(doc_id) AS low FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT w.doc_id, w.p FROM w JOIN low USING (g) WHERE low.low < w.doc_id),
marked AS (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {SPAN} THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
runs AS (SELECT doc_id, run, min(p) AS s, max(p) + {SPAN} AS e FROM numbered GROUP BY doc_id, run),
cuts AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM runs),
docs AS (
  SELECT d.doc_id, any_value(d.hx) AS hx, coalesce(sum(e - s), 0)::BIGINT AS n_removed, count(e) AS n_spans, coalesce(max(e), 0) AS last,
    coalesce(string_agg(substr(d.hx, (2 * before + 1)::BIGINT, (2 * (s - before))::BIGINT), '' ORDER BY s), '') AS head
  FROM d LEFT JOIN cuts ON cuts.doc_id = d.doc_id GROUP BY d.doc_id
)
SELECT doc_id, (length(hx) // 2)::BIGINT AS n_bytes, n_removed, n_spans, sha256(unhex(head || substr(hx, (2 * last + 1)::BIGINT))) AS kept_sha256 FROM docs
"""
