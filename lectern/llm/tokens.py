"""Whole-text encoding with a public tokenizer, one distinct stretch at a time.

Both vocabularies used here cut a text before they merge: a cut always falls before a space that a
non-space follows, and between a letter and the punctuation after it, whatever stands around. Texts are
cut there, distinct stretches are encoded once, and their ids are laid out again; the result equals
encoding each text by itself. The strings of a tokenizer's added tokens, such as its end of text, are
stretches of their own and get these tokens' ids, as the library gives them. Stretches that repeat are
kept from batch to batch and from task to task of a worker process, up to `most`.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARK, STOP = "\x01", "\x02"
#: Characters that stand for added tokens while texts are cut; texts that hold one are encoded by themselves.
ADDED = "\x03\x04\x05\x06\x0e\x0f\x10\x11\x12\x13\x14\x15\x16\x17\x18\x19"
_SPACES = r"\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Stretches that are encoded as one text, with a stop between them.
_JOINED = 256
#: Joined texts that are encoded at a time.
_GROUPS = 64
#: What a stretch begins with, unless it begins a text.
_BEGINS = " .,;:!?|"


class Encoder:
    """Encodes Arrow arrays of strings, each as the library encodes it alone."""

    def __init__(self, path: str, most: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        # plain strings that are found anywhere, none of which can overlap another
        apart = not any(a.content.endswith(b.content[:n]) for a in added for b in added for n in range(1, len(b.content)))
        plain = apart and len(added) <= len(ADDED) and not any(a.lstrip or a.rstrip or a.single_word or a.normalized for a in added)
        self.added = dict(zip(ADDED, [a.content for a in added], strict=False)) if plain else {}
        self.whole = [MARK, *self.added] if plain else [MARK, *(a.content for a in added)]
        self.most = most
        self._forget()
        self.stop = self._find_stop()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.lengths = np.array([], np.uint32), np.array([], np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _find_stop(self) -> tuple[str, list[int]] | None:
        """A string that keeps stretches apart in a joined text, and its ids; it must prove itself on all kinds of ends."""
        ends = ["word", " word", ".", "...", " a \n", "é", " ß,", "7", " '", "|", "\n\n", " x́", " 's", " don't"]
        alone = self._ids(ends)
        pairs = [(a, b, x, y) for a, x in zip(ends, alone, strict=True) for b, y in zip(ends, alone, strict=True) if b[0] in _BEGINS]
        for stop in (f" {STOP}", f" {STOP} "):
            ids = self._ids([stop])[0]
            if ids and all(self._ids([a + stop + b])[0] == x + ids + y for a, b, x, y in pairs):
                return stop, ids
        return None

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [(np.array([], np.uint32), np.array([], np.int64))]
        for at in range(0, len(words), _JOINED * _GROUPS):
            each = self._ids(words[at : at + _JOINED * _GROUPS])
            lengths = np.fromiter(map(len, each), np.int64, len(each))
            parts.append((np.fromiter(chain.from_iterable(each), np.uint32, int(lengths.sum())), lengths))
        flat, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
        return flat, lengths

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths of stretches that a cut begins."""
        if self.stop is None or len(words) < 2 * _JOINED or any(STOP in w for w in words):
            return self._one_by_one(words)
        stop, ids = self.stop
        groups = range(0, len(words), _JOINED * _GROUPS)  # an encoding takes far more room than its ids
        joined = ([stop.join(words[at : at + _JOINED]) + stop for at in range(first, min(len(words), first + _JOINED * _GROUPS), _JOINED)] for first in groups)
        flat = np.concatenate([np.array(x, np.uint32) for some in joined for x in self._ids(some)])
        last = np.flatnonzero(flat == ids[-1])
        if len(last) != len(words):
            return self._one_by_one(words)
        lengths = np.diff(last, prepend=-1) - len(ids)
        keep = np.ones(len(flat), bool)
        for back in range(len(ids)):
            keep[last - back] = False
        return flat[keep], lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat uint32 ids and offsets (n + 1); null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.whole):
            flat, lengths = self._one_by_one(texts.to_pylist())
            return flat, np.concatenate([[0], np.cumsum(lengths)])
        for sign, content in self.added.items():
            if pc.any(pc.match_substring(texts, content)).as_py():
                texts = pc.replace_substring(texts, content, f"{MARK}{sign}{MARK}")
        cut = pc.replace_substring_regex(texts, "([A-Za-zÀ-ÿ])([.,;:!?|])", rf"\1{MARK}\2")
        cut = pc.replace_substring_regex(cut, rf" ([^{_SPACES}\x01])", rf"{MARK} \1")
        lists = pc.split_pattern(cut, MARK)
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(), [self.added.get(w, w) for w in coded.dictionary.to_pylist()]

        if len(self.slots) > self.most:
            self._forget()
        slot = np.fromiter(map(self.slots.get, words, [-1] * len(words)), np.int64, len(words))
        new = np.flatnonzero(slot < 0)
        begun = np.fromiter((words[i][:1] in _BEGINS and words[i] != "" for i in new.tolist()), bool, len(new))  # the rest begin a text
        new, other = np.concatenate([new[begun], new[~begun]]), int((~begun).sum())
        parts = self._encoded([words[i] for i in new[: len(new) - other].tolist()]), self._one_by_one([words[i] for i in new[len(new) - other :].tolist()])
        fresh, took = (np.concatenate(x) for x in zip(*parts, strict=True))
        known = len(self.lengths)
        slot[new] = known + np.arange(len(new))
        flat, lengths = np.concatenate([self.flat, fresh]), np.concatenate([self.lengths, took])
        starts = np.cumsum(lengths) - lengths

        often = new[np.bincount(codes, minlength=len(words))[new] > 1]
        size = lengths[slot[often]]
        self.slots.update(zip([words[i] for i in often.tolist()], range(known, known + len(often)), strict=True))
        self.flat = np.concatenate([self.flat, flat[_spread(starts[slot[often]], size)]])
        self.lengths = np.concatenate([self.lengths, size])

        slot = slot[codes]
        size = lengths[slot]
        ends = np.concatenate([[0], np.cumsum(size)])
        return flat[_spread(starts[slot], size)], ends[bounds - bounds[0]]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each stretch, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker process's own encoder of a tokenizer file."""
    return Encoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end, np.dtype("<u4"))
    keep = np.ones(len(out), bool)
    keep[offsets[1:] + np.arange(n)] = False
    out[keep] = ids
    return out, offsets + np.arange(n + 1)
