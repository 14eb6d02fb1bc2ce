"""Embedding texts in batches through an injectable embedder whose build is pinned."""

from __future__ import annotations

import json
import re
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import RuleError

BATCH, MOST, DIMS = 32, 512, 1024


class Embedder(Protocol):
    def health(self) -> dict: ...

    def embed(self, texts: list[str]) -> list[list[float]]: ...


@dataclass(frozen=True)
class HashEmbedder:
    """Signed hashing of words into unit vectors: the same text gives the same vector everywhere."""

    dims: int = DIMS
    model: str = "hash"
    revision: str = "1"

    def health(self) -> dict:
        return {"model": self.model, "revision": self.revision, "dims": self.dims}

    def embed(self, texts: list[str]) -> list[list[float]]:
        import hashlib

        out = np.zeros((len(texts), self.dims))
        for i, text in enumerate(texts):
            for word in re.findall(r"[^\x20\x09-\x0D]+", text.lower()) or [""]:
                h = int(hashlib.md5(word.encode()).hexdigest()[:15], 16)  # 60 bits
                out[i, h % self.dims] += 1 if h >> 59 else -1
        out[~out.any(axis=1), 0] = 1  # words that cancel out
        return (out / np.linalg.norm(out, axis=1, keepdims=True)).tolist()


@dataclass(frozen=True)
class HttpEmbedder:
    """A service with GET /health and POST /embed."""

    url: str
    health_timeout: float = 10
    batch_timeout: float = 600

    def _json(self, path: str, timeout: float, body: dict | None = None) -> dict:
        data = None if body is None else json.dumps(body).encode()
        request = urllib.request.Request(f"{self.url.rstrip('/')}{path}", data, {"content-type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.load(answer)

    def health(self) -> dict:
        return self._json("/health", self.health_timeout)

    def embed(self, texts: list[str]) -> list[list[float]]:
        return self.answer(texts)[0]

    def answer(self, texts: list[str]) -> tuple[list[list[float]], str]:
        """Vectors, and the stamp of the build that the answer itself names."""
        if not 1 <= len(texts) <= MOST:
            raise RuleError("a batch has 1 to 512 texts", str(len(texts)))
        made = self._json("/embed", self.batch_timeout, {"texts": texts})
        return made["vectors"], stamp(made)


def batch_size(raw: str | None) -> int:
    if raw is None or raw == "":
        return BATCH
    if not raw.isdigit() or not 1 <= int(raw) <= MOST:
        raise RuleError("the batch size is from 1 to 512", raw)
    return int(raw)


def stamp(health: dict) -> str:
    return f"{health['model']}@{health['revision']}"


def answer(embedder: Embedder, texts: list[str]) -> tuple[list[list[float]], str]:
    """Vectors and the stamp of the build that made them: the answer's own, or what an embedder without answers of that kind says of itself."""
    if hasattr(embedder, "answer"):
        return embedder.answer(texts)
    return embedder.embed(texts), stamp(embedder.health())


def check_build(health: dict, model: str, revision: str) -> None:
    if (health.get("model"), health.get("revision")) != (model, revision):
        raise RuleError("the embedder is the pinned build", stamp(health))


def embed_texts(rows: DataFrame, embedder: Embedder, model: str, revision: str, dims: int = DIMS, size: int = BATCH, keys: tuple[str, ...] = ("canonicalId", "translation"), text: str = "text") -> DataFrame:
    """(keys, embedding, embeddingModel). The build is checked before any text is sent; a batch must come back whole and of the right size, and the build stay what it was."""
    check_build(embedder.health(), model, revision)
    mark = f"{model}@{revision}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.iloc[at : at + size]
                vectors, made = answer(embedder, part[text].tolist())
                if len(vectors) != len(part):
                    raise RuleError("an answer has a vector per text", f"{len(vectors)} for {len(part)}")
                if any(len(v) != dims for v in vectors):
                    raise RuleError("a vector has the pinned size", str(sorted({len(v) for v in vectors})))
                if made != mark:
                    raise RuleError("the build stays the same", made)
                yield part[list(keys)].assign(embedding=vectors, embeddingModel=mark)

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.select(*keys, F.coalesce(text, F.lit("")).alias(text)).mapInPandas(run, f"{kinds}, embedding array<double>, embeddingModel string")


def file_name(folder: str, revision: str, explicit: str | None = None) -> str:
    """Where embeddings are kept: an explicit path wins, else the revision is part of the name."""
    return explicit or f"{folder.rstrip('/')}/embeddings-{revision}.jsonl"
