"""The whole build: sources to five tables and a manifest. All checks come before anything is written; the output is staged and swapped in."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..errors import RuleError
from ..files import Store
from ..operators import builders, versification
from ..operators.quality import validate
from ..schemas import BUILT
from ..scratch import staged
from ..sinks import jsonl
from ..sources import lines, provenance, tabular, xml


@dataclass(frozen=True)
class Edition:
    translation: str
    path: str
    tradition: str = "Hebrew"


@dataclass(frozen=True)
class Sources:
    """Paths; the first edition is the master."""

    editions: tuple[Edition, ...]
    rules: str
    hebrew_words: tuple[str, ...]
    greek_words: tuple[str, ...]
    hebrew_lexicon: str
    greek_lexicon: str
    xrefs: str
    ceiling: float = 0.005
    manifest: str | None = None
    pinned: tuple[str, ...] = field(default=())
    #: Sources are read without a manifest only if asked for.
    unpinned: bool = False


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def build(spark: SparkSession, sources: Sources, folder: str = "") -> tuple[dict[str, DataFrame], dict]:
    """(tables, manifest) of checked tables."""
    if sources.manifest is None and not sources.unpinned:
        raise RuleError("sources are pinned by a manifest", "none is given")
    proof = provenance.verify_sources(spark, folder, provenance.read_manifest(spark, sources.manifest), list(sources.pinned)) if sources.manifest else []
    parsed = {e: xml.read_usfx(spark, e.path) for e in sources.editions}
    master = parsed[sources.editions[0]]
    inventory = staged(builders.canonical_verses(master), "inventory")
    last = versification.last_verses(master)
    rules, _ = tabular.read_rules(lines.read_lines(spark, sources.rules))
    texts = [builders.verse_texts(usfx, e.translation, e.tradition, rules, versification.features(usfx), last, inventory, sources.ceiling)[0] for e, usfx in parsed.items()]
    hebrew = _union([tabular.read_hebrew_words(lines.read_lines(spark, p))[0] for p in sources.hebrew_words])
    greek = _union([tabular.read_greek_words(lines.read_lines(spark, p))[0] for p in sources.greek_words])
    lexicon = xml.read_lexicon(spark, sources.hebrew_lexicon, sources.greek_lexicon)
    words = builders.original_words(hebrew, greek, lexicon)
    direct, ranges, _ = tabular.read_xrefs(lines.read_lines(spark, sources.xrefs), sources.ceiling)
    edges, _ = builders.edges(direct, ranges, inventory, sources.ceiling)
    tables = {"canonical_verses": inventory, "strongs": lexicon, "verse_texts": _union(texts), "original_words": words, "edges": edges}
    for name in BUILT:
        validate(tables[name], name)
    return tables, jsonl.manifest(tables, proof)


def write(spark: SparkSession, tables: dict[str, DataFrame], made: dict, out: str) -> None:
    """Writes beside the old output, then swaps: a failed write leaves the old one whole."""
    store, staged, old = Store(spark, out), f"{out.rstrip('/')}__staged", f"{out.rstrip('/')}__old"
    for p in (staged, old):
        store.delete(p)
    store.make(staged)
    for name in ("canonical_verses", "strongs", "edges"):
        jsonl.write_table(tables[name], f"{staged}/{name}.jsonl", name, check=False)
    for name in ("verse_texts", "original_words"):
        jsonl.write_by_book(tables[name], f"{staged}/{name}", name, check=False)
    store.write(f"{staged}/manifest.json", jsonl.manifest_text(made))
    if store.exists(out):
        store.rename(out, old)
    store.rename(staged, out)
    store.delete(old)
