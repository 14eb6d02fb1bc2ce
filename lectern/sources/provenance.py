"""The source manifest: every pinned file is hashed before anything is read."""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import SparkSession

from ..errors import RuleError
from ..files import Store
from .hashes import file_hashes


def read_manifest(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(path, wholetext=True).collect()  # one small document
    made = json.loads(rows[0]["value"])
    if not isinstance(made.get("sources"), dict):
        raise RuleError("a manifest has sources", path)
    return made


def _plain(path: str) -> str:
    """A path in one spelling, whatever named it."""
    return unquote(re.sub(r"^(\w+):/*", r"\1:/", path))


def verify_sources(spark: SparkSession, folder: str, manifest: dict, wanted: list[str]) -> list[tuple[str, dict]]:
    """(source, {path: sha256}) of the wanted sources. A missing entry or file, a wrong hash and a quarantined source (any status) are all reported together; all files are hashed in one job."""
    problems, found = [], []
    pinned: dict[str, tuple[str, str]] = {}
    for source in wanted:
        entry = manifest["sources"].get(source)
        if entry is None:
            problems.append(f"{source}: not in the manifest")
            continue
        if entry.get("status"):
            problems.append(f"{source}: quarantined ({entry['status']})")
        files = entry["files"] if "files" in entry else {entry["file"]: entry["sha256"]}
        found.append((source, dict(sorted(files.items()))))
        pinned |= {f"{folder.rstrip('/')}/{p}": (source, h) for p, h in files.items()}
    store = Store(spark, folder or ".")
    there = {path: _plain(store.qualified(path)) for path in pinned if store.exists(path)}
    hashes = {_plain(r["path"]): r["sha256"] for r in file_hashes(spark, *there).collect()} if there else {}  # a row for each pinned file
    for path, (source, wanted_hash) in sorted(pinned.items()):
        if path not in there:
            problems.append(f"{source}: {path} is missing")
        elif hashes.get(there[path]) != wanted_hash:
            problems.append(f"{source}: {path} has another hash")
    if problems:
        raise RuleError("sources are what the manifest pins", "; ".join(problems), len(problems))
    return found
