"""Versions of a set of tables under one pointer: readers see all tables of one version, whatever writers do.

    root/versions/<name>/<table>/   a version's tables, written before anybody is told
    root/log/<n>.json               the n-th switch: the version's name and its row counts

A switch is one rename of a small file to the next number, which fails if another writer was there first.
A reader takes the greatest number once and reads that version's folders; it never sees two builds. What
a writer that died has left under `versions` is in no entry of the log; `clean` deletes it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..errors import RuleError
from ..files import Store


@dataclass(frozen=True)
class Version:
    number: int
    name: str
    counts: dict[str, int]


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Store(spark, root)

    def _entry(self, number: int) -> str:
        return f"{self.root}/log/{number:012d}.json"

    def current(self) -> Version | None:
        """The last version that was switched to."""
        log = f"{self.root}/log"
        numbers = [int(n[:-5]) for n in (self.store.names(log) if self.store.exists(log) else []) if n.endswith(".json")]
        if not numbers:
            return None
        made = json.loads(self.store.read(self._entry(max(numbers))))
        return Version(max(numbers), made["name"], made["counts"])

    def folder(self, name: str, table: str) -> str:
        return f"{self.root}/versions/{name}/{table}"

    def stage(self, tables: dict[str, DataFrame]) -> tuple[str, dict[str, DataFrame]]:
        """Writes tables under a name that no reader knows; returns it and the tables as written."""
        name = uuid.uuid4().hex
        for table, df in tables.items():
            df.write.parquet(self.folder(name, table))
        return name, {t: self.spark.read.schema(df.schema).parquet(self.folder(name, t)) for t, df in tables.items()}

    def switch(self, name: str, counts: dict[str, int], over: Version | None) -> Version:
        """Makes a staged version the current one, if `over` still is."""
        new = Version((over.number if over else 0) + 1, name, counts)
        self.store.make(f"{self.root}/log")
        made = f"{self.root}/log/_{name}"
        self.store.write(made, json.dumps({"name": name, "counts": counts}, sort_keys=True) + "\n")
        try:
            self.store.claim(made, self._entry(new.number))
        except Exception as e:
            if self.store.exists(self._entry(new.number)):
                raise RuleError("nobody else has switched meanwhile", f"version {new.number} is another writer's") from e
            raise
        return new

    def read(self, version: Version | None = None) -> dict[str, DataFrame]:
        """All tables of one version, by default of the one that is current now."""
        version = version or self.current()
        if version is None:
            raise RuleError("there is a version to read", self.root)
        return {t: self.spark.read.parquet(self.folder(version.name, t)) for t in version.counts}

    def clean(self, keep: int = 2) -> list[str]:
        """Deletes versions but the last `keep` of the log, and what no entry of the log names; not while a load runs."""
        log = [n for n in self.store.names(f"{self.root}/log") if n.endswith(".json")] if self.store.exists(f"{self.root}/log") else []
        wanted = {json.loads(self.store.read(f"{self.root}/log/{n}"))["name"] for n in log[-keep:]}
        gone = [n for n in (self.store.names(f"{self.root}/versions") if self.store.exists(f"{self.root}/versions") else []) if n not in wanted]
        for name in gone:
            self.store.delete(f"{self.root}/versions/{name}")
        return gone
