"""One error type for rules that data break."""

from __future__ import annotations


class RuleError(ValueError):
    """A rule's name, how many rows break it, and a few of them (with 1-based line numbers where known)."""

    def __init__(self, rule: str, detail: str, count: int = 1, sample: list | None = None, line: int | None = None):
        self.rule, self.count, self.sample, self.line = rule, count, sample or [], line
        where = f" (line {line})" if line is not None else ""
        shown = f": {self.sample}" if self.sample else ""
        super().__init__(f"{rule}{where}: {detail}{shown}")
