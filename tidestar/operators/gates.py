"""Rules that are counted in the pass that loads the rows, and stop the load where too many rows violate one."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class RulesViolated(ValueError):
    """More rows violate a rule than the gate lets through. ``counts`` has the violations of each rule."""

    def __init__(self, counts: Mapping[str, int], n_rows: int, over: list[str]) -> None:
        super().__init__(f"of {n_rows} rows too many violate " + ", ".join(f"{name} ({counts[name]})" for name in over))
        self.counts, self.n_rows = dict(counts), n_rows


@dataclass(frozen=True)
class Watched:
    """Where the counts of a watched frame will be, and the frame itself."""

    rows: DataFrame
    seen: Observation


@dataclass(frozen=True)
class Gate:
    """SQL CHECK rules, and the share of rows that may violate each.

    As in SQL an unknown condition passes, as with :func:`check_rules`, whose counts these equal. ``shares`` names
    other shares than ``share`` for some rules; 0 lets no violation through, 1 all.
    """

    rules: Mapping[str, str]
    share: float = 1.0
    shares: Mapping[str, float] | None = None

    def __post_init__(self) -> None:
        unknown = set(self.shares or {}) - set(self.rules)
        if unknown:
            raise ValueError(f"shares for unknown rules: {sorted(unknown)}")

    def _counts(self) -> list[Column]:
        counts = [F.count_if(~F.expr(rule)).alias(f"c{i}") for i, rule in enumerate(self.rules.values())]
        return [F.count(F.lit(1)).alias("n_rows"), *counts]

    def watch(self, df: DataFrame) -> tuple[DataFrame, Watched]:
        """The frame, whose first action also counts the violations, and where they will be.

        That action must read every row of it: counts after a limit are not whole.
        """
        watched = Watched(df, Observation())
        return df.observe(watched.seen, *self._counts()), watched

    def counts(self, watched: Watched) -> tuple[dict[str, int], int]:
        """Violations by rule and the number of rows, of a frame whose action has ended."""
        try:
            found = watched.seen.get
        except Py4JJavaError:
            # Where no row is left after the first pass, Spark drops its plan as empty, and the counts with it.
            found = watched.rows.agg(*self._counts()).first().asDict()
        return {name: found[f"c{i}"] for i, name in enumerate(self.rules)}, found["n_rows"]

    def check(self, watched: Watched) -> dict[str, int]:
        """The violations by rule, or :class:`RulesViolated` where they are too many."""
        counts, n_rows = self.counts(watched)
        over = [name for name, n in counts.items() if n > (self.shares or {}).get(name, self.share) * n_rows]
        if over:
            raise RulesViolated(counts, n_rows, over)
        return counts
