"""Several one-row aggregates of a table from one scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.sources.scratch import staged


@dataclass(frozen=True)
class Part:
    """What an operator aggregates, by name, and how its result is made from the one row with these columns."""

    aggregates: dict[str, Column]
    result: Callable[[DataFrame], DataFrame]

    def alone(self, df: DataFrame) -> DataFrame:
        """The result from a scan of its own."""
        return self.result(df.agg(*[c.alias(n) for n, c in self.aggregates.items()]))


def together(df: DataFrame, parts: dict[str, Part]) -> dict[str, DataFrame]:
    """The results of all parts from one scan; their row is written, so none of them scans again."""
    every = [c for part in parts.values() for c in part.aggregates.values()]
    row = staged(df.agg(*[c.alias(f"a{i}") for i, c in enumerate(every)]), "facts")
    out, at = {}, 0
    for name, part in parts.items():
        own = [F.col(f"a{at + i}").alias(n) for i, n in enumerate(part.aggregates)]
        out[name] = part.result(row.select(*own))
        at += len(own)
    return out
