"""Exact, linearly interpolated quantiles that hold at any table size.

Spark's own exact percentile merges a map of all distinct values of a group in
one task. Here one scan makes a mergeable sketch of every column, which brackets
the wanted ranks, and a second one counts: what lies below each bracket, and the
single values inside, some six in ten thousand. Ranks come from the counts alone,
so a sketch that errs costs another round and never a wrong value. Brackets that
still hold too many rows are sketched again before their values are counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

# Rows a bracket may hold before its values are counted one by one.
INTERVAL_LIMIT = 1_000_000
# A sketch's rank error is one row in ACCURACY; brackets reach MARGIN of them to either side.
ACCURACY = 10_000
MARGIN = 2


@dataclass(frozen=True)
class _Search:
    """The two neighbouring ranks of one probability and the closed bracket they are looked for in."""

    group: tuple
    column: int
    prob: float
    rows: int  # all values of the column
    low: float
    high: float
    least: float
    most: float
    below: int = 0  # values under ``low``, once they are counted
    inside: int = 0
    last: bool = False  # no sketch makes the bracket shorter

    @property
    def position(self) -> float:
        return self.prob * (self.rows - 1)

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position), math.ceil(self.position)

    @property
    def held(self) -> bool:
        """Whether both ranks lie inside, by the counts."""
        first, last = self.ranks
        return self.below <= first and last < self.below + self.inside


def value_of(column: str) -> Column:
    """The number in a column; NaN is missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def sketches(columns: Sequence[str], probs: Sequence[float]) -> list[Column]:
    """Aggregates, one per column, that a first scan makes beside whatever else it counts.

    Their names are ``_sketch_0`` and so on; ``quantiles_from`` takes the row.
    """
    shares = [min(1.0, max(0.0, p + side * MARGIN / ACCURACY)) for p in probs for side in (-1, 1)]
    out = []
    for i, c in enumerate(columns):
        v = value_of(c)
        ends = F.percentile_approx(v, [float(s) for s in shares], ACCURACY)
        out.append(F.struct(F.count(v).alias("rows"), F.min(v).alias("least"), F.max(v).alias("most"), ends.alias("ends")).alias(f"_sketch_{i}"))
    return out


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    interval_limit: int = INTERVAL_LIMIT,
) -> DataFrame:
    """Rows (by..., column, prob, value); NULL and NaN are left out of the ranking.

    The number of groups of ``by`` must be small (a flag, a top-10 list): every
    group adds ranks that are looked for. ``df`` is scanned twice, and twice more
    for every factor of a thousand beyond two billion rows, so hand in a scan or a
    staged frame.
    """
    aggregates = sketches(columns, probs)
    found = df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)
    return quantiles_from(df, found.collect(), columns, probs, by, interval_limit)


def quantiles_from(
    df: DataFrame,
    found: Sequence[Row],
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    interval_limit: int = INTERVAL_LIMIT,
) -> DataFrame:
    """The quantiles of ``exact_quantiles`` from the rows of a first scan, one per group, and a second scan."""
    searches = []
    for row in found:
        for i in range(len(columns)):
            sketch = row[f"_sketch_{i}"]
            for j, p in enumerate(probs):
                if sketch["rows"]:
                    low, high = sketch["ends"][2 * j], sketch["ends"][2 * j + 1]
                    searches.append(_Search(tuple(row[b] for b in by), i, float(p), sketch["rows"], low, high, sketch["least"], sketch["most"]))
    values: dict[_Search, float] = {}
    while searches:
        # A bracket whose ends meet is settled by its counts, a short one by its values, a long one is sketched again.
        short = [s.last or s.low == s.high or s.rows * 3 * MARGIN / ACCURACY <= interval_limit for s in searches]
        counted, settled = _counted(df, columns, by, searches, short)
        values |= settled
        searches = [_wider(s) if not s.held else s for s in counted if s not in settled]
        long = [s for s in searches if s.held]
        searches = [s for s in searches if not s.held] + (_narrower(df, columns, by, long) if long else [])
    lines = [(*s.group, columns[s.column], s.prob, v) for s, v in values.items()]
    fields = "".join(f"`{b}` {df.schema[b].dataType.simpleString()}, " for b in by)
    return df.sparkSession.createDataFrame(lines, f"{fields}`column` string, prob double, value double")


def _between(low: float, high: float, weight: float) -> float:
    """Linear interpolation; an infinite end decides unless it has no weight."""
    if weight == 0 or low == high:
        return low
    if math.isinf(low) or math.isinf(high):
        return low * (1 - weight) + high * weight
    return low + (high - low) * weight


def _wider(s: _Search) -> _Search:
    """The bracket moved to the side where the ranks are."""
    first, last = s.ranks
    return replace(s, low=s.least if first < s.below else s.low, high=s.most if last >= s.below + s.inside else s.high, below=0, inside=0)


def _counted(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], searches: Sequence[_Search], short: Sequence[bool]
) -> tuple[list[_Search], dict[_Search, float]]:
    """Every search with its counts, and the values of those that the counts settle.

    One scan and one row per row: they are grouped by the values that lie in a
    short bracket, which most rows have none of, and so combine on the map side.
    """
    joined, brackets = _bracketed(df, by, searches)
    some = {(s.column, s.prob) for s, is_short in zip(searches, short) if is_short}
    keys, sums = {}, []
    for k, (s, low, high) in enumerate(brackets):
        v = value_of(columns[s.column])
        sums += [F.count_if(v < low).alias(f"_below_{k}"), F.count_if(_within(v, low, high)).alias(f"_inside_{k}")]
        if (s.column, s.prob) in some:
            hit = _within(v, low, high)
            keys[s.column] = keys[s.column] | hit if s.column in keys else hit
    listed = [F.when(hit, value_of(columns[c])).alias(f"_value_{c}") for c, hit in keys.items()]
    counts = joined.groupBy(*by, *listed).agg(F.count(F.lit(1)).alias("_n"), *sums).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        names = [f"_{kind}_{k}" for k in range(len(brackets)) for kind in ("below", "inside")]
        totals = counts.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names])
        found = {tuple(r[b] for b in by): r for r in totals.collect()}
        place = {(s.column, s.prob): k for k, (s, _, _) in enumerate(brackets)}
        out, wanted = [], []
        for n, (s, is_short) in enumerate(zip(searches, short)):
            row, k = found[s.group], place[s.column, s.prob]
            out.append(replace(s, below=row[f"_below_{k}"], inside=row[f"_inside_{k}"]))
            if out[-1].held and is_short:
                wanted += [(n, *s.group, s.column, s.low, s.high, rank - out[-1].below, side) for side, rank in enumerate(s.ranks)]
        return out, _ranked(counts, by, sorted(keys), out, wanted) if wanted else {}
    finally:
        counts.unpersist()


def _ranked(counts: DataFrame, by: Sequence[str], columns: Sequence[int], searches: Sequence[_Search], wanted: list[tuple]) -> dict[_Search, float]:
    """Values at ranks inside the brackets, from counts per value; a bracket has few enough to be ordered in a task."""
    cells = [F.struct(F.lit(c).alias("_column"), F.col(f"_value_{c}").alias("_value")) for c in columns]
    listed = counts.select(*by, "_n", F.inline(F.array(*cells))).filter(F.col("_value").isNotNull())
    listed = listed.groupBy(*by, "_column", "_value").agg(F.sum("_n").alias("_n"))
    types = "".join(f"`_by_{n}` {counts.schema[b].dataType.simpleString()}, " for n, b in enumerate(by))
    table = counts.sparkSession.createDataFrame(wanted, f"_search int, {types}_of int, _low double, _high double, _rank long, _side int")
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"_by_{n}")) for n, b in enumerate(by)], F.col("_column") == F.col("_of"))
    inside = F.col("_value").between(F.col("_low"), F.col("_high"))
    upto = F.sum("_n").over(Window.partitionBy("_search", "_side").orderBy("_value"))
    placed = listed.join(F.broadcast(table), same & inside).withColumn("_upto", upto)  # two rows per search
    hits = placed.filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
    ends: dict[int, dict[int, float]] = {}
    for r in hits.select("_search", "_side", "_value").collect():
        ends.setdefault(r["_search"], {})[r["_side"]] = r["_value"]
    return {searches[n]: _between(e[0], e[1], searches[n].position - math.floor(searches[n].position)) for n, e in ends.items()}


def _bracketed(df: DataFrame, by: Sequence[str], searches: Sequence[_Search]) -> tuple[DataFrame, list[tuple[_Search, Column, Column]]]:
    """``df`` with the ends of every bracket: literals, or with groups, columns of a local table with one row per group."""
    if not by:
        return df, [(s, F.lit(s.low), F.lit(s.high)) for s in searches]
    slots: dict[tuple[int, float], int] = {}
    for s in searches:
        slots.setdefault((s.column, s.prob), len(slots))
    ends: dict[tuple, list] = {}
    for s in searches:
        cells = ends.setdefault(s.group, [float("nan")] * (2 * len(slots)))
        at = 2 * slots[s.column, s.prob]
        cells[at], cells[at + 1] = s.low, s.high
    fields = "".join(f"`_by_{n}` {df.schema[b].dataType.simpleString()}, " for n, b in enumerate(by))
    table = df.sparkSession.createDataFrame([(*group, cells) for group, cells in ends.items()], f"{fields}_ends array<double>")
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"_by_{n}")) for n, b in enumerate(by)])
    joined = df.join(F.broadcast(table), same)  # one row per group
    # One entry stands for a column and probability of all groups; absent ones are NaN, which holds nothing.
    first: dict[tuple, _Search] = {}
    for s in searches:
        first.setdefault((s.column, s.prob), s)
    return joined, [(s, F.get("_ends", F.lit(2 * slots[key])), F.get("_ends", F.lit(2 * slots[key] + 1))) for key, s in first.items()]


def _within(v: Column, low: Column, high: Column) -> Column:
    """Inside a closed bracket; NaN, the largest of all numbers to Spark, is never one of its ends that counts."""
    return (v >= low) & (v <= high) & ~F.isnan(low)


def _narrower(df: DataFrame, columns: Sequence[str], by: Sequence[str], searches: Sequence[_Search]) -> list[_Search]:
    """Brackets sketched again, around the ranks that are looked for inside.

    One that does not shrink is left to be counted, whatever its size.
    """
    out = []
    joined, brackets = _bracketed(df, by, searches)
    aggregates = []
    for k, (s, low, high) in enumerate(brackets):
        v = value_of(columns[s.column])
        # Groups share an aggregate; what each of them looks for lies between two of a thousand cuts.
        shares = [x / 1000 for x in range(1001)] if by else _shares(s)
        aggregates.append(F.percentile_approx(F.when(_within(v, low, high), v), shares, ACCURACY).alias(f"_ends_{k}"))
    rows = (joined.groupBy(*by).agg(*aggregates) if by else joined.agg(*aggregates)).collect()
    found = {tuple(r[b] for b in by): r for r in rows}
    place = {(s.column, s.prob): k for k, (s, _, _) in enumerate(brackets)}
    for s in searches:
        ends = found[s.group][f"_ends_{place[s.column, s.prob]}"]
        if len(ends) == 2:
            low, high = ends
        else:
            a, b = _shares(s)
            low, high = ends[max(0, math.floor(a * 1000) - 1)], ends[min(1000, math.ceil(b * 1000) + 1)]
        out.append(replace(s, low=low, high=high, below=0, inside=0, last=(low, high) == (s.low, s.high)))
    return out


def _shares(s: _Search) -> list[float]:
    """Where the ranks lie inside a counted bracket, with the margin of a sketch."""
    first, last = (r - s.below for r in s.ranks)
    size = max(1, s.inside - 1)
    return [max(0.0, first / size - MARGIN / ACCURACY), min(1.0, last / size + MARGIN / ACCURACY)]
