"""Domain rules and IQR outliers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.scalars import percent
from ridgeline.operators.fused import Part
from ridgeline.operators.profiling import describe, unpivoted
from ridgeline.operators.quantiles import exact_quantiles

IQR_FACTOR = 1.5


@dataclass(frozen=True)
class Rule:
    """A named violation: a condition that a valid row never meets."""

    name: str
    violated: Column


def below(column: str, bound: float) -> Rule:
    return Rule(f"{column} < {bound:g}", F.col(column) < bound)


def at_or_below(column: str, bound: float) -> Rule:
    return Rule(f"{column} <= {bound:g}", F.col(column) <= bound)


def outside(column: str, low: float, high: float) -> Rule:
    return Rule(f"{column} outside [{low:g}, {high:g}]", (F.col(column) < low) | (F.col(column) > high))


def turbine_rules() -> list[Rule]:
    return [
        below("wind_speed", 0),
        outside("wind_direction", 0, 360),
        at_or_below("air_density", 0),
        outside("generator_efficiency", 0, 1),
        outside("humidity", 0, 100),
        below("power_output", 0),
    ]


def rule_part(rules: Sequence[Rule]) -> Part:
    """``rule_violations`` as a part of a scan."""
    names = {f"r{i}": r.name for i, r in enumerate(rules)}
    return Part({f"r{i}": F.count_if(r.violated) for i, r in enumerate(rules)}, lambda row: unpivoted(row, "rule", "n", names))


def rule_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of every rule, counted in one pass."""
    return rule_part(rules).alone(df)


def iqr_fences(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, q1, q3, lower, upper) with fences 1.5 IQR off the quartiles."""
    return _fences(exact_quantiles(df, columns, (0.25, 0.75)))


def _fences(cuts: DataFrame) -> DataFrame:
    q1 = F.max(F.when(F.col("prob") == 0.25, F.col("value")))
    q3 = F.max(F.when(F.col("prob") == 0.75, F.col("value")))
    spread = F.lit(IQR_FACTOR) * (F.col("q3") - F.col("q1"))
    return (
        cuts.groupBy("column")
        .agg(q1.alias("q1"), q3.alias("q3"))
        .withColumn("lower", F.col("q1") - spread)
        .withColumn("upper", F.col("q3") + spread)
    )


def fences_of(described: DataFrame) -> DataFrame:
    """The fences from a describe table, which has the quartiles."""
    quartile = F.array(*[F.struct(F.lit(p).alias("prob"), F.col(c).alias("value")) for p, c in ((0.25, "q25"), (0.75, "q75"))])
    return _fences(described.select("column", F.inline(quartile)))


def _fence_values(df: DataFrame, columns: Sequence[str], fences: DataFrame | None = None) -> dict[str, dict[str, Column]]:
    """The fences as literals: five numbers per column, which a scan can push down."""
    rows = (iqr_fences(df, columns) if fences is None else fences).collect()
    names = ("q1", "q3", "lower", "upper")
    found = {r["column"]: {n: F.lit(r[n]).cast("double") for n in names} for r in rows}
    absent = {n: F.lit(None).cast("double") for n in names}
    return {c: found.get(c, absent) for c in columns}


def iqr_outliers(df: DataFrame, columns: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """Fences, outlier count and outlier percentage per column.

    Two passes find the quartiles of all columns, one counts against them; with
    the fences ``known``, there is just the last.
    """
    fences = _fence_values(df, columns, known)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if((F.col(c) < fences[c]["lower"]) | (F.col(c) > fences[c]["upper"])).alias(f"n{i}")
            for i, c in enumerate(columns)
        ],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            *[value.alias(name) for name, value in fences[c].items()],
            F.col(f"n{i}").alias("n_outliers"),
            percent(F.col(f"n{i}"), F.col("rows")).alias("percent"),
        )
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*cells)))


def above_upper_fence(df: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """Rows above the upper fence of ``column``, with the fence as ``threshold``; ``known`` has fences found before."""
    fence = _fence_values(df, [column], known)[column]["upper"]
    return df.filter(F.col(column) > fence).withColumn("threshold", fence)


def upper_outlier_describe(df: DataFrame, column: str, describe_columns: Sequence[str]) -> DataFrame:
    """Describe the rows above the fence, which is shown with every line."""
    high = above_upper_fence(df, column)
    return describe(high, describe_columns, by=["threshold"])


def upper_outlier_top(df: DataFrame, column: str, tie_break: str, n: int = 20) -> DataFrame:
    """The ``n`` largest rows above the fence."""
    high = above_upper_fence(df, column).drop("threshold")
    return high.orderBy(F.col(column).desc(), F.col(tie_break)).limit(n)
