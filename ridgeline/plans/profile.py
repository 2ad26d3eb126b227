"""Exploration of a measurement table: every profile table in one call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.scalars import split_position
from ridgeline.model import SPLITS, Roles
from ridgeline.operators import distribution as D
from ridgeline.operators import profiling as P
from ridgeline.operators import quality as Q
from ridgeline.operators.fused import together
from ridgeline.operators.splitting import stratified_split
from ridgeline.sources.files import require_columns, write_small_csv, write_table
from ridgeline.sources.scratch import staged


def profile_tables(
    df: DataFrame, roles: Roles, rules: Sequence[Q.Rule], bin_column: str, edges: Sequence[float], status: str
) -> dict[str, DataFrame]:
    """Named result tables; ``df`` is a scan or a staged frame.

    One scan serves all one-row aggregates, the moments and the sketches; a second
    one settles the quartiles, from which the fences come too. Duplicates take a
    scan of hashes, categories one, and each table by groups one of its own.
    """
    measured = [*roles.numeric, roles.target]
    target = roles.target
    copies = P.distinct_rows(df)
    parts = {
        "missing": P.null_part(df.columns),
        "dataset_summary": P.summary_part(df.columns, target, copies),
        "numeric_summary": P.describe_part(df, measured),
        "rule_violations": Q.rule_part(rules),
        "zero_share": P.zero_part(target),
        "correlation": D.correlation_part(df, target, [roles.id]),
    }
    facts = together(df, parts)
    facts["numeric_summary"] = staged(facts["numeric_summary"], "numeric_summary")
    fences = staged(Q.fences_of(facts["numeric_summary"]), "fences")
    distinct, frequent = P.category_tables(df, roles.categorical)
    # The rows above the fence are few; their three tables read a copy of them.
    high = staged(Q.above_upper_fence(df, target, fences), "high")
    return {
        "schema": P.schema_profile(df),
        "duplicates": P.duplicate_rows(df, copies),
        **facts,
        "cardinality": distinct,
        "value_counts": frequent,
        "describe_by_zero": P.describe_by_zero(df, target, roles.numeric),
        "zero_by_status": P.zero_rate(df, target, status),
        "zero_by_bin": D.zero_rate_by_bin(df, target, bin_column, edges),
        "iqr_outliers": Q.iqr_outliers(df, measured, fences),
        "upper_outliers": P.describe(high, measured, by=["threshold"]),
        "upper_outliers_top": high.drop("threshold").orderBy(F.col(target).desc(), F.col(roles.id)).limit(20),
        "target_histogram": D.equal_width_histogram(df, target, 50),
        "scatter_grid": D.scatter_grid(df, bin_column, target, 100),
    }


def split_tables(rows: DataFrame, roles: Roles) -> dict[str, DataFrame]:
    """What is looked at on the split rows: zero share per split, train-only analysis."""
    train = rows.filter(F.col("split") == SPLITS[0])
    return {
        "zero_by_split": P.zero_rate(rows, roles.target, "split").orderBy(split_position(F.col("split"))),
        "train_correlation": D.correlation_with_target(train, roles.target, [roles.id]),
        "train_target_by_category": D.target_by_category(train, roles.categorical, roles.target),
    }


def run_profile(
    table: DataFrame,
    roles: Roles,
    out: str,
    rules: Sequence[Q.Rule],
    bin_column: str,
    edges: Sequence[float],
    status: str,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """Write every profile table and the rows with their split under ``out``.

    The split is a column and the folder name of one table that keeps the
    identifiers, so nothing has to be matched up by position later.
    """
    require_columns(table, roles.columns, "measurement table")
    df = staged(table, "measurements")
    results = profile_tables(df, roles, rules, bin_column, edges, status)
    rows = staged(stratified_split(df, roles.id, roles.target, seed), "split")
    results |= split_tables(rows, roles)
    for name, frame in results.items():
        write_small_csv(frame, f"{out}/{name}")
    write_table(df, f"{out}/cleaned")
    rows.write.mode("overwrite").partitionBy("split").parquet(f"{out}/splits")
    return results
