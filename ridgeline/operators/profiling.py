"""Shape, schema, missing cells, duplicates, describe, cardinality, frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.scalars import percent, percent_text
from ridgeline.operators.fused import Part
from ridgeline.operators.quantiles import INTERVAL_LIMIT, quantiles_from, sketches
from ridgeline.sources.scratch import staged

QUARTILES = (0.25, 0.5, 0.75)


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``numeric`` or ``text`` columns, from the schema alone."""
    wanted = T.NumericType if kind == "numeric" else T.StringType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def unpivoted(row: DataFrame, key: str, value: str, columns: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Turn ``{column of row: printed name}`` into (key, value) rows."""
    cells = [F.struct(F.lit(name).alias(key), F.col(f"`{c}`").alias(value)) for c, name in columns.items()]
    return row.select(*by, F.inline(F.array(*cells)))


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column with type and nullability, plus the table's shape."""
    fields = [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    shape = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return shape.select(
        F.inline(F.array(*fields)), F.col("n_rows"), F.lit(len(fields)).cast("long").alias("n_columns")
    )


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows by an explicit order; a DataFrame has none of its own."""
    return df.orderBy(*order_by).limit(n)


def null_part(columns: Sequence[str]) -> Part:
    """``null_profile`` as a part of a scan."""

    def result(row: DataFrame) -> DataFrame:
        total = sum((F.col(f"`{c}`") for c in columns[1:]), F.col(f"`{columns[0]}`"))
        long = unpivoted(row.withColumn("total_missing", total), "column", "n_missing", {c: c for c in columns}, by=["total_missing"])
        return long.select("column", "n_missing", "total_missing", (F.col("n_missing") > 0).alias("warn"))

    return Part({c: F.count_if(F.col(f"`{c}`").isNull()) for c in columns}, result)


def null_profile(df: DataFrame) -> DataFrame:
    """Missing cells per column with the grand total and a warning flag."""
    return null_part(df.columns).alone(df)


def _fingerprinted(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with two differently seeded hashes of every row, and their names.

    Where NULLs stand is part of both hashes, which else skip them; columns that
    no hash takes are read as JSON.
    """
    cells = [F.to_json(F.struct(f.name)) if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields]
    gaps = F.array(*[F.col(f"`{c}`").isNull() for c in df.columns])
    seeds = {"_print_1": F.lit("first"), "_print_2": F.lit("second")}
    return df.withColumns({n: F.xxhash64(seed, gaps, *cells) for n, seed in seeds.items()}), list(seeds)


def distinct_rows(df: DataFrame) -> tuple[int, int]:
    """(rows, distinct rows); NULLs count as equal.

    Only two hashes of a row are shuffled. Rows whose hashes occur more than
    once, and no others, are then compared in full, so that rows which just share
    both hashes stay apart. ``df`` is scanned twice if there are any.
    """
    marked, prints = _fingerprinted(df)
    groups = staged(marked.groupBy(*prints).agg(F.count(F.lit(1)).alias("_copies")), "fingerprints")
    several = groups.filter("_copies > 1").select(*prints)
    rows, alone = groups.agg(F.coalesce(F.sum("_copies"), F.lit(0)), F.count_if(F.col("_copies") == 1)).first()
    if rows == alone:
        return rows, rows
    # Copies combine on the map side; the hashes' table is broadcast where its files are small.
    alike = marked.join(several, prints, "left_semi").drop(*prints)
    return rows, alone + alike.groupBy(*df.columns).agg(F.count(F.lit(1))).count()


def duplicate_rows(df: DataFrame, copies: tuple[int, int] | None = None) -> DataFrame:
    """Rows and copies after the first; NULLs count as equal. ``copies`` is ``distinct_rows``, if that is known."""
    rows, distinct = copies or distinct_rows(df)
    return df.sparkSession.createDataFrame([(rows, rows - distinct)], "n_rows long, n_duplicates long")


def _moments(columns: Sequence[str]) -> list[Column]:
    """count, mean, sample std, min and max of every column, NaN being a value here as it is to Spark."""
    out = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        cells = {"count": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}
        out.append(F.struct(*[cell.alias(n) for n, cell in cells.items()]).alias(f"_moments_{i}"))
    return out


def describe(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    interval_limit: int = INTERVAL_LIMIT,
) -> DataFrame:
    """count, mean, sample std, min, quartiles and max; one row per column.

    With ``by`` (a flag or another small set of groups) all subsets are
    described by the same two scans: moments and sketches, then the quartiles.
    """
    aggregates = [*_moments(columns), *sketches(columns, QUARTILES)]
    found = staged(df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates), "moments")
    return _described(df, found, columns, by, interval_limit)


def describe_part(df: DataFrame, columns: Sequence[str]) -> Part:
    """``describe`` of a whole table as a part of a scan; the quartiles take a second one."""
    every = [*_moments(columns), *sketches(columns, QUARTILES)]
    names = [f"_moments_{i}" for i in range(len(columns))] + [f"_sketch_{i}" for i in range(len(columns))]
    return Part(dict(zip(names, every)), lambda row: _described(df, row, columns, (), INTERVAL_LIMIT))


def _described(df: DataFrame, found: DataFrame, columns: Sequence[str], by: Sequence[str], interval_limit: int) -> DataFrame:
    """The describe table from the row, or the rows by group, of a first scan."""
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_moments_{i}.*")) for i, c in enumerate(columns)])
    moments = found.select(*by, F.inline(rows))
    sketched = found.select(*by, *[f"_sketch_{i}" for i in range(len(columns))]).collect()  # a row per group
    cuts = quantiles_from(df, sketched, columns, QUARTILES, by, interval_limit)
    at = {p: F.max(F.when(F.col("prob") == p, F.col("value"))) for p in QUARTILES}
    quartiles = cuts.groupBy(*by, "column").agg(
        at[0.25].alias("q25"), at[0.5].alias("q50"), at[0.75].alias("q75")
    )
    keys = [*by, "column"]
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys]
    return (
        moments.alias("m")
        .join(quartiles.alias("q"), same, "left")
        .select(*[f"m.{k}" for k in keys], "count", "mean", "std", "min", "q25", "q50", "q75", "max")
    )


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-missing values per column."""
    counted = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in columns])
    return unpivoted(counted, "column", "n_distinct", {c: c for c in columns})


def _value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    long = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _most_frequent(counted: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value"))
    ranked = counted.withColumn("place", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("place") <= top).select("column", "place", "value", "n")


def value_counts(df: DataFrame, columns: Sequence[str], top: int = 20) -> DataFrame:
    """Most frequent values of each column; ties go by value, NULL is left out."""
    return _most_frequent(_value_frequencies(df, columns), top)


def category_tables(df: DataFrame, columns: Sequence[str], top: int = 20) -> tuple[DataFrame, DataFrame]:
    """(``cardinality``, ``value_counts``) from one scan: the counted values are written and read twice."""
    counted = staged(_value_frequencies(df, columns), "values")
    found = counted.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")  # a row per column
    distinct = every.join(found, "column", "left").select("column", F.coalesce("n_distinct", F.lit(0).cast("long")).alias("n_distinct"))
    return distinct, _most_frequent(counted, top)


def _zero_measures(target: str) -> dict[str, Column]:
    return {"total": F.count(F.lit(1)), "zero_count": F.count_if(F.col(target) == 0)}


def _with_zero_percent(counted: DataFrame) -> DataFrame:
    return counted.withColumn("zero_percent", percent(F.col("zero_count"), F.col("total")))


def zero_part(target: str) -> Part:
    """``zero_rate`` of a whole table as a part of a scan."""
    return Part(_zero_measures(target), _with_zero_percent)


def zero_rate(df: DataFrame, target: str, *by: str | Column) -> DataFrame:
    """Rows, zero targets and their percentage, over all or for every group."""
    if not by:
        return zero_part(target).alone(df)
    return _with_zero_percent(df.groupBy(*by).agg(*[c.alias(n) for n, c in _zero_measures(target).items()]))


def describe_by_zero(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Describe the rows with target 0 and those above 0 in one scan."""
    t = F.col(target)
    flagged = df.withColumn("subset", F.when(t == 0, "zero").when(t > 0, "positive"))
    return describe(flagged.filter(F.col("subset").isNotNull()), columns, by=["subset"])


def summary_part(columns: Sequence[str], target: str, copies: tuple[int, int]) -> Part:
    """``dataset_summary`` as a part of a scan, with the result of ``distinct_rows``."""
    missing = sum((F.col(f"`{c}`").isNull().cast("long") for c in columns), F.lit(0))
    rows, distinct = copies

    def result(row: DataFrame) -> DataFrame:
        facts = row.select(
            F.col("rows").cast("string").alias("records"),
            F.lit(str(len(columns))).alias("columns"),
            F.col("missing").cast("string").alias("missing_values"),
            F.lit(str(rows - distinct)).alias("duplicate_rows"),
            F.lit(target).alias("target"),
            F.col("zeros").cast("string").alias("target_zero"),
            percent_text(percent(F.col("zeros"), F.col("rows"))).alias("target_zero_rate"),
        )
        return unpivoted(facts, "key", "value", {c: c for c in facts.columns})

    measures = {
        "rows": F.count(F.lit(1)),
        "missing": F.coalesce(F.sum(missing), F.lit(0)),
        "zeros": F.count_if(F.col(target) == 0),
    }
    return Part(measures, result)


def dataset_summary(df: DataFrame, target: str) -> DataFrame:
    """Seven (key, value) rows: size, quality and zero share of a table."""
    return summary_part(df.columns, target, distinct_rows(df)).alone(df)
