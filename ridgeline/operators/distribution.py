"""Zero rate by bin, histograms, target by category, correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions.scalars import bin_label, equal_width_bin, is_finite, right_closed_bin
from ridgeline.operators.fused import Part
from ridgeline.operators.profiling import columns_of_type, unpivoted, zero_rate
from ridgeline.operators.quantiles import exact_quantiles


def zero_rate_by_bin(df: DataFrame, target: str, column: str, edges: Sequence[float]) -> DataFrame:
    """Zero rate of the non-empty bins ``(a, b]``; values outside are left out."""
    binned = df.select(target, right_closed_bin(F.col(column), edges).alias("bin_number"))
    rates = zero_rate(binned.filter(F.col("bin_number").isNotNull()), target, "bin_number")
    return rates.withColumn("bin", bin_label(F.col("bin_number"), edges))


def _finite_bounds(df: DataFrame, *columns: str) -> list[float]:
    """Smallest and largest finite value of each column: a pair of numbers per column.

    A column without any has the bounds 0 and 0, which no finite row will meet.
    """
    ends = []
    for c in columns:
        v = F.col(c).cast("double")
        ends += [f(F.when(is_finite(v), v)) for f in (F.min, F.max)]
    return [0.0 if v is None else v for v in df.agg(*ends).first()]


# Where values lie that no bin holds: before the first bin, after the last, nowhere.
UNDER, OVER, NO_NUMBER = -1, -2, -3


def _binned(df: DataFrame, column: str, low: float, high: float, bins: int, *by: str) -> DataFrame:
    """(by..., bin, n) of all values that are there: bins from 0, or one of the three other places."""
    v = F.col(column).cast("double")
    inside = equal_width_bin(v, F.lit(low), F.lit(high), bins).cast("long")
    place = (
        F.when(F.isnan(v), F.lit(NO_NUMBER))
        .when(v == float("inf"), F.lit(OVER))
        .when(v == float("-inf"), F.lit(UNDER))
        .otherwise(inside)
    )
    return df.filter(v.isNotNull()).groupBy(*by, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def equal_width_histograms(df: DataFrame, column: str, bins: int, *by: str) -> DataFrame:
    """(by..., bin, lower, upper, n) for every bin of equal width, empty ones included.

    The bins span the finite values, of all groups together. Values that are not
    finite get cells of their own where there are any: bin -1 for minus infinity
    (under), ``bins`` for infinity (over), and NULL for NaN, which has no edges.
    A group, or a table, without any value has no rows.
    """
    low, high = _finite_bounds(df, column)
    counted = _binned(df, column, low, high, bins, *by)
    cells = F.map_from_entries(F.collect_list(F.struct("bin", "n")))  # at most ``bins`` and three entries
    start, width = (low - 0.5, 1.0) if low == high else (low, high - low)
    step = F.lit(width) / bins
    frame = counted.groupBy(*by).agg(cells.alias("counts")).filter(F.size("counts") > 0)
    numbers = F.concat(F.sequence(F.lit(0), F.lit(bins - 1)), F.array(F.lit(UNDER), F.lit(OVER), F.lit(NO_NUMBER)))
    bin_ = F.col("bin").cast("long")
    n = F.coalesce(F.try_element_at("counts", bin_), F.lit(0)).cast("long")
    infinite = F.lit(float("inf"))
    rows = frame.select(*by, "counts", F.explode(numbers).alias("bin")).select(
        *by,
        F.when(bin_ >= UNDER, bin_).when(bin_ == OVER, F.lit(bins).cast("long")).alias("bin"),
        F.when(bin_ >= 0, F.lit(start) + bin_ * step).when(bin_ == UNDER, -infinite).when(bin_ == OVER, F.lit(start + width)).alias("lower"),
        F.when(bin_ >= 0, F.lit(start) + (bin_ + 1) * step).when(bin_ == UNDER, F.lit(start)).when(bin_ == OVER, infinite).alias("upper"),
        n.alias("n"),
        (bin_ >= 0).alias("_inside"),
    )
    return rows.filter(F.col("_inside") | (F.col("n") > 0)).drop("_inside")


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``equal_width_histograms`` of all rows together."""
    return equal_width_histograms(df, column, bins)


def scatter_grid(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Occupied cells of a ``bins`` x ``bins`` grid over the rows in which both columns are finite."""
    present = df.filter(is_finite(F.col(x).cast("double")) & is_finite(F.col(y).cast("double")))
    x0, x1, y0, y1 = _finite_bounds(present, x, y)

    def number(c: str, low: float, high: float):
        return equal_width_bin(F.col(c).cast("double"), F.lit(low), F.lit(high), bins).cast("long")

    return present.groupBy(number(x, x0, x1).alias("x_bin"), number(y, y0, y1).alias("y_bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def target_by_category(
    df: DataFrame, features: Sequence[str], target: str, top: int = 10
) -> DataFrame:
    """Count, mean and median of the target for the categories with the highest mean.

    (feature, category, place, count, mean, median), ``top`` places per feature.
    The places are settled first, so exact medians are looked for in at most
    ``top`` groups per feature, however many categories there are.
    """
    y = F.col(target).cast("double")
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in features]
    )
    order = Window.partitionBy("feature").orderBy(F.col("mean").desc(), F.col("category"))
    leaders = (
        df.select(F.inline(cells), y.alias("y"))
        .filter(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count("y").alias("count"), F.avg("y").alias("mean"))
        .withColumn("place", F.row_number().over(order).cast("long"))
        .filter(F.col("place") <= top)
    )
    spark = df.sparkSession
    found = spark.createDataFrame(leaders.collect(), leaders.schema)  # ``top`` rows per feature
    wanted = found.select("feature", "category")
    members = df.select(F.inline(cells), y.alias("y")).join(F.broadcast(wanted), ["feature", "category"])
    medians = exact_quantiles(members, ["y"], [0.5], by=["feature", "category"])
    medians = medians.select("feature", "category", F.col("value").alias("median"))
    return found.join(medians, ["feature", "category"], "left")


def correlation_with_target(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every other numeric column with the target.

    One aggregate for all columns. ``place_by_strength`` orders by absolute
    value, strongest first; ``place_by_value`` from lowest to highest.
    """
    return correlation_part(df, target, exclude).alone(df)


def correlation_part(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> Part:
    """``correlation_with_target`` as a part of a scan."""
    columns = [c for c in columns_of_type(df, "numeric") if c != target and c not in exclude]
    t = F.col(target).cast("double")
    # One row per numeric column in the windows.
    strength = Window.orderBy(F.abs("correlation").desc_nulls_last(), "feature")
    value = Window.orderBy(F.col("correlation").asc_nulls_last(), "feature")

    def result(row: DataFrame) -> DataFrame:
        return unpivoted(row, "feature", "correlation", {c: c for c in columns}).select(
            "feature",
            "correlation",
            F.row_number().over(strength).cast("long").alias("place_by_strength"),
            F.row_number().over(value).cast("long").alias("place_by_value"),
        )

    return Part({c: F.corr(F.col(f"`{c}`").cast("double"), t) for c in columns}, result)
