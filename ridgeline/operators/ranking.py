"""Positions of rows in a global order, without a task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.sources.scratch import staged

RANGE = "_range"


def with_places(df: DataFrame, by: Sequence[str], order: Sequence[Column], place: str) -> DataFrame:
    """``df`` with the 0-based place of every row among the rows of its group.

    Rows are dealt to ranges of the order and written once with the number of
    their range. A place is the number of rows in the group's earlier ranges,
    a table with one row per range and one more per group, plus the place within
    the range. ``order`` must tell all rows of a group apart.
    """
    columns = df.columns
    ranged = staged(df.repartitionByRange(*by, *order).withColumn(RANGE, F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(*by, RANGE).agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select(*by, RANGE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(*by, RANGE).orderBy(*order)) - 1
    joined = ranged.withColumn("_within", within).join(starts, [*by, RANGE])
    return joined.select(*columns, (F.col("_start") + F.col("_within")).alias(place))


def with_starts(df: DataFrame, order: Sequence[Column], size: str, start: str) -> DataFrame:
    """``df`` with the sum of ``size`` over all earlier rows of an order, which must tell the rows apart.

    Sums of ranges are one number per range, which the driver adds up; the sums
    within a range are taken where the range is.
    """
    columns = df.columns
    ranged = staged(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(RANGE).agg(F.sum(size).cast("long").alias("_sum")).orderBy(RANGE).collect()
    starts, total = [], 0
    for row in sums:
        starts.append((row[RANGE], total))
        total += row["_sum"]
    offsets = df.sparkSession.createDataFrame(starts, f"{RANGE} int, _start long")
    within = F.sum(size).over(Window.partitionBy(RANGE).orderBy(*order)) - F.col(size)
    joined = ranged.withColumn("_within", within).join(F.broadcast(offsets), RANGE)  # one row per range
    return joined.select(*columns, (F.col("_start") + F.col("_within")).alias(start))
