"""Encoded feature importances rolled up to the columns they came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions.scalars import base_feature, is_finite, nan_to_null
from ridgeline.sources.scratch import staged

# Fixed value: how far the importances of a model may sum up beside 1.
TOTAL_TOLERANCE = 0.01


def rolled_up(encoded: DataFrame, features: Sequence[str]) -> DataFrame:
    """(model, feature, importance_encoded) summed per base feature, unknown ones included.

    ``encoded`` has (model, feature, importance); importances that are not
    numbers count as missing.
    """
    value = nan_to_null(F.expr("try_cast(importance AS double)"))
    return (
        encoded.select("model", base_feature(F.col("feature"), features).alias("feature"), value.alias("v"))
        .groupBy("model", "feature")
        .agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("importance_encoded"))
    )


def expected_set_check(rolled: DataFrame, features: Sequence[str]) -> DataFrame:
    """(model, feature, problem) for features that are missing or extra."""
    wanted = F.explode(F.array(*[F.lit(f) for f in features])).alias("feature")
    expected = rolled.select("model").distinct().select("model", wanted)
    missing = expected.join(rolled, ["model", "feature"], "left_anti").withColumn("problem", F.lit("missing"))
    extra = rolled.filter(~F.col("feature").isin(*features)).select("model", "feature", F.lit("extra").alias("problem"))
    return missing.unionByName(extra)


def importance_checks(rolled: DataFrame) -> DataFrame:
    """Per model: features, non-finite, negative, total, and whether it is about 1."""
    v = F.col("importance_encoded")
    return rolled.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(~is_finite(v)).alias("n_not_finite"),
        F.count_if(v < 0).alias("n_negative"),
        F.sum(v).alias("total"),
        (F.abs(F.sum(v) - 1) <= TOTAL_TOLERANCE + 1e-5).alias("total_is_one"),
    )


def ranked(rolled: DataFrame, features: Sequence[str]) -> DataFrame:
    """Expected features with ``importance`` and ``rank``; equal values share the lowest rank.

    At most one row per model and expected feature reaches the window.
    """
    order = Window.partitionBy("model").orderBy(F.col("importance").desc())
    return (
        rolled.filter(F.col("feature").isin(*features))
        .withColumn("importance", F.col("importance_encoded"))
        .withColumn("rank", F.rank().over(order))
    )


def importance_rollup(encoded: DataFrame, features: Sequence[str], strict: bool = True) -> DataFrame:
    """Roll up, check and rank; with ``strict`` a missing feature or bad value raises.

    Extra features are dropped from the result; ``expected_set_check`` lists them.
    """
    rolled = staged(rolled_up(encoded, features), "importances")  # the checks and the result read it
    if strict:
        missing = expected_set_check(rolled, features).filter("problem = 'missing'").collect()
        if missing:
            raise ValueError("missing features: " + ", ".join(f"{r['model']}: {r['feature']}" for r in missing))
        kept = rolled.filter(F.col("feature").isin(*features))
        bad = importance_checks(kept).filter("n_not_finite > 0 OR n_negative > 0").collect()
        if bad:
            raise ValueError("bad importances: " + ", ".join(r["model"] for r in bad))
    return ranked(rolled, features)


def top_features(ranked_importances: DataFrame, k: int = 5) -> DataFrame:
    """First ``k`` features of every model; ties go by name."""
    order = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    placed = ranked_importances.withColumn("place", F.row_number().over(order).cast("long"))
    return placed.filter(F.col("place") <= k).select("model", "place", "feature", "importance")


def importance_totals(ranked_importances: DataFrame) -> DataFrame:
    return ranked_importances.groupBy("model").agg(F.sum("importance").alias("total"))


def importance_by_model(ranked_importances: DataFrame, models: Sequence[str]) -> DataFrame:
    """One column per model, missing as 0, ordered by the larger of the two."""
    wide = (
        ranked_importances.groupBy("feature").pivot("model", list(models)).agg(F.first("importance")).na.fill(0.0)
    )
    strongest = F.greatest(*[F.col(f"`{m}`") for m in models]) if len(models) > 1 else F.col(f"`{models[0]}`")
    return wide.withColumn("strongest", strongest).orderBy("strongest", "feature")
