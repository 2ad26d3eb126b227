"""Two models side by side: metrics, gaps, predictions, configurations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.scalars import split_position, verdict
from ridgeline.model import SPLITS
from ridgeline.operators.matching import one_to_one_join, required_agreement
from ridgeline.operators.regression import with_errors

METRICS = ("MAE", "RMSE", "R2")


def metric_table(by_model: dict[str, DataFrame]) -> DataFrame:
    """(split, MAE, RMSE, R2, model) of all models, in order of split and model."""
    frames = [df.select("split", *METRICS, F.lit(m).alias("model")) for m, df in by_model.items()]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked.orderBy(split_position(F.col("split")), "model")


def _wide(metrics: DataFrame, index: Sequence[str], column: str, values: Sequence[str], measure: str) -> DataFrame:
    return metrics.groupBy(*index).pivot(column, list(values)).agg(F.first(measure))


def metric_deltas(metrics: DataFrame, baseline: str, candidate: str, split: str = "test") -> DataFrame:
    """(metric, baseline, candidate, difference, percent, verdict) on one split."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])
    long = metrics.filter(F.col("split") == split).select("model", F.inline(cells))
    wide = _wide(long, ["metric"], "model", [baseline, candidate], "value")
    difference = F.col("candidate") - F.col("baseline")
    return (
        wide.withColumnsRenamed({baseline: "baseline", candidate: "candidate"})
        .withColumn("difference", difference)
        .withColumn("percent", F.try_divide(F.abs("difference"), F.col("baseline")) * 100)
        .withColumn("verdict", verdict(F.col("metric"), F.col("difference")))
    )


def generalisation_gap(metrics: DataFrame) -> DataFrame:
    """(model, train_rmse, test_rmse, gap): how much worse a model is on new rows."""
    train, _, test = SPLITS
    wide = _wide(metrics, ["model"], "split", [train, test], "RMSE")
    return wide.select(
        "model",
        F.col(train).alias("train_rmse"),
        F.col(test).alias("test_rmse"),
        (F.col(test) - F.col(train)).alias("gap"),
    )


def compare_predictions(
    first: DataFrame, second: DataFrame, key: str, label: str, names: tuple[str, str]
) -> DataFrame:
    """Errors of two models on the same records and the difference of their predictions.

    Inputs have (key, actual_<label>, predicted_<label>). Running the result
    fails on repeated keys and on actual values that differ.
    """
    a, b = names
    actual = f"actual_{label}"
    left = first.select(key, actual, F.col(f"predicted_{label}").alias(f"prediction_{a}"))
    right = second.select(key, actual, F.col(f"predicted_{label}").alias(f"prediction_{b}"))
    joined = one_to_one_join(left, right, key, (f"_{a}", f"_{b}"))
    joined = required_agreement(joined, f"{actual}_{a}", f"{actual}_{b}").withColumnRenamed(f"{actual}_{a}", actual)
    for name in names:
        joined = with_errors(joined, actual, f"prediction_{name}", name)
    return joined.withColumn("prediction_difference", F.col(f"prediction_{b}") - F.col(f"prediction_{a}"))


def prediction_difference(compared: DataFrame, label: str) -> DataFrame:
    """One row: records, mean and mean absolute difference, all actuals present."""
    d = F.col("prediction_difference")
    return compared.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(d).alias("mean_difference"),
        F.avg(F.abs(d)).alias("mean_absolute_difference"),
        F.coalesce(F.bool_and(F.col(f"actual_{label}").isNotNull()), F.lit(True)).alias("all_actual_present"),
    )


def value_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the smallest and largest value over several columns."""
    low, high = [F.min(c) for c in columns], [F.max(c) for c in columns]
    if len(columns) == 1:
        return df.agg(low[0].alias("low"), high[0].alias("high"))
    return df.agg(F.least(*low).alias("low"), F.greatest(*high).alias("high"))


def best_configuration(
    search: DataFrame, metric: str, place: str, label: Column, train_seconds: str
) -> DataFrame:
    """One row: the configuration with the lowest metric, the earlier one on ties."""
    best = F.min_by(F.struct(label.alias("text"), F.col(metric), F.col(train_seconds)), F.struct(metric, place))
    row = search.filter(F.col(metric).isNotNull()).agg(best.alias("b"), F.count(F.lit(1)).alias("n"))
    return row.select(
        F.col("b.text").alias("best_configuration"),
        F.col("n").alias("tuning_configurations"),
        F.col(f"b.{metric}").alias("best_validation_rmse"),
        F.col(f"b.{train_seconds}").alias("best_train_time_s"),
    )


SUMMARY_COLUMNS = (
    "model",
    "framework",
    "best_configuration",
    "tuning_configurations",
    "best_validation_rmse",
    "best_train_time_s",
    "pipeline_time_s",
    "execution_mode",
)


def summary_row(
    best: DataFrame, model: str, framework: str, mode: str, run_info: DataFrame | None = None
) -> DataFrame:
    """One line of the model summary.

    With the one-row ``run_info`` its times and master replace the searched fit
    time, the empty run time and ``mode``.
    """
    row = best.withColumns({"model": F.lit(model), "framework": F.lit(framework)})
    info = run_info.first() if run_info is not None else None
    if info is not None:
        row = row.withColumn("best_train_time_s", F.lit(info["final_train_time_s"]).cast("double"))
        mode = info["spark_master"] or mode
    whole = F.lit(info["pipeline_time_s"] if info is not None else None).cast("double")
    return row.withColumns({"pipeline_time_s": whole, "execution_mode": F.lit(mode)}).select(*SUMMARY_COLUMNS)
