"""Run metadata: a typed one-row table, its text form, and reading that text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.model import SPLITS
from ridgeline.operators.regression import ForestConfig

FINAL_METRICS = [f"{split}_{metric}" for split in SPLITS for metric in ("MAE", "RMSE", "R2")]
RUN_INFO_SCHEMA = (
    "spark_version string, spark_master string, mode string, app_name string, default_parallelism long, executors string, "
    "train_partitions long, validation_partitions long, test_partitions long, "
    "preprocessing_fit_time_s double, final_train_time_s double, pipeline_time_s double, "
    "best_num_trees long, best_max_depth long, seed long, "
) + ", ".join(f"{name} double" for name in FINAL_METRICS)

# How each entry is written in the text form, in order.
LABELS = {
    "spark_version": "Spark Version: {}",
    "spark_master": "Spark Master: {}",
    "mode": "Mode: {}",
    "app_name": "App Name: {}",
    "default_parallelism": "Default Parallelism: {}",
    "executors": "Executor/Worker Info: {}",
    "train_partitions": "Train partitions: {}",
    "validation_partitions": "Validation partitions: {}",
    "test_partitions": "Test partitions: {}",
    "preprocessing_fit_time_s": "Preprocessing fit time: {}s",
    "final_train_time_s": "Final model training time: {}s",
    "pipeline_time_s": "Whole pipeline execution time: {}s",
    "best_num_trees": "numTrees: {}",
    "best_max_depth": "maxDepth: {}",
    "seed": "seed: {}",
    "train_MAE": "Train MAE: {}",
    "train_RMSE": "Train RMSE: {}",
    "train_R2": "Train R²: {}",
    "validation_MAE": "Validation MAE: {}",
    "validation_RMSE": "Validation RMSE: {}",
    "validation_R2": "Validation R²: {}",
    "test_MAE": "Test MAE: {}",
    "test_RMSE": "Test RMSE: {}",
    "test_R2": "Test R²: {}",
}

# Patterns of the entries that are read back, with their types.
PATTERNS = {
    "spark_version": (r"Spark Version:[ \t]*(.+)", "string"),
    "spark_master": (r"Spark Master:[ \t]*(.+)", "string"),
    "preprocessing_fit_time_s": (r"Preprocessing fit time:\s*([\d.]+)s", "double"),
    "final_train_time_s": (r"Final model training time:\s*([\d.]+)s", "double"),
    "pipeline_time_s": (r"Whole pipeline execution time:\s*([\d.]+)s", "double"),
    "best_num_trees": (r"numTrees:\s*(\d+)", "long"),
    "best_max_depth": (r"maxDepth:\s*(\d+)", "long"),
    "mode": (r"Mode:[ \t]*(.+)", "string"),
    "executors": (r"Executor/Worker Info:[ \t]*(.+)", "string"),
    "train_MAE": (r"Train MAE:\s*([-\d.]+)", "double"),
    "train_RMSE": (r"Train RMSE:\s*([-\d.]+)", "double"),
    "train_R2": (r"Train R²:\s*([-\d.]+)", "double"),
    "validation_MAE": (r"Validation MAE:\s*([-\d.]+)", "double"),
    "validation_RMSE": (r"Validation RMSE:\s*([-\d.]+)", "double"),
    "validation_R2": (r"Validation R²:\s*([-\d.]+)", "double"),
    "test_MAE": (r"Test MAE:\s*([-\d.]+)", "double"),
    "test_RMSE": (r"Test RMSE:\s*([-\d.]+)", "double"),
    "test_R2": (r"Test R²:\s*([-\d.]+)", "double"),
}


def execution_mode(spark: SparkSession) -> tuple[str, str]:
    """(mode, executors): local or cluster with the master, and how many executors the cluster has registered."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        return f"Local mode: {sc.master}", "N/A (local mode)"
    known = sc._jsc.sc().getExecutorMemoryStatus().size() - 1  # the driver is one of them
    return f"Cluster mode: {sc.master}", f"Executors: {known}"


def run_info(
    spark: SparkSession,
    partitions: tuple[int, int, int],
    seconds: tuple[float, float, float],
    best: ForestConfig,
    seed: int,
    metrics: DataFrame,
) -> DataFrame:
    """One typed row about a finished run; ``seconds`` are fit, final training, whole.

    ``metrics`` has (split, MAE, RMSE, R2); a split that it lacks gives NULLs.
    """
    sc = spark.sparkContext
    mode, executors = execution_mode(spark)
    by_split = {r["split"]: r for r in metrics.collect()}  # one row per split
    final = [by_split[s][m] if s in by_split else None for s in SPLITS for m in ("MAE", "RMSE", "R2")]
    row = (
        spark.version,
        sc.master,
        mode,
        sc.appName,
        sc.defaultParallelism,
        executors,
        *partitions,
        *(float(s) for s in seconds),
        best.trees,
        best.depth,
        seed,
        *final,
    )
    return spark.createDataFrame([row], RUN_INFO_SCHEMA)


def run_info_text(info: DataFrame) -> DataFrame:
    """One row with the text form: a line per entry, times with two decimals, metrics with four."""
    lines = []
    for name, label in LABELS.items():
        digits = 2 if name.endswith("_s") else 4 if name in FINAL_METRICS else None
        # NULL stays NULL: formatted, it would read "null".
        number = F.when(F.col(name).isNotNull(), F.format_string(f"%.{digits}f", name))
        value = F.col(name).cast("string") if digits is None else number
        before, after = label.split("{}")
        lines.append(F.concat(F.lit(before), F.coalesce(value, F.lit("None")), F.lit(after)))
    return info.select(F.array_join(F.array(*lines), "\n").alias("value"))


def write_run_info(info: DataFrame, path: str) -> None:
    """The typed row as JSON, and its text form beside it."""
    info.write.mode("overwrite").json(f"{path}/json")
    run_info_text(info).coalesce(1).write.mode("overwrite").text(f"{path}/text")


def parse_run_info(spark: SparkSession, path: str) -> DataFrame:
    """Read the text form back; an entry that is absent or malformed is NULL."""
    text = spark.read.text(path, wholetext=True)  # a page of text per file

    def entry(name: str):
        pattern, type_name = PATTERNS[name]
        found = F.nullif(F.trim(F.regexp_extract("value", pattern, 1)), F.lit(""))
        return found.try_cast(type_name).alias(name)

    return text.select(*[entry(n) for n in PATTERNS])
