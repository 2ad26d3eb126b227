"""Comparison of two finished runs from their exported tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.scalars import depth_text
from ridgeline.model import Roles
from ridgeline.operators import comparison as C
from ridgeline.operators import distribution as D
from ridgeline.operators import importance as I
from ridgeline.operators.splitting import seeded_sample
from ridgeline.sources.files import read_csv, require_columns, write_small_csv, write_table
from ridgeline.sources.results import Layout, read_mapped
from ridgeline.sources.run_info import parse_run_info
from ridgeline.sources.scratch import staged


@dataclass(frozen=True)
class Run:
    """Result tables of one model under a common name."""

    name: str
    framework: str
    mode: str
    metrics: DataFrame
    search: DataFrame
    search_place: str
    search_metric: str
    search_seconds: str
    label: Column
    importances: DataFrame
    predictions: DataFrame
    run_info: DataFrame | None = None


def forest_label(trees: str, depth: str, leaf: str | None = None) -> Column:
    """Configuration text, for example ``trees=200, depth=None, min_leaf=2``."""
    parts = [F.lit(f"{trees}="), F.col(trees).cast("int").cast("string"), F.lit(f", {depth}="), depth_text(F.col(depth))]
    if leaf:
        parts += [F.lit(f", {leaf}="), F.col(leaf).cast("int").cast("string")]
    return F.concat(*parts)


PREDICTION_SCHEMA = "{id} long, actual_{target} double, predicted_{target} double"
METRIC_SCHEMA = (
    "split string, n long, MAE double, RMSE double, R2 double, predict_seconds double, trees int, depth int, min_leaf int"
)
BASELINE_SCHEMA = "split string, n long, MAE double, RMSE double, R2 double"
SEARCH_SCHEMA = (
    "place long, trees int, depth int, min_leaf int, validation_MAE double, validation_RMSE double, "
    "validation_R2 double, fit_seconds double, predict_seconds double"
)
IMPORTANCE_SCHEMA = "feature string, importance double"
# Bins of the drawn histograms, and rows of the drawn sample.
BINS, SAMPLE = 55, 5000


def load_run(
    spark: SparkSession, out: str, name: str, framework: str, roles: Roles, with_run_info: bool = True
) -> Run:
    """The exported tables of a training run."""

    def csv(table: str, ddl: str) -> DataFrame:
        return read_csv(spark, f"{out}/{table}", T.StructType.fromDDL(ddl))

    predictions = T.StructType.fromDDL(PREDICTION_SCHEMA.format(id=roles.id, target=roles.target))
    return Run(
        name=name,
        framework=framework,
        mode=spark.sparkContext.master,
        metrics=csv("metrics", METRIC_SCHEMA),
        search=csv("param_search_results", SEARCH_SCHEMA),
        search_place="place",
        search_metric="validation_RMSE",
        search_seconds="fit_seconds",
        label=forest_label("trees", "depth", "min_leaf"),
        importances=csv("feature_importance", IMPORTANCE_SCHEMA),
        predictions=spark.read.schema(predictions).parquet(f"{out}/test_predictions"),
        run_info=parse_run_info(spark, f"{out}/run_info/text") if with_run_info else None,
    )


@dataclass(frozen=True)
class Files:
    """Where another program has put its results; ``run_info`` is the text form, if there is one."""

    metrics: str
    search: str
    importances: str
    predictions: str
    run_info: str | None = None


def load_results(spark: SparkSession, files: Files, layout: Layout, name: str, mode: str, roles: Roles) -> Run:
    """Results in the layout of another program, under the names that a comparison takes."""
    return Run(
        name=name,
        framework=layout.framework,
        mode=mode,
        metrics=read_mapped(spark, files.metrics, layout.metrics),
        search=read_mapped(spark, files.search, layout.search),
        search_place="place",
        search_metric="validation_RMSE",
        search_seconds="fit_seconds",
        label=layout.configuration(),
        importances=read_mapped(spark, files.importances, layout.importances),
        predictions=read_mapped(spark, files.predictions, layout.predictions(roles)),
        run_info=parse_run_info(spark, files.run_info) if files.run_info else None,
    )


def model_summary(runs: Sequence[Run]) -> DataFrame:
    """One line per run: framework, best configuration, size of the search, times and mode."""
    out = None
    for r in runs:
        best = C.best_configuration(r.search, r.search_metric, r.search_place, r.label, r.search_seconds)
        line = C.summary_row(best, r.name, r.framework, r.mode, r.run_info)
        out = line if out is None else out.unionByName(line)
    return out


def comparison_tables(first: Run, second: Run, roles: Roles) -> dict[str, DataFrame]:
    """All tables of the comparison; ``second`` is judged against ``first``."""
    runs = (first, second)
    for run in runs:
        require_columns(run.metrics, ["split", *C.METRICS], f"{run.name} metrics")
        require_columns(run.importances, ["feature", "importance"], f"{run.name} importances")
        require_columns(
            run.predictions, [roles.id, f"actual_{roles.target}", f"predicted_{roles.target}"], f"{run.name} predictions"
        )
    metrics = C.metric_table({r.name: r.metrics for r in runs})
    # Joined and checked once; five tables read it.
    compared = staged(
        C.compare_predictions(first.predictions, second.predictions, roles.id, roles.target, ("first", "second")), "compared"
    )
    encoded = None
    for r in runs:
        part = r.importances.select(F.lit(r.name).alias("model"), "feature", "importance")
        encoded = part if encoded is None else encoded.unionByName(part)
    whole = I.rolled_up(encoded, roles.features)
    rolled = I.importance_rollup(encoded, roles.features).orderBy("model", "rank", "feature")
    errors = [compared.select(F.lit(r.name).alias("model"), F.col(f"error_{side}").alias("error")) for r, side in zip(runs, ("first", "second"))]
    return {
        "comparison_metrics": metrics,
        "metric_deltas": C.metric_deltas(metrics, first.name, second.name),
        "generalisation_gap": C.generalisation_gap(metrics),
        "model_summary": model_summary(runs),
        "feature_importance_comparison": rolled,
        # The roll-up raises on missing features and bad values; these two report totals and extra ones.
        "importance_checks": I.importance_checks(whole),
        "importance_extra": I.expected_set_check(whole, roles.features),
        "importance_totals": I.importance_totals(rolled),
        "top_features": I.top_features(rolled),
        "importance_by_model": I.importance_by_model(rolled, [r.name for r in runs]),
        "prediction_difference": C.prediction_difference(compared, roles.target),
        "prediction_bounds": C.value_bounds(compared, [f"actual_{roles.target}", "prediction_first", "prediction_second"]),
        "error_histogram": D.equal_width_histograms(errors[0].unionByName(errors[1]), "error", BINS, "model"),
        "difference_histogram": D.equal_width_histogram(compared, "prediction_difference", BINS),
        "prediction_sample": seeded_sample(compared, roles.id, SAMPLE).orderBy(roles.id),
        "prediction_comparison": compared,
    }


def run_comparison(first: Run, second: Run, roles: Roles, out: str) -> dict[str, DataFrame]:
    """Write the tables under ``out``: the row-level one by the executors, the rest as small files."""
    tables = comparison_tables(first, second, roles)
    for name, frame in tables.items():
        if name == "prediction_comparison":
            write_table(frame, f"{out}/{name}")
        else:
            write_small_csv(frame, f"{out}/{name}")
    return tables
