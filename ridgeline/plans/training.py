"""Split, encode, search, evaluate and export: a whole training run."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions.scalars import split_position
from ridgeline.model import SPLITS, Roles
from ridgeline.operators import distribution as D
from ridgeline.operators import features as X
from ridgeline.operators import regression as R
from ridgeline.operators.matching import require_reconciled
from ridgeline.operators.splitting import seeded_sample, stratified_split
from ridgeline.sources.files import require_columns, write_small_csv, write_table
from ridgeline.sources.run_info import run_info, write_run_info
from ridgeline.sources.scratch import staged


@dataclass
class Prepared:
    """All splits with feature vectors, written once, and the encoder fitted on train alone."""

    rows: DataFrame
    encoder: X.Encoder
    fit_seconds: float

    def split(self, name: str) -> DataFrame:
        return self.rows.filter(F.col("split") == name)


def prepare(df: DataFrame, roles: Roles, encoder: str = "keep", scale: bool = False, invalid: str = "error") -> Prepared:
    """Encode ``df``, which has a ``split`` column, with an encoder fitted on train.

    ``encoder`` is "keep" (a slot for unknown levels) or "ignore" (all zeros).
    ``scale`` applies to "keep": the whole vector, at the price of dense rows.
    ``invalid`` says what a missing number does. Hand in a scan, or projections of one.
    """
    train = df.filter(F.col("split") == SPLITS[0])
    if encoder == "ignore":
        fitted, seconds = R.timed(lambda: X.fit_ignore_unknown(train, roles))
    else:
        fitted, seconds = R.timed(lambda: X.fit_keep_unknown(train, roles, scale))
    wanted = list(dict.fromkeys([roles.id, roles.target, "split", *roles.features]))
    rows = fitted.transform(df.select(*wanted), invalid)
    return Prepared(rows.select(roles.id, roles.target, "split", "features"), fitted, seconds)


def training_rows(prepared: Prepared, roles: Roles) -> DataFrame:
    """Identifier, label and vector of the training rows in their fixed layout, like rows side by side."""
    vectors = prepared.split(SPLITS[0]).select(roles.id, roles.target, "features")
    count = prepared.encoder.train_rows
    laid = R.training_layout(vectors, roles.id, count)
    return R.alike_together(laid, roles.id, roles.target, count)


def split_metrics(predicted: DataFrame, roles: Roles) -> DataFrame:
    """(split, n, MAE, RMSE, R2) from one pass, in the order train, validation, test."""
    return R.regression_metrics(predicted, roles.target, "prediction", "split").orderBy(
        split_position(F.col("split"))
    )


def baseline(prepared: Prepared, roles: Roles, config: R.ForestConfig = R.BASELINE) -> DataFrame:
    """Train and validation metrics of one small forest; test rows stay unseen."""
    with R.kept(training_rows(prepared, roles)) as train:
        model = R.fit_forest(train, config, roles.target)
    seen = prepared.rows.filter(F.col("split") != SPLITS[2])
    return split_metrics(model.transform(seen), roles)


@dataclass
class Trained:
    prepared: Prepared
    search: R.Search
    predicted: DataFrame
    metrics: DataFrame
    importances: DataFrame


def train_and_evaluate(
    prepared: Prepared, roles: Roles, grid: Sequence[R.ForestConfig], seed: int = R.SEED, journal: str | None = None
) -> Trained:
    """Search on validation rows, then score the kept model on every split at once.

    With a ``journal`` folder, which must be shared by the cluster, configurations
    that were finished before are not fitted again.
    """
    with R.kept(training_rows(prepared, roles)) as train:
        kept = R.Journal(train, journal, roles.target, roles.id, seed) if journal else None
        search = R.grid_search(train, prepared.split(SPLITS[1]), grid, roles.target, seed, kept)
    importances = R.feature_importances(search.model, prepared.encoder.names())
    predicted = R.predicted(search.model, prepared.rows)
    return Trained(prepared, search, predicted, split_metrics(predicted, roles), importances)


def timed_scores(prepared: Prepared, model, roles: Roles, best: R.ForestConfig) -> tuple[DataFrame, DataFrame]:
    """(scored rows, metrics): every split is scored on its own, so that its seconds are its own.

    The metrics carry the seconds and the configuration beside MAE, RMSE and R2.
    """
    scored, seconds = None, []
    for split in SPLITS:
        rows = R.predicted(model, prepared.split(split)).select(roles.id, roles.target, "split", "prediction")
        part, took = R.timed(lambda rows=rows: staged(rows, "scored"))
        seconds.append((split, took, best.trees, best.depth, best.min_leaf))
        scored = part if scored is None else scored.unionByName(part)
    facts = scored.sparkSession.createDataFrame(seconds, "split string, predict_seconds double, trees int, depth int, min_leaf int")
    metrics = split_metrics(scored, roles).join(F.broadcast(facts), "split").orderBy(split_position(F.col("split")))
    return scored, metrics


def residual_tables(scored: DataFrame, roles: Roles, seed: int = R.SEED, bins: int = 60, size: int = 3000) -> dict[str, DataFrame]:
    """What is drawn of the test predictions: residual counts over all rows, and a seeded sample of rows."""
    predictions = R.prediction_table(scored.filter(F.col("split") == SPLITS[2]), roles.id, roles.target)
    actual, predicted = f"actual_{roles.target}", f"predicted_{roles.target}"
    errors = R.with_errors(predictions, actual, predicted, "test")
    return {
        "residual_histogram": D.equal_width_histogram(errors, "error_test", bins),
        "prediction_sample": seeded_sample(errors, roles.id, size, seed).orderBy(roles.id),
    }


def run_training(
    spark: SparkSession,
    table: DataFrame,
    roles: Roles,
    out: str,
    grid: Sequence[R.ForestConfig] = R.DISTRIBUTED_GRID,
    encoder: str = "keep",
    scale: bool = False,
    baseline_only: bool = False,
    seed: int = R.SEED,
    baseline_config: R.ForestConfig = R.BASELINE,
) -> dict[str, DataFrame]:
    """Everything from the measurement table to the exported result tables.

    Writes the check of the vectors, the baseline's metrics, the search with its
    finished models (a run that broke off goes on there), metrics with seconds
    and configuration, importances, encoder and best model, test and validation
    predictions, residual counts, a sample of predictions, and the run info under
    ``out``; with ``baseline_only`` it stops after the baseline.
    """
    start = time.perf_counter()
    require_columns(table, roles.columns, "training table")
    source = staged(table.select(*roles.columns), "training")
    # Written once: the split is hashed for every row, and all later steps read it.
    rows = staged(stratified_split(source, roles.id, roles.target, seed), "split")
    prepared = prepare(rows, roles, encoder, scale)
    check = X.feature_matrix_check(prepared.rows, "split").orderBy(split_position(F.col("split")))
    results = {"vector_check": check, "baseline_metrics": baseline(prepared, roles, baseline_config)}
    if baseline_only:
        for name, frame in results.items():
            write_small_csv(frame, f"{out}/{name}")
        return results

    done = train_and_evaluate(prepared, roles, grid, seed, f"{out}/search")
    model = done.search.model
    prepared.encoder.save(f"{out}/model")
    model.write().overwrite().save(f"{out}/model/forest")
    # Scored once; metrics and exports read what was written.
    scored, metrics = timed_scores(prepared, model, roles, done.search.best)
    results |= {
        "metrics": metrics,
        "param_search_results": done.search.results.orderBy("validation_RMSE", "place"),
        "feature_importance": done.importances.orderBy(F.col("importance").desc(), "feature"),
        **residual_tables(scored, roles, seed),
    }
    for name, frame in results.items():
        write_small_csv(frame, f"{out}/{name}")
    for split in SPLITS[1:]:
        part = scored.filter(F.col("split") == split)
        require_reconciled(part, rows.filter(F.col("split") == split), roles.id, roles.target)
        write_table(R.prediction_table(part, roles.id, roles.target), f"{out}/{split}_predictions")
    parts = tuple(rows.filter(F.col("split") == s).rdd.getNumPartitions() for s in SPLITS)
    seconds = (prepared.fit_seconds, done.search.fit_seconds, time.perf_counter() - start)
    info = run_info(spark, parts, seconds, done.search.best, seed, metrics)
    write_run_info(info, f"{out}/run_info")
    return {**results, "run_info": info}
