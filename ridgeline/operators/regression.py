"""Random-forest regression: fit, predict, metrics, search, importances."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.operators.forest import Binned, binned, fit

SEED = 42
# Spark ML grows trees to at most this depth; "no limit" is mapped to it.
DEEPEST = 30
# The layout of the training rows decides which rows a bootstrap draws, so it
# follows from the number of rows alone, never from the size of the cluster.
ROWS_PER_PARTITION = 60_000
FEWEST_PARTITIONS = 8
# One tree says which rows are alike; neighbours in a partition then meet the same
# nodes, whose statistics the core still holds. It decides the order of the rows
# and nothing else, so a bounded number of them, in one task, is enough for it.
# One task adds up in a fixed order, so the same rows give the same tree.
GUIDE_ROWS = 60_000
GUIDE_DEPTH = 12
# Memory for the node statistics of the guiding tree.
NODE_MEMORY_MB = 512
# Widest vector that is scored with its zeros written out.
FULL_WIDTH = 1_000


@dataclass(frozen=True)
class ForestConfig:
    trees: int
    depth: int | None = None
    min_leaf: int = 1


# The baseline and the two searched grids.
BASELINE = ForestConfig(50, 8)
DISTRIBUTED_GRID = (
    ForestConfig(50, 8),
    ForestConfig(100, 8),
    ForestConfig(100, 12),
    ForestConfig(200, 12),
)
SINGLE_NODE_GRID = (
    ForestConfig(100, None, 1),
    ForestConfig(100, 20, 1),
    ForestConfig(100, 30, 2),
    ForestConfig(200, None, 1),
    ForestConfig(200, 20, 2),
    ForestConfig(200, 30, 4),
    ForestConfig(300, None, 2),
    ForestConfig(300, 30, 2),
)


def training_layout(df: DataFrame, id_column: str, rows: int) -> DataFrame:
    """Rows hashed by id into a number of partitions fixed by the row count, sorted.

    The same rows give the same forest, however they were stored before.
    """
    partitions = max(FEWEST_PARTITIONS, -(-rows // ROWS_PER_PARTITION))
    return df.repartition(partitions, id_column).sortWithinPartitions(id_column)


def alike_together(laid: DataFrame, id_column: str, label: str, rows: int, features: str = "features") -> DataFrame:
    """``laid`` in its partitions, all of its rows, sorted by the leaf of one guiding tree, then by id."""
    every = -(-rows // GUIDE_ROWS) if rows else 1
    some = laid.filter(F.pmod(F.xxhash64(id_column), F.lit(every)) == 0)
    with kept(some.repartition(1).sortWithinPartitions(id_column)) as guide:
        if guide.isEmpty():
            return laid
        tree = DecisionTreeRegressor(
            featuresCol=features,
            labelCol=label,
            predictionCol="_guess",
            leafCol="_leaf",
            maxDepth=GUIDE_DEPTH,
            maxMemoryInMB=NODE_MEMORY_MB,
            seed=SEED,
        ).fit(guide)
    return tree.transform(laid).sortWithinPartitions("_leaf", id_column).select(laid.columns)


class kept:
    """Hold a frame in memory and on disk for a block; lost parts are recomputed."""

    def __init__(self, df: DataFrame):
        self.df = df

    def __enter__(self) -> DataFrame:
        return self.df.persist(StorageLevel.MEMORY_AND_DISK)

    def __exit__(self, *_):
        self.df.unpersist()


def fit_forest(
    train: DataFrame | Binned,
    config: ForestConfig,
    label: str,
    features: str = "features",
    seed: int = SEED,
) -> RandomForestRegressionModel:
    """Fit on ``train``, which should be persisted, or on its bins, which several fits can share."""
    forest = RandomForestRegressor(
        featuresCol=features,
        labelCol=label,
        numTrees=config.trees,
        maxDepth=DEEPEST if config.depth is None else config.depth,
        minInstancesPerNode=config.min_leaf,
        seed=seed,
    )
    if isinstance(train, Binned):
        return fit(train, forest)
    with binned(train, label, features) as table:
        return fit(table, forest)


def regression_metrics(
    predictions: DataFrame, actual: str, predicted: str, *by: str | Column
) -> DataFrame:
    """(by..., n, MAE, RMSE, R2) of all groups from one aggregate."""
    y = F.col(actual).cast("double")
    e = y - F.col(predicted)
    scored = predictions.filter(y.isNotNull() & F.col(predicted).isNotNull())
    sums = (
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("MAE"),
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("R2"),
    )
    return scored.groupBy(*by).agg(*sums) if by else scored.agg(*sums)


def with_errors(df: DataFrame, actual: str, predicted: str, suffix: str) -> DataFrame:
    """Add actual minus predicted, and its absolute value."""
    e = F.col(actual) - F.col(predicted)
    return df.withColumns({f"error_{suffix}": e, f"absolute_error_{suffix}": F.abs(e)})


def prediction_table(predicted: DataFrame, id_column: str, label: str) -> DataFrame:
    """(id, actual_<label>, predicted_<label>), the shape that is written out."""
    return predicted.select(
        id_column, F.col(label).alias(f"actual_{label}"), F.col("prediction").alias(f"predicted_{label}")
    )


def timed(action: Callable):
    """(result, seconds); ``action`` must run a job, a lazy frame measures nothing."""
    start = time.perf_counter()
    result = action()
    return result, time.perf_counter() - start


def laid_for_scoring(rows: DataFrame, model: RandomForestRegressionModel, column: str) -> DataFrame:
    """All of ``rows``, like ones side by side, with their vectors in ``column`` as trees read them fastest.

    Rows of one leaf of the model's first tree take much the same way through the
    others, whose nodes the core then still holds. A vector of moderate width has
    no gaps in it, so that an entry is read and not searched for.
    """
    first = model.trees[0]
    names = {first.featuresCol: model.getFeaturesCol(), first.predictionCol: "_guess", first.leafCol: "_leaf"}
    laid = first.copy(names).transform(rows).sortWithinPartitions("_leaf").select(rows.columns)
    vector = F.col(model.getFeaturesCol())
    return laid.withColumn(column, array_to_vector(vector_to_array(vector)) if model.numFeatures <= FULL_WIDTH else vector)


def predicted(model: RandomForestRegressionModel, rows: DataFrame) -> DataFrame:
    """``rows``, in no certain order, with the model's predictions."""
    laid = laid_for_scoring(rows, model, "_vector")
    return model.copy({model.featuresCol: "_vector"}).transform(laid).drop("_vector")


def score_models(rows: DataFrame, models: Sequence[RandomForestRegressionModel], label: str) -> DataFrame:
    """(place, n, MAE, RMSE, R2) of every model, its predictions a column beside the others, from one pass over ``rows``."""
    y = F.col(label).cast("double")
    scored, cells = laid_for_scoring(rows.filter(y.isNotNull()), models[-1], "_vector"), []
    for place, model in enumerate(models, start=1):
        column = f"_predicted_{place}"
        scored = model.copy({model.predictionCol: column, model.featuresCol: "_vector"}).transform(scored)
        e = y - F.col(column)
        cells.append(
            F.struct(
                F.lit(place).cast("long").alias("place"),
                F.count(F.lit(1)).alias("n"),
                F.avg(F.abs(e)).alias("MAE"),
                F.sqrt(F.avg(e * e)).alias("RMSE"),
                (1 - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("R2"),
            )
        )
    return scored.agg(F.array(*cells).alias("_models")).select(F.inline("_models"))


class Journal:
    """Finished configurations of one search in a folder that the cluster shares.

    An entry is written after its model, so a search that broke off between the
    two fits that configuration again. Entries of other rows, other labels or
    another seed lie under another key and are not read.
    """

    def __init__(self, train: DataFrame, path: str, label: str, id_column: str, seed: int):
        self.spark = train.sparkSession
        own = F.xxhash64(id_column, F.col(label).cast("double"))
        rows, mark = train.agg(F.count(F.lit(1)), F.bit_xor(own)).first()
        self.path = f"{path}/{label}-{seed}-{rows}-{(mark or 0) & (1 << 64) - 1:016x}"

    def _place(self, config: ForestConfig) -> str:
        return f"{self.path}/trees={config.trees},depth={config.depth},min_leaf={config.min_leaf}"

    def find(self, config: ForestConfig) -> tuple[RandomForestRegressionModel, float] | None:
        entry = f"{self._place(config)}/entry"
        sc = self.spark.sparkContext
        place = sc._jvm.org.apache.hadoop.fs.Path(f"{entry}/_SUCCESS")
        if not place.getFileSystem(sc._jsc.hadoopConfiguration()).exists(place):
            return None
        seconds = json.loads(self.spark.read.text(entry).first()[0])["fit_seconds"]
        return RandomForestRegressionModel.load(f"{self._place(config)}/model"), seconds

    def add(self, config: ForestConfig, model: RandomForestRegressionModel, seconds: float) -> None:
        model.write().overwrite().save(f"{self._place(config)}/model")
        text = json.dumps(asdict(config) | {"fit_seconds": seconds})
        entry = self.spark.createDataFrame([(text,)], "entry string").coalesce(1)
        entry.write.mode("overwrite").text(f"{self._place(config)}/entry")


@dataclass
class Search:
    results: DataFrame
    best: ForestConfig
    model: RandomForestRegressionModel
    fit_seconds: float


def grid_search(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[ForestConfig],
    label: str,
    seed: int = SEED,
    journal: Journal | None = None,
) -> Search:
    """Fit every configuration, score all of them in one pass over the validation rows, keep the best.

    The lowest RMSE wins, the earlier configuration on ties; its model is kept,
    so nothing is fitted twice. Configurations that ``journal`` has are loaded
    with their fit seconds. ``predict_seconds`` is a model's share of the pass.
    """
    fitted: list[tuple[RandomForestRegressionModel, float]] = []
    table = None

    def fit_next(config: ForestConfig) -> RandomForestRegressionModel:
        nonlocal table
        table = table or binned(train, label)  # once; its seconds are the first fit's
        return fit_forest(table, config, label, seed=seed)

    for config in grid:
        found = journal.find(config) if journal else None
        if found is None:
            found = timed(lambda config=config: fit_next(config))
            if journal:
                journal.add(config, *found)
        fitted.append(found)
    if table:
        table.blocks.unpersist()
    scores, seconds = timed(lambda: score_models(validation, [m for m, _ in fitted], label).orderBy("place").collect())
    rows = [
        (place, config.trees, config.depth, config.min_leaf, score["MAE"], score["RMSE"], score["R2"], fit_s, seconds / len(grid))
        for place, (config, (_, fit_s), score) in enumerate(zip(grid, fitted, scores), start=1)
    ]
    results = train.sparkSession.createDataFrame(
        rows,
        "place long, trees int, depth int, min_leaf int, validation_MAE double, validation_RMSE double, "
        "validation_R2 double, fit_seconds double, predict_seconds double",
    )
    best = min(range(len(grid)), key=lambda i: scores[i]["RMSE"])
    return Search(results, grid[best], *fitted[best])


def feature_importances(model: RandomForestRegressionModel, names: DataFrame) -> DataFrame:
    """(feature, importance), one row per entry of the feature vector; ``names`` has (position, name).

    The model's entries that are not zero come from the driver, where the forest is.
    """
    values = model.featureImportances
    held = names.count()
    if values.size != held:
        raise ValueError(f"{held} names for {values.size} importances")
    entries = [(int(i), float(v)) for i, v in zip(values.indices, values.values)]
    found = names.sparkSession.createDataFrame(entries, "position long, importance double")
    joined = names.join(found, "position", "left")
    return joined.select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))


def top_importances(importances: DataFrame, n: int) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), "feature").limit(n)


def config_table(spark, configs: Sequence[ForestConfig]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(c).values()) for c in configs], "trees int, depth int, min_leaf int")
