import json

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from ridgeline.model import TURBINE, Roles
from ridgeline.operators import features as X
from ridgeline.operators import forest
from ridgeline.operators import quality as Q
from ridgeline.operators import regression as R
from ridgeline.plans import comparison, profile, training
from ridgeline.sources import files
from ridgeline.sources import results as RS
from ridgeline.sources import run_info as RI

ROLES = Roles("id", ("x", "z"), ("c",), "y")


@pytest.fixture(scope="module")
def rows(spark):
    letters = F.element_at(F.array(*[F.lit(v) for v in "abbccc"]), (F.col("id") % 6 + 1).cast("int"))
    return spark.range(400).select(
        "id",
        (F.col("id") % 20).cast("double").alias("x"),
        (F.col("id") * 37 % 101).cast("double").alias("z"),
        letters.alias("c"),
        F.when(F.col("id") % 4 == 0, 0.0).otherwise((F.col("id") % 20) * 3.0).alias("y"),
        F.when(F.col("id") < 280, "train").when(F.col("id") < 340, "validation").otherwise("test").alias("split"),
    )


def one_hot(encoder, spark, value):
    df = spark.createDataFrame([(0, 0.0, 0.0, value)], "id long, x double, z double, c string")
    return encoder.transform(df).select(vector_to_array("features")).first()[0][2:]


def names_of(encoder):
    return [r["name"] for r in encoder.names().orderBy("position").collect()]


def test_ignore_encoder(spark, rows):
    encoder = X.fit_ignore_unknown(rows, ROLES)
    assert one_hot(encoder, spark, "b") == [0.0, 1.0, 0.0]
    assert one_hot(encoder, spark, "zz") == [0.0, 0.0, 0.0]
    assert one_hot(encoder, spark, None) == [0.0, 0.0, 0.0]
    assert names_of(encoder) == ["num__x", "num__z", "cat__c_a", "cat__c_b", "cat__c_c"]


def test_population_scaling(spark, rows):
    encoder = X.fit_ignore_unknown(rows, ROLES)
    values = encoder.transform(rows).select(vector_to_array("features")[0].alias("v"))
    got = values.agg(F.avg("v"), F.stddev_pop("v")).first()
    assert got[0] == pytest.approx(0, abs=1e-12) and got[1] == pytest.approx(1)


def test_keep_encoder(spark, rows, tmp_path):
    encoder = X.fit_keep_unknown(rows, ROLES)
    assert one_hot(encoder, spark, "c") == [1.0, 0.0, 0.0, 0.0]  # most frequent first
    assert one_hot(encoder, spark, "zz") == [0.0, 0.0, 0.0, 1.0]
    assert one_hot(encoder, spark, None) == [0.0, 0.0, 0.0, 1.0]
    expected = ["x", "z", *[f"c_indexed_encoded_{v}" for v in ("c", "b", "a", "__unknown")]]
    assert names_of(encoder) == expected
    scaled = X.fit_keep_unknown(rows, ROLES, scale=True)
    assert names_of(scaled) == expected
    v = vector_to_array("features")
    got = scaled.transform(rows).select(v[0].alias("a"), v[2].alias("b"), v[5].alias("u")).agg(
        *[f(c) for c in "abu" for f in (F.avg, F.stddev_samp)]
    ).first()
    assert list(got) == pytest.approx([0, 1, 0, 1, 0, 0], abs=1e-12)
    scaled.save(str(tmp_path / "scaled"))
    again = X.load_encoder(spark, str(tmp_path / "scaled"))
    pairs = scaled.transform(rows).select("id", v.alias("a")).join(again.transform(rows).select("id", v.alias("b")), "id")
    assert pairs.filter("a <> b").count() == 0 and pairs.count() == 400


def test_missing_numbers_raise_or_stay(spark, rows):
    encoder = X.fit_keep_unknown(rows, ROLES)
    df = spark.createDataFrame([(0, None, 1.0, "a"), (1, float("nan"), 1.0, "a")], "id long, x double, z double, c string")
    for i in (0, 1):
        with pytest.raises(Exception, match="missing value"):
            encoder.transform(df.filter(F.col("id") == i))
    got = encoder.transform(df, "keep").select(vector_to_array("features").alias("v")).collect()
    assert all(str(r["v"]) == "[nan, 1.0, 0.0, 0.0, 1.0, 0.0]" for r in got)


def test_any_number_of_levels(spark):
    """150,000 levels of one column, a third of the rows in one of them, and levels that training has not seen."""
    i = F.col("id")
    level = F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), (i % 225_000).cast("string")))
    df = spark.range(450_000).select(i, (i % 7).cast("double").alias("x"), level.alias("c"), i.cast("double").alias("y"))
    roles = Roles("id", ("x",), ("c",), "y")
    encoder = X.fit_keep_unknown(df, roles)
    assert encoder.sizes == {"c": 150_001} and encoder.width == 150_003
    assert encoder.levels.filter("level = 'hot'").first()["place"] == 0
    assert encoder.levels.agg(F.count_distinct("place"), F.max("place")).first()[:] == (150_001, 150_000)
    ordered = [r["level"] for r in encoder.levels.filter("place between 1 and 4").orderBy("place").collect()]
    assert ordered == ["v1", "v10", "v100", "v1000"]
    new = spark.createDataFrame([(1, 2.0, "hot", 0.0), (2, 0.0, "v10", 0.0), (3, 1.0, "unseen", 0.0), (4, 1.0, None, 0.0)], "id long, x double, c string, y double")
    got = {r["id"]: r["features"] for r in encoder.transform(new).collect()}
    assert all(v.size == 150_003 for v in got.values())
    assert {i: dict(zip(v.indices.tolist(), v.values.tolist())) for i, v in got.items()} == {1: {0: 2.0, 1: 1.0}, 2: {3: 1.0}, 3: {0: 1.0, 150_002: 1.0}, 4: {0: 1.0, 150_002: 1.0}}
    names = encoder.names()
    assert names.count() == 150_003 and names.agg(F.count_distinct("position")).first()[0] == 150_003
    assert names.filter("position = 150002").first()["name"] == "c_indexed_encoded___unknown"


def test_no_categories_and_no_rows(spark, rows):
    none = Roles("id", ("x", "z"), (), "y")
    assert names_of(X.fit_keep_unknown(rows, none)) == ["x", "z"]
    empty = X.fit_ignore_unknown(rows.limit(0), ROLES)
    assert empty.width == 2 and empty.transform(rows.limit(3)).count() == 3


def test_matrix_check(spark, rows):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([("a", Vectors.dense([1.0, float("nan"), float("-inf")])), ("a", Vectors.sparse(3, [0], [float("inf")]))], ["s", "features"])
    row = X.feature_matrix_check(df, "s").first()
    assert tuple(row) == ("a", 2, 3, 1, 2)


def test_forest_does_not_depend_on_input_layout(spark, rows):
    config = R.ForestConfig(5, 4)
    scores = []
    for source in (rows.repartition(3), rows.repartition(7, "z")):
        prepared = training.prepare(source, ROLES)
        with R.kept(training.training_rows(prepared, ROLES)) as train:
            model = R.fit_forest(train, config, "y")
        scores.append([tuple(r) for r in training.split_metrics(model.transform(prepared.rows), ROLES).collect()])
    for a, b in zip(*scores):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9)


def test_a_training_task_reads_no_more_from_a_larger_table(spark, rows):
    counts = {n: R.training_layout(rows, "id", n).rdd.getNumPartitions() for n in (280, 630_000, 6_300_000, 37_800_000)}
    assert counts[280] == R.FEWEST_PARTITIONS and counts[630_000] > R.FEWEST_PARTITIONS
    assert all(n / parts <= 60_000 for n, parts in counts.items())


def test_like_rows_lie_side_by_side_and_none_is_lost(spark, rows):
    orders = []
    for source in (rows.repartition(3), rows.repartition(7, "z")):
        laid = training.training_rows(training.prepare(source, ROLES), ROLES)
        parts = laid.select("id", "y").rdd.glom().collect()
        assert sorted(r["id"] for part in parts for r in part) == list(range(280))
        orders.append([[r["id"] for r in part] for part in parts])
    assert orders[0] == orders[1]
    steps = lambda part: sum(abs(a["y"] - b["y"]) for a, b in zip(part, part[1:]))
    assert sum(map(steps, parts)) < sum(steps(sorted(part)) for part in parts) / 3


def test_forest_beats_the_mean(spark, rows):
    prepared = training.prepare(rows, ROLES)
    done = training.train_and_evaluate(prepared, ROLES, [R.ForestConfig(2, 1), R.ForestConfig(10, 6)])
    metrics = {r["split"]: r for r in done.metrics.collect()}
    assert metrics["test"]["R2"] > 0 and all(r["RMSE"] >= r["MAE"] for r in metrics.values())
    assert done.search.best == R.ForestConfig(10, 6)
    alone = R.regression_metrics(done.search.model.transform(prepared.split("validation")), "y", "prediction").first()
    best = done.search.results.filter("place = 2").first()
    assert [best[f"validation_{m}"] for m in ("MAE", "RMSE", "R2")] == pytest.approx([alone[m] for m in ("MAE", "RMSE", "R2")])
    assert done.importances.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert [r["split"] for r in training.baseline(prepared, ROLES, R.ForestConfig(2, 2)).collect()] == ["train", "validation"]


@pytest.fixture(scope="module")
def vectors(spark):
    """3,000 rows with gaps, negative numbers, flags, and a label of whole numbers; dense and sparse vectors."""
    i = F.col("id")
    numbers = [(i % 17 - 5).cast("double"), F.round(F.rand(1) * 8 - 2, 2), (i % 3 == 0).cast("double"), (i % 5 == 1).cast("double"), F.lit(7.0)]
    df = spark.range(3000).select("id", *[v.alias(f"v{n}") for n, v in enumerate(numbers)])
    df = df.withColumn("y", F.round(F.col("v0") * F.col("v1") + F.col("v2") * 10 + F.rand(3) * 4))
    df = VectorAssembler(inputCols=[f"v{n}" for n in range(5)], outputCol="features").transform(df)
    with R.kept(R.training_layout(df, "id", 3000)) as laid:
        yield laid


def shape(tree):
    return tree.toDebugString.split("\n")[1:]


def test_a_tree_is_the_one_that_spark_ml_grows(spark, vectors):
    asked = dict(labelCol="y", maxDepth=6, minInstancesPerNode=3)
    theirs = DecisionTreeRegressor(**asked).fit(vectors)
    with forest.binned(vectors, "y") as table:
        ours = forest.fit(table, RandomForestRegressor(numTrees=1, bootstrap=False, **asked)).trees[0]
    assert shape(ours) == shape(theirs) and ours.numNodes > 50
    assert ours.featureImportances.toArray().tolist() == pytest.approx(theirs.featureImportances.toArray().tolist())


def test_a_forest_is_as_good_as_that_of_spark_ml(spark, vectors):
    theirs = RandomForestRegressor(labelCol="y", numTrees=30, maxDepth=6, seed=1).fit(vectors)
    ours = R.fit_forest(vectors, R.ForestConfig(30, 6), "y", seed=1)
    rmse = [R.regression_metrics(m.transform(vectors), "y", "prediction").first()["RMSE"] for m in (ours, theirs)]
    assert rmse[0] == pytest.approx(rmse[1], rel=0.1)
    assert ours.getNumTrees == 30 and max(t.depth for t in ours.trees) == 6 and len({tuple(shape(t)) for t in ours.trees}) == 30
    assert sum(t.featureImportances.toArray()[4] for t in ours.trees) == 0  # a number that never varies


def test_a_forest_does_not_depend_on_tasks_and_chunks(spark, vectors, monkeypatch):
    """Sums meet in any order and size: the same splits, thresholds and predictions."""
    shapes = []
    for tasks in (8, 1, 3):
        with forest.binned(vectors, "y") as table:
            table.blocks = table.blocks.coalesce(tasks)
            shapes.append([shape(t) for t in R.fit_forest(table, R.ForestConfig(4, None, 2), "y").trees])
    assert shapes[0] == shapes[1] == shapes[2]
    whole = []  # one tree, which may split on every feature
    for cells in (1 << 20, 500):
        monkeypatch.setattr(forest, "CELLS", cells)
        with forest.binned(vectors, "y") as table:
            whole.append(shape(R.fit_forest(table, R.ForestConfig(1, None, 2), "y").trees[0]))
    assert whole[0] == whole[1]


def test_a_search_bins_its_rows_once(spark, rows, monkeypatch):
    real, calls = R.binned, []
    monkeypatch.setattr(R, "binned", lambda *a, **k: calls.append(a) or real(*a, **k))
    prepared = training.prepare(rows, ROLES)
    with R.kept(training.training_rows(prepared, ROLES)) as train:
        R.grid_search(train, prepared.split("validation"), [R.ForestConfig(2, 1), R.ForestConfig(3, 2)], "y")
    assert len(calls) == 1


def test_many_values_are_described_by_all_rows(spark):
    """Thresholds of some 39,600 distinct values lie at equal shares of the rows, zeros counted; few values are all cut."""
    x = F.when(F.col("id") % 100 == 0, 0.0).otherwise(F.col("id") * 0.5 - 8000)
    df = spark.range(40_000).select("id", x.alias("x"), (F.col("id") % 5).cast("double").alias("z"))
    df = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df).withColumn("y", F.col("x"))
    with R.kept(df.repartition(8, "id")) as laid, forest.binned(laid, "y") as table:
        cuts = [table.bins.thresholds[a:b] for a, b in zip(table.bins.cuts[:-1], table.bins.cuts[1:])]
    assert cuts[1].tolist() == [0.5, 1.5, 2.5, 3.5]
    ranks = [df.filter(F.col("x") <= float(c)).count() / 40_000 for c in cuts[0]]
    assert ranks == pytest.approx([i / 32 for i in range(1, 32)], abs=0.006)


@pytest.mark.parametrize("width", [1_000, 2])
def test_like_rows_are_scored_side_by_side_and_none_is_lost(spark, rows, monkeypatch, width):
    monkeypatch.setattr(R, "FULL_WIDTH", width)
    prepared = training.prepare(rows, ROLES)
    with R.kept(training.training_rows(prepared, ROLES)) as train:
        model = R.fit_forest(train, R.ForestConfig(6, 5), "y")
    source = prepared.rows.repartition(2, "id").sortWithinPartitions("id")
    got, plain = R.predicted(model, source), model.transform(source)
    assert got.columns == plain.columns
    values = lambda df: {r["id"]: (r["y"], r["split"], r["features"], r["prediction"]) for r in df.collect()}
    assert values(got) == values(plain) and len(values(got)) == 400
    laid = R.laid_for_scoring(source, model, "_vector")
    kinds = {type(r["_vector"]).__name__ for r in laid.collect()}
    assert kinds == ({"DenseVector"} if width == 1_000 else {"SparseVector"})
    steps = lambda df: sum(abs(a["y"] - b["y"]) for part in df.rdd.glom().collect() for a, b in zip(part, part[1:]))
    assert steps(laid) < steps(source) / 2


def test_labels_and_vectors_of_a_forest_are_numbers(spark, vectors):
    for label in (None, float("nan"), float("inf")):
        bad = vectors.withColumn("y", F.when(F.col("id") == 5, F.lit(label).cast("double")).otherwise(F.col("y")))
        with pytest.raises(ValueError, match="1 labels and 0 vectors"):
            R.fit_forest(bad, R.ForestConfig(1, 1), "y")
    with pytest.raises(ValueError, match="needs training rows"):
        R.fit_forest(vectors.limit(0), R.ForestConfig(1, 1), "y")
    # Three rows: some bootstraps draw none.
    few = R.fit_forest(vectors.filter("id < 3"), R.ForestConfig(60, 3), "y")
    assert few.getNumTrees == 60 and few.transform(vectors.filter("id < 3")).filter("prediction is null or isnan(prediction)").count() == 0


def test_unlimited_depth_is_the_deepest(spark, rows):
    prepared = training.prepare(rows, ROLES)
    model = R.fit_forest(training.training_rows(prepared, ROLES), R.ForestConfig(1, None, 150), "y")
    assert model.getOrDefault("maxDepth") == R.DEEPEST
    assert len(R.SINGLE_NODE_GRID) == 8 and len(R.DISTRIBUTED_GRID) == 4


def test_a_search_goes_on_where_it_broke_off(spark, rows, tmp_path, monkeypatch):
    prepared = training.prepare(rows, ROLES)
    grid = [R.ForestConfig(2, 1), R.ForestConfig(3, 2), R.ForestConfig(4, 3), R.ForestConfig(2, None)]
    whole = training.train_and_evaluate(prepared, ROLES, grid).search
    real, fitted = R.fit_forest, []

    def failing(train, config, *args, **kwargs):
        if len(fitted) == 2:
            raise RuntimeError("executor lost")
        fitted.append(config)
        return real(train, config, *args, **kwargs)

    monkeypatch.setattr(R, "fit_forest", failing)
    journal = str(tmp_path / "journal")
    with pytest.raises(RuntimeError):
        training.train_and_evaluate(prepared, ROLES, grid, journal=journal)
    monkeypatch.setattr(R, "fit_forest", lambda *a, **k: fitted.append(a[1]) or real(*a, **k))
    resumed = training.train_and_evaluate(prepared, ROLES, grid, journal=journal).search
    assert fitted == grid  # nothing was fitted twice
    columns = [c for c in whole.results.columns if not c.endswith("seconds")]
    assert [tuple(r) for r in resumed.results.select(columns).collect()] == [tuple(r) for r in whole.results.select(columns).collect()]
    assert resumed.best == whole.best
    # Other rows are another search.
    less = training.prepare(rows.filter("id <> 3"), ROLES)
    training.train_and_evaluate(less, ROLES, grid[:1], journal=journal)
    assert fitted[-1] == grid[0] and len(fitted) == 5


def test_load_or_fit(spark, rows, tmp_path):
    path = str(tmp_path / "model")
    fit = lambda: X.fit_keep_unknown(rows, ROLES)
    assert X.load_or_fit(path, fit, rows)[1] is False
    assert X.load_or_fit(path, fit, rows)[1] is True
    # A probe without the stored columns counts as a mismatch.
    renamed = rows.withColumnRenamed("x", "w")
    other = Roles("id", ("w", "z"), ("c",), "y")
    fit_other = lambda: X.fit_keep_unknown(renamed, other)
    assert X.load_or_fit(path, fit_other, renamed)[1] is False
    assert X.load_encoder(spark, path).roles == other


def test_unreadable_encoder_is_not_overwritten(spark, rows, tmp_path):
    place = tmp_path / "model"
    place.mkdir()
    (place / "metadata").write_text("not a model")
    with pytest.raises(Exception):
        X.load_or_fit(str(place), lambda: pytest.fail("fitted again"), rows)
    assert (place / "metadata").read_text() == "not a model"


def turbine_table(spark):
    n = F.col("id")
    numeric = [((n * (i + 3) * 17 % 97) / (i + 1)).alias(c) for i, c in enumerate(TURBINE.numeric)]
    pick = lambda values, step: F.element_at(F.array(*[F.lit(v) for v in values]), (n % step % len(values) + 1).cast("int"))
    return spark.range(600).select(
        n.alias("record_id"),
        *numeric,
        pick(("Offshore", "Mountain", "Coastal", "Plains"), 4).alias("region"),
        pick([f"TB{i:04d}" for i in range(1, 7)], 6).alias("turbine_id"),
        pick(("Normal", "Warning", "Repair Scheduled"), 3).alias("maintenance_status"),
        pick(("OK", "Minor vibration", "Lubrication check", "Noise detected"), 5).alias("technician_note"),
        F.when(n % 4 == 0, 0.0).otherwise(n * 51 % 97).cast("double").alias("power_output"),
    )


def test_whole_workflow(spark, tmp_path):
    """Profile, train twice and compare, all through files."""
    csv = str(tmp_path / "raw")
    files.write_table(turbine_table(spark), csv, "csv")
    table = files.read_csv(spark, csv, TURBINE.schema())

    tables = profile.run_profile(
        table, TURBINE, str(tmp_path / "profile"), Q.turbine_rules(), "wind_speed", [0, 3, 5, 10, 15, 20, 25, 30], "maintenance_status"
    )
    summary = {r["key"]: r["value"] for r in tables["dataset_summary"].collect()}
    assert summary["records"] == "600" and summary["columns"] == "15"
    assert spark.read.parquet(str(tmp_path / "profile" / "splits")).count() == 600

    runs = {}
    for name, grid, encoder in (
        ("first", [R.ForestConfig(4, None, 2), R.ForestConfig(3, 3, 2)], "ignore"),
        ("second", [R.ForestConfig(3, 3), R.ForestConfig(5, 4)], "keep"),
    ):
        out = str(tmp_path / name)
        tables = training.run_training(spark, table, TURBINE, out, grid, encoder, baseline_config=R.ForestConfig(2, 2))
        assert {"vector_check", "baseline_metrics", "residual_histogram", "prediction_sample"} <= set(tables)
        assert tables["prediction_sample"].count() == 91 and tables["residual_histogram"].agg(F.sum("n")).first()[0] == 91
        assert [r["predict_seconds"] > 0 for r in tables["metrics"].collect()] == [True] * 3
        runs[name] = comparison.load_run(spark, out, name, "Spark ML", TURBINE, with_run_info=name == "second")
    out = str(tmp_path / "comparison")
    got = comparison.run_comparison(runs["first"], runs["second"], TURBINE, out)
    assert got["comparison_metrics"].count() == 6
    assert got["feature_importance_comparison"].count() == 26
    assert got["prediction_difference"].first()["n"] == 91
    modes = {r["model"]: (r["pipeline_time_s"] is None, r["tuning_configurations"]) for r in got["model_summary"].collect()}
    assert modes == {"first": (True, 2), "second": (False, 2)}
    baseline = training.run_training(spark, table, TURBINE, str(tmp_path / "b"), baseline_only=True)
    assert set(baseline) == {"vector_check", "baseline_metrics"}
    assert got["error_histogram"].groupBy("model").agg(F.sum("n").alias("n")).filter("n = 91").count() == 2
    assert got["importance_checks"].filter("total_is_one").count() == 2 and got["importance_extra"].count() == 0
    info = spark.read.schema(RI.RUN_INFO_SCHEMA).json(str(tmp_path / "second" / "run_info" / "json")).first()
    assert info["seed"] == 42 and json.dumps(info["spark_version"]) and info["test_RMSE"] >= info["test_MAE"] > 0


# Published results of two runs, three splits and the searches' first rows.
SINGLE_METRICS = "split,MAE,RMSE,R2,pred_time_s,n_estimators,max_depth,min_samples_leaf\ntrain,9.039618580155702,11.107241026725278,0.7524813863961306,1.27,200,20,2\nvalidation,12.515624674868622,15.825255497121052,0.4950929636271232,0.38,200,20,2\ntest,12.5871,15.8962,0.4920,0.36,200,20,2\n"
SPARK_METRICS = "split,MAE,RMSE,R2\ntrain,11.955564896690827,14.854791835827372,0.5572805399653369\nvalidation,12.553059321097122,15.771919861773624,0.49849059059888756\ntest,12.6138,15.8436,0.4954\n"
SINGLE_SEARCH = "n_estimators,max_depth,min_samples_leaf,rmse_val,mae_val,r2_val,train_time_s,pred_time_s\n200,20.0,2,15.825255497121052,12.51562467486862,0.4950929636271232,97.2,0.272\n200,30.0,4,15.858868288589376,12.564298433749736,0.49294584398563457,102.91,0.3749\n300,,2,15.9,12.6,0.49,169.04,0.5\n"
SPARK_SEARCH = "numTrees,maxDepth,validation_MAE,validation_RMSE,validation_R2,fit_time_seconds\n50,8,12.713163722360244,15.880086310622904,0.49158813254850764,16.23\n200,12,12.553059321097122,15.771919861773624,0.49849059059888756,143.61\n"
SPARK_INFO = "Spark Version: 4.2.0\nSpark Master: local[*]\nPreprocessing fit time: 7.32s\nFinal model training time: 141.42s\nWhole pipeline execution time: 500.39s\nnumTrees: 200\nmaxDepth: 12\n"


def test_results_of_other_programs_are_compared(spark, tmp_path):
    features = [f"num__{c}" for c in TURBINE.numeric] + [f"cat__{c}_x" for c in TURBINE.categorical]
    renamed = [*TURBINE.numeric, *[f"{c}_indexed_encoded_x" for c in TURBINE.categorical], "region_indexed_encoded___unknown"]
    weights = [0.4] + [0.05] * 12
    texts = {
        "a": (SINGLE_METRICS, SINGLE_SEARCH, "feature,importance\n" + "".join(f"{f},{w}\n" for f, w in zip(features, weights))),
        "b": (SPARK_METRICS, SPARK_SEARCH, "feature_name,importance\n" + "".join(f"{f},{w}\n" for f, w in zip(renamed, [*weights, 0.0]))),
    }
    for name, parts in texts.items():
        predictions = "record_id,actual_power_output,predicted_power_output\n" + "".join(f"{i},{i}.5,{i + (name == 'b')}\n" for i in range(6))
        for kind, text in zip(("metrics", "search", "importances", "predictions"), (*parts, predictions)):
            (tmp_path / f"{name}_{kind}.csv").write_text(text)
    (tmp_path / "info.txt").write_text(SPARK_INFO)

    def files_of(name, info=None):
        return comparison.Files(*[str(tmp_path / f"{name}_{kind}.csv") for kind in ("metrics", "search", "importances", "predictions")], info)

    single = comparison.load_results(spark, files_of("a"), RS.SINGLE_NODE, "single", "one machine", TURBINE)
    spread = comparison.load_results(spark, files_of("b", str(tmp_path / "info.txt")), RS.DISTRIBUTED, "spread", "local", TURBINE)
    got = comparison.comparison_tables(single, spread, TURBINE)
    assert [tuple(r) for r in got["model_summary"].collect()] == [
        ("single", "scikit-learn", "n_estimators=200, max_depth=20, min_samples_leaf=2", 3, 15.825255497121052, 97.2, None, "one machine"),
        ("spread", "PySpark Spark MLlib", "numTrees=200, maxDepth=12", 2, 15.771919861773624, 141.42, 500.39, "local[*]"),
    ]
    gaps = {r["model"]: r["gap"] for r in got["generalisation_gap"].collect()}
    assert gaps == pytest.approx({"single": 4.788959, "spread": 0.988808}, abs=1e-6)
    verdicts = {r["metric"]: r["verdict"] for r in got["metric_deltas"].collect()}
    assert verdicts == {"MAE": "worse", "RMSE": "better", "R2": "better"}
    ranks = {(r["model"], r["feature"]): r["rank"] for r in got["feature_importance_comparison"].collect()}
    assert len(ranks) == 26 and ranks["spread", "wind_speed"] == 1 and ranks["single", "region"] == 2
    assert got["prediction_difference"].first()["mean_difference"] == 1.0
    (tmp_path / "a_metrics.csv").write_text("split,MAE\ntrain,1\n")
    with pytest.raises(ValueError, match="missing columns"):
        comparison.load_results(spark, files_of("a"), RS.SINGLE_NODE, "single", "one machine", TURBINE)


def test_command_line(spark, tmp_path):
    from ridgeline.__main__ import main
    from ridgeline.sources import scratch

    csv = str(tmp_path / "raw")
    files.write_table(turbine_table(spark), csv, "csv")
    main(["train", csv, str(tmp_path / "b"), "--baseline-only"])
    schema = comparison.BASELINE_SCHEMA
    metrics = spark.read.schema(schema).csv(str(tmp_path / "b" / "baseline_metrics"), header=True).collect()
    assert [r["split"] for r in metrics] == ["train", "validation"]
    assert not scratch._written.get(spark.sparkContext.applicationId)


def test_staged_tables_are_discarded(spark):
    from ridgeline.sources import scratch

    path = scratch.staged(spark.range(3), "gone").inputFiles()[0]
    scratch.discard_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
