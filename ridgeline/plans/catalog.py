"""Registered queries: every operator applied to the tables of a data folder.

Results are typed and rounded so that another engine can be compared value by
value; the operators themselves return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.scalars import fixed_text, split_position
from ridgeline.model import ORDER_PROFILE, SPLITS, Roles
from ridgeline.operators import comparison as C
from ridgeline.operators import distribution as D
from ridgeline.operators import features as X
from ridgeline.operators import importance as I
from ridgeline.operators import matching as M
from ridgeline.operators import profiling as P
from ridgeline.operators import quality as Q
from ridgeline.operators import quantiles as QT
from ridgeline.operators import regression as R
from ridgeline.operators.splitting import seeded_sample, stratified_split
from ridgeline.plans import training
from ridgeline.plans.comparison import forest_label
from ridgeline.plans.order_profile import order_profile, table
from ridgeline.sources import files
from ridgeline.sources import run_info as RI
from ridgeline.sources.results import DISTRIBUTED, SINGLE_NODE, mapped
from ridgeline.sources.scratch import scratch_path, staged

ROLES = ORDER_PROFILE
TARGET = ROLES.target
LINE_NUMERICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
QTY_EDGES = [0, 25, 50, 100, 150, 200, 250, 300]
#: The first configuration of the distributed search.
FOREST = R.DISTRIBUTED_GRID[0]
PART_FEATURES = ("p_size", "p_retailprice", "p_brand", "p_type", "p_name")
MODELS = ("ignore", "keep")
SUBSET = Roles("record_id", ("totalprice", "acctbal"), ("status", "priority"), "target")


def rounded(df: DataFrame, digits: int = 4, names: list[str] | None = None) -> DataFrame:
    """Round the floating columns (or the named ones)."""
    chosen = names or [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in chosen})


def rounded_metrics(df: DataFrame) -> DataFrame:
    """Errors are in money, R2 is a share: two digits more."""
    return rounded(rounded(df, 4, ["MAE", "RMSE"]), 6, ["R2"])


# --- inputs -----------------------------------------------------------------


def profile_columns(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return order_profile(spark, d).select(*columns)


def split_rows(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Staged order profile with its split; the joins run once."""
    wanted = columns or tuple(c for c in ROLES.columns if c not in (ROLES.id, TARGET))
    source = staged(order_profile(spark, d).select(ROLES.id, *wanted, TARGET), "order_profile")
    return stratified_split(source, ROLES.id, TARGET)


def group_mean_predictions(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Predict the training mean of the row's category, one prediction per column.

    A missing category, or one that training has not seen, gets the mean of all training rows.
    """
    train = rows.filter(F.col("split") == SPLITS[0])
    overall = F.lit(train.agg(F.round(F.avg(TARGET), 2)).first()[0]).cast("double")
    out = rows
    for c in columns:
        means = train.groupBy(c).agg(F.round(F.avg(TARGET), 2).alias(f"by_{c}"))
        out = out.join(means, c, "left").withColumn(f"by_{c}", F.coalesce(f"by_{c}", overall))
    return out


def predictors(spark: SparkSession, d: str) -> DataFrame:
    """(model, split, record_id, actual_target, predicted_target) of two simple models."""
    rows = group_mean_predictions(split_rows(spark, d, "priority", "segment"), ["priority", "segment"])
    cells = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.col(f"by_{m}").alias("predicted_target"))
            for m in ("priority", "segment")
        ]
    )
    return rows.select("record_id", "split", F.col(TARGET).alias("actual_target"), F.inline(cells))


def one_model(predictions: DataFrame, model: str, split: str) -> DataFrame:
    chosen = (F.col("model") == model) & (F.col("split") == split)
    return predictions.filter(chosen).select("record_id", "actual_target", "predicted_target")


def compared(spark: SparkSession, d: str) -> DataFrame:
    both = predictors(spark, d)
    return C.compare_predictions(
        one_model(both, "priority", "test"),
        one_model(both, "segment", "test"),
        "record_id",
        "target",
        ("priority", "segment"),
    )


def predictor_metrics(spark: SparkSession, d: str) -> DataFrame:
    return R.regression_metrics(predictors(spark, d), "actual_target", "predicted_target", "model", "split")


def encoded_importances(spark: SparkSession, d: str) -> DataFrame:
    """Encoded feature names of two styles, weighted by how often a level occurs."""
    parts = table(spark, d, "part")
    cats = PART_FEATURES[2:]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in cats])
    levels = parts.select(F.inline(cells)).groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    # Shares of the columns in each model's total.
    shares = {"ignore": (0.35, 0.15, 0.1), "keep": (0.05, 0.3, 0.25)}
    names = {
        "ignore": F.concat(F.lit("cat__"), "column", F.lit("_"), "level"),
        "keep": F.concat("column", F.lit("_indexed_encoded_"), "level"),
    }
    total = parts.count()
    out = None
    for model in MODELS:
        share = F.element_at(
            F.create_map(*[x for c, s in zip(cats, shares[model]) for x in (F.lit(c), F.lit(s))]), F.col("column")
        )
        encoded = levels.select(
            F.lit(model).alias("model"), names[model].alias("feature"), (share * F.col("n") / total).alias("importance")
        )
        prefix = "num__" if model == "ignore" else ""
        fixed = [(model, f"{prefix}{c}", 0.2) for c in PART_FEATURES[:2]]
        fixed += [(model, "p_brand_indexed_encoded___unknown", 0.0), (model, "p_container", 0.0)]
        both = encoded.unionByName(spark.createDataFrame(fixed, encoded.schema))
        out = both if out is None else out.unionByName(both)
    return out


def part_rollup(spark: SparkSession, d: str) -> DataFrame:
    return I.importance_rollup(encoded_importances(spark, d), PART_FEATURES)


def prepared(spark: SparkSession, d: str) -> training.Prepared:
    return training.prepare(split_rows(spark, d), ROLES)


# --- profiling --------------------------------------------------------------


def zero_rate_by_category(spark, d):
    return rounded(P.zero_rate(profile_columns(spark, d, "priority", TARGET), TARGET, "priority"), 6)


def zero_rate_by_bin(spark, d):
    rates = D.zero_rate_by_bin(profile_columns(spark, d, "qty", TARGET), TARGET, "qty", QTY_EDGES)
    return rounded(rates.select("bin", "total", "zero_count", "zero_percent"), 6)


def zero_share(spark, d):
    return rounded(P.zero_rate(profile_columns(spark, d, TARGET), TARGET), 6)


def null_profile(spark, d):
    return P.null_profile(table(spark, d, "lineitem"))


def schema_profile(spark, d):
    return P.schema_profile(order_profile(spark, d))


def preview(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return P.preview(orders, ["o_orderkey"], 10)


def duplicate_rows(spark, d):
    return P.duplicate_rows(table(spark, d, "lineitem"))


def describe_numeric(spark, d):
    return rounded(P.describe(table(spark, d, "lineitem"), LINE_NUMERICS))


def quantiles_by_counting(spark, d):
    """Quartiles with more rounds of counting than a table of this size needs."""
    lines = QT.exact_quantiles(table(spark, d, "lineitem"), LINE_NUMERICS, P.QUARTILES, interval_limit=1000)
    events = QT.exact_quantiles(table(spark, d, "events"), ["value"], P.QUARTILES, interval_limit=1000)
    return rounded(lines.unionByName(events), 4, ["value"])


def describe_by_zero(spark, d):
    df = staged(profile_columns(spark, d, "n_lines", "qty", "totalprice", TARGET), "order_profile")
    return rounded(P.describe_by_zero(df, TARGET, ["n_lines", "qty", "totalprice"]))


def cardinality(spark, d):
    return P.cardinality(table(spark, d, "part"), ["p_brand", "p_type", "p_name"])


def value_counts_top(spark, d):
    return P.value_counts(table(spark, d, "part"), ["p_brand", "p_type", "p_name"])


def rule_violations(spark, d):
    rules = [
        Q.below("l_quantity", 0),
        Q.at_or_below("l_quantity", 1),
        Q.outside("l_discount", 0, 0.05),
        Q.outside("l_tax", 0, 1),
        Q.at_or_below("l_extendedprice", 0),
        Q.below("l_extendedprice", 1000),
    ]
    return Q.rule_violations(table(spark, d, "lineitem"), rules)


def dataset_summary(spark, d):
    return P.dataset_summary(order_profile(spark, d), TARGET)


def iqr_outliers(spark, d):
    lines = Q.iqr_outliers(table(spark, d, "lineitem"), LINE_NUMERICS)
    return rounded(lines.unionByName(Q.iqr_outliers(table(spark, d, "events"), ["value"])), 6)


def upper_outlier_describe(spark, d):
    return rounded(Q.upper_outlier_describe(table(spark, d, "events"), "value", ["value", "user_id"]))


def upper_outlier_top(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type", "value")
    return Q.upper_outlier_top(events, "value", "event_id")


# --- distributions, split and sample ----------------------------------------


def target_by_category(spark, d):
    rows = staged(split_rows(spark, d, *ROLES.categorical), "split")
    train = rows.filter(F.col("split") == SPLITS[0])
    return rounded(D.target_by_category(train, ROLES.categorical, TARGET))


def correlation_with_target(spark, d):
    rows = split_rows(spark, d, *ROLES.numeric)
    train = rows.filter(F.col("split") == SPLITS[0])
    return rounded(D.correlation_with_target(train, TARGET, [ROLES.id]), 6).drop("place_by_value")


def correlation_ascending(spark, d):
    df = profile_columns(spark, d, *ROLES.numeric, TARGET)
    return rounded(D.correlation_with_target(df, TARGET), 6).drop("place_by_strength")


def stratified(spark, d):
    source = staged(profile_columns(spark, d, ROLES.id, TARGET), "order_profile")
    return stratified_split(source, ROLES.id, TARGET).select("record_id", "split")


def split_zero_ratio(spark, d):
    source = staged(profile_columns(spark, d, ROLES.id, TARGET), "order_profile")
    rates = P.zero_rate(stratified_split(source, ROLES.id, TARGET), TARGET, "split")
    place = split_position(F.col("split")).cast("long").alias("place")
    return rounded(rates.select(place, "split", "total", "zero_count", "zero_percent"), 6).orderBy("place")


def sample(spark, d):
    return seeded_sample(table(spark, d, "events").select("event_id", "value"), "event_id", 3000)


def equal_width_histogram(spark, d):
    return rounded(D.equal_width_histogram(table(spark, d, "events"), "value", 50), 6)


def scatter_grid(spark, d):
    return D.scatter_grid(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 20)


# --- joins and model comparison ---------------------------------------------


def one_to_one_compare(spark, d):
    return rounded(compared(spark, d), 6)


def reconcile_predictions(spark, d):
    both = predictors(spark, d)
    source = one_model(both, "segment", "test")
    matching = M.reconcile(one_model(both, "priority", "test"), source, "record_id", "actual_target")
    other = M.reconcile(one_model(both, "priority", "validation"), source, "record_id", "actual_target")
    return matching.withColumn("against", F.lit("same split")).unionByName(
        other.withColumn("against", F.lit("other split"))
    )


def actual_agreement(spark, d):
    both = compared(spark, d)
    return M.disagreements(both, "prediction_priority", "prediction_segment")


def positional_attach(spark, d):
    """Orders written to several files; their ids are read apart from the other columns and attached again."""
    path = scratch_path(spark, "orders")
    source = spark.read.parquet(f"{d}/orders.parquet")
    source.repartition(M.partitions(source.count()), "o_orderkey").write.parquet(path)
    orders = spark.read.parquet(path)
    attached = M.attach_ids(orders.drop("o_orderkey"), orders.select("o_orderkey"), "o_orderkey")
    return attached.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def regression_metrics(spark, d):
    return rounded_metrics(predictor_metrics(spark, d))


def comparison_metrics(spark, d):
    both = staged(predictor_metrics(spark, d), "metrics")
    tables = {m: both.filter(F.col("model") == m).drop("model", "n") for m in ("priority", "segment")}
    place = split_position(F.col("split")).cast("long").alias("place")
    return rounded_metrics(C.metric_table(tables).select(place, "split", "model", *C.METRICS))


def generalisation_gap(spark, d):
    return rounded(C.generalisation_gap(predictor_metrics(spark, d)))


def metric_deltas(spark, d):
    deltas = C.metric_deltas(predictor_metrics(spark, d), "priority", "segment")
    share = F.col("metric") == "R2"

    def digits(n: str) -> Column:
        return F.when(share, F.round(n, 6)).otherwise(F.round(n, 4)).alias(n)

    text = F.when(share, fixed_text(F.round("difference", 6), 6, signed=True)).otherwise(
        fixed_text(F.round("difference", 3), 3, signed=True)
    )
    values = [digits(n) for n in ("baseline", "candidate", "difference")]
    percent = F.round("percent", 2).alias("percent")
    return deltas.select("metric", *values, percent, "verdict", text.alias("difference_text"))


def prediction_difference(spark, d):
    return rounded(C.prediction_difference(compared(spark, d), "target"))


def prediction_bounds(spark, d):
    return C.value_bounds(compared(spark, d), ["actual_target", "prediction_priority", "prediction_segment"])


def mean_search(spark, d) -> DataFrame:
    """Search table: the group mean of every categorical column as a configuration."""
    rows = group_mean_predictions(split_rows(spark, d, *ROLES.categorical), list(ROLES.categorical))
    validation = rows.filter(F.col("split") == SPLITS[1])
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("place"),
                F.lit(10 * i).alias("trees"),
                F.lit(None if c == "nation" else i).cast("int").alias("depth"),
                F.col(f"by_{c}").alias("predicted"),
            )
            for i, c in enumerate(ROLES.categorical, start=1)
        ]
    )
    long = validation.select(F.col(TARGET).alias("actual"), F.inline(cells))
    scored = R.regression_metrics(long, "actual", "predicted", "place", "trees", "depth")
    return scored.withColumn("fit_seconds", F.col("n") / 1000)


def best_config(spark, d):
    search = staged(mean_search(spark, d), "search")
    info = staged_run_info(spark, d)
    summary = None
    for model, names in {"first": (1, 2), "second": (3, 4)}.items():
        part = search.filter(F.col("place").isin(*names))
        best = C.best_configuration(part, "RMSE", "place", forest_label("trees", "depth"), "fit_seconds")
        line = C.summary_row(best, model, "group means", "table", info if model == "second" else None)
        summary = line if summary is None else summary.unionByName(line)
    return rounded(summary)


def configs_in_order(spark, d):
    search = mean_search(spark, d).select("place", "trees", "RMSE")
    ordered = M.rows_in_order(search, [4, 2, 1], "place").select(
        F.col("place").cast("long").alias("place"), F.col("trees").cast("long").alias("trees"), "RMSE"
    )
    return rounded(ordered)


def importance_rollup(spark, d):
    out = part_rollup(spark, d).withColumn("rank", F.col("rank").cast("long"))
    return rounded(out, 6)


def importance_expected_set(spark, d):
    return I.expected_set_check(I.rolled_up(encoded_importances(spark, d), PART_FEATURES), (*PART_FEATURES, "p_mfgr"))


def importance_checks(spark, d):
    return rounded(I.importance_checks(I.rolled_up(encoded_importances(spark, d), PART_FEATURES)), 6)


def importance_by_model(spark, d):
    return rounded(I.importance_by_model(part_rollup(spark, d), MODELS), 6)


def top_features_per_model(spark, d):
    return rounded(I.top_features(part_rollup(spark, d)), 6)


def importance_totals(spark, d):
    return rounded(I.importance_totals(part_rollup(spark, d)), 6)


# --- run info and files -----------------------------------------------------


def table_run_info(spark, d) -> DataFrame:
    """Run-info row whose entries are measured on the orders table and on the first simple model."""
    price = F.col("o_totalprice")
    master = F.concat(F.lit("local["), F.count_distinct("o_orderstatus").cast("string"), F.lit("]"))
    row = table(spark, d, "orders").agg(
        F.lit("orders").alias("spark_version"),
        master.alias("spark_master"),
        F.concat(F.lit("Local mode: "), master).alias("mode"),
        F.lit("orders").alias("app_name"),
        F.count_distinct("o_orderpriority").alias("default_parallelism"),
        F.lit("N/A (local mode)").alias("executors"),
        *[F.count(F.lit(1)).alias(f"{s}_partitions") for s in SPLITS],
        F.round(F.min(price), 2).alias("preprocessing_fit_time_s"),
        F.round(F.max(price), 2).alias("final_train_time_s"),
        F.round(F.max(price) - F.min(price), 2).alias("pipeline_time_s"),
        F.count_distinct("o_orderpriority").alias("best_num_trees"),
        F.count_distinct("o_orderstatus").alias("best_max_depth"),
        F.lit(42).cast("long").alias("seed"),
    )
    metrics = predictor_metrics(spark, d).filter(F.col("model") == "priority")
    final = metrics.agg(*[F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in SPLITS for m in C.METRICS])
    # Two rows of one aggregate each, pasted side by side by a key of their own.
    return staged(row.withColumn("_one", F.lit(1)).join(final.withColumn("_one", F.lit(1)), "_one").drop("_one"), "run_info")


def staged_run_info(spark, d) -> DataFrame:
    path = scratch_path(spark, "run_info")
    RI.write_run_info(table_run_info(spark, d), path)
    return RI.parse_run_info(spark, f"{path}/text")


def run_info_parse(spark, d):
    return staged_run_info(spark, d)


def run_info_sink(spark, d):
    path = scratch_path(spark, "run_info")
    RI.write_run_info(table_run_info(spark, d), path)
    return rounded(spark.read.schema(RI.RUN_INFO_SCHEMA).json(f"{path}/json"), 4, RI.FINAL_METRICS)


def csv_roundtrip(spark, d):
    nation = table(spark, d, "nation")
    path = scratch_path(spark, "nation_csv")
    files.write_table(nation, path, "csv")
    read = files.read_csv(spark, path, nation.schema)
    return files.require_columns(read, ["n_nationkey", "n_name", "n_regionkey"], path)


def csv_missing_tokens(spark, d):
    size = F.when(F.col("p_size") > 40, "NA").when(F.col("p_size") < 5, "nan").otherwise(F.col("p_size").cast("string"))
    kind = F.when(F.col("p_type") == "ECONOMY", "null").when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type"))
    path = scratch_path(spark, "part_csv")
    part = table(spark, d, "part").select("p_partkey", size.alias("p_size"), kind.alias("p_type"))
    files.write_table(part, path, "csv")
    schema = T.StructType.fromDDL("p_partkey bigint, p_size double, p_type string")
    return files.read_csv(spark, path, schema)


def coerced_cast(spark, d):
    """Text that is no number becomes NULL: how many names end in a number."""
    tail = F.regexp_extract("p_brand", r"^.{6}(.*)$", 1)
    part = table(spark, d, "part").select(tail.alias("tail"), F.col("p_type").alias("kind"))
    read = files.coerced(part, ["tail", "kind"])
    return read.agg(
        F.count("tail").alias("brand_numbers"), F.sum("tail").alias("brand_sum"), F.count("kind").alias("type_numbers")
    )


# --- features ---------------------------------------------------------------


def _entry(array: Column, i: int) -> Column:
    return F.get(array, F.lit(i))


def scaled_numeric(spark, d):
    rows = split_rows(spark, d)
    done = training.prepare(rows, ROLES, encoder="ignore").rows.withColumn("v", vector_to_array("features"))
    scaled = [F.round(_entry(F.col("v"), i), 6).alias(c) for i, c in enumerate(ROLES.numeric)]
    return done.select("record_id", *scaled)


def _encoded_text(rows: DataFrame, start: int) -> DataFrame:
    tail = F.filter(vector_to_array("features"), lambda _, i: i >= start)
    return rows.select("record_id", F.array_join(F.transform(tail, lambda v: v.cast("int")), "").alias("encoded"))


def onehot_ignore(spark, d):
    done = training.prepare(split_rows(spark, d), ROLES, encoder="ignore")
    return _encoded_text(done.rows, len(ROLES.numeric))


def onehot_keep(spark, d):
    return _encoded_text(prepared(spark, d).rows, len(ROLES.numeric))


def encoded_feature_names(spark, d):
    rows = split_rows(spark, d)
    out = None
    for encoder in MODELS:
        names = training.prepare(rows, ROLES, encoder=encoder).encoder.names()
        part = names.select(F.lit(encoder).alias("encoder"), "position", "name")
        out = part if out is None else out.unionByName(part)
    return out


def level_dictionary(spark, d):
    """Levels of the part table's text columns, names of parts included, ranked by frequency."""
    levels = X.level_dictionary(table(spark, d, "part"), ["p_name", "p_brand", "p_type"], "frequency")
    return levels.select("column", "level", "n", "place")


def full_vector_scaled(spark, d):
    rows = split_rows(spark, d, *SUBSET.features)
    done = training.prepare(rows, SUBSET, scale=True)
    v = vector_to_array("features")
    return done.rows.select("record_id", *[F.round(_entry(v, i), 6).alias(f"v{i}") for i in range(done.encoder.width)])


def feature_matrix_check(spark, d):
    return X.feature_matrix_check(prepared(spark, d).rows, "split")


# --- forests ----------------------------------------------------------------


def forest_metrics(spark, d):
    """Flagship: order profile, split, encode, fit, metrics of every split."""
    done = prepared(spark, d)
    with R.kept(training.training_rows(done, ROLES)) as train:
        model = R.fit_forest(train, FOREST, TARGET)
    return training.split_metrics(model.transform(done.rows), ROLES)


def forest_baseline(spark, d):
    return training.baseline(prepared(spark, d), ROLES)


def forest_importance(spark, d):
    done = prepared(spark, d)
    with R.kept(training.training_rows(done, ROLES)) as train:
        model = R.fit_forest(train, FOREST, TARGET)
    return R.top_importances(R.feature_importances(model, done.encoder.names()), 20)


def forest_importance_rollup(spark, d):
    done = prepared(spark, d)
    with R.kept(training.training_rows(done, ROLES)) as train:
        model = R.fit_forest(train, FOREST, TARGET)
    encoded = R.feature_importances(model, done.encoder.names())
    return I.importance_rollup(encoded.withColumn("model", F.lit("forest")), ROLES.features)


def forest_grid_search(spark, d):
    return training.train_and_evaluate(prepared(spark, d), ROLES, R.DISTRIBUTED_GRID).search.results


def forest_best_metrics(spark, d):
    return training.train_and_evaluate(prepared(spark, d), ROLES, R.DISTRIBUTED_GRID).metrics


def _test_predictions(spark, d) -> tuple[DataFrame, DataFrame]:
    done = prepared(spark, d)
    with R.kept(training.training_rows(done, ROLES)) as train:
        model = R.fit_forest(train, FOREST, TARGET)
    source = done.split(SPLITS[2])
    return model.transform(source), source


def forest_predictions(spark, d):
    predicted, _ = _test_predictions(spark, d)
    return R.prediction_table(predicted, ROLES.id, TARGET)


def forest_prediction_records(spark, d):
    """Which records are predicted, with their actual values."""
    predicted, _ = _test_predictions(spark, d)
    records = R.prediction_table(predicted, ROLES.id, TARGET)
    return records.select("record_id", "actual_target", F.col("predicted_target").isNotNull().alias("predicted"))


def forest_reconciled(spark, d):
    predicted, source = _test_predictions(spark, d)
    return M.reconcile(predicted, source, ROLES.id, TARGET)


def forest_checks(spark, d):
    """What must hold of any forest: counted where SQL can count, else the number of violations."""
    done = prepared(spark, d)
    with R.kept(training.training_rows(done, ROLES)) as train:
        model = R.fit_forest(train, FOREST, TARGET)
    scored = staged(model.transform(done.rows).select(ROLES.id, TARGET, "split", "prediction"), "scored")
    mean = done.split(SPLITS[0]).agg(F.avg(TARGET)).first()[0]
    metrics = training.split_metrics(scored, ROLES)
    spreads = scored.groupBy("split").agg(F.sqrt(F.avg((F.col(TARGET) - mean) ** 2)).alias("of_the_mean"))
    encoded = R.feature_importances(model, done.encoder.names())
    rolled = I.rolled_up(encoded.withColumn("model", F.lit("forest")), ROLES.features)
    low, high = scored.filter(F.col("split") == SPLITS[0]).agg(F.min(TARGET), F.max(TARGET)).first()
    frames = [
        metrics.select(F.concat("split", F.lit(" rows")).alias("check"), F.col("n").alias("value")),
        metrics.agg(F.lit("RMSE below MAE").alias("check"), F.count_if(F.col("RMSE") < F.col("MAE")).alias("value")),
        metrics.join(spreads, "split").agg(F.lit("no better than the mean"), F.count_if(F.col("RMSE") >= F.col("of_the_mean"))),
        scored.agg(F.lit("predictions outside the training targets"), F.count_if(~F.col("prediction").between(low, high))),
        encoded.agg(F.lit("encoded features"), F.count(F.lit(1))),
        encoded.agg(F.lit("importances in thousandths"), F.round(F.sum("importance") * 1000).cast("long")),
        encoded.agg(F.lit("negative importances"), F.count_if(F.col("importance") < 0)),
        rolled.agg(F.lit("features"), F.count(F.lit(1))),
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def forest_search_checks(spark, d):
    """The real grid: every configuration in its place, scored on all validation rows, and one best one."""
    done = prepared(spark, d)
    with R.kept(training.training_rows(done, ROLES)) as train:
        search = R.grid_search(train, done.split(SPLITS[1]), R.DISTRIBUTED_GRID, TARGET)
    best = F.struct("validation_RMSE", "place") == F.min(F.struct("validation_RMSE", "place")).over(Window.partitionBy(F.lit(1)))
    chosen = [F.lit(search.best.trees) == F.col("trees"), F.lit(search.best.depth) == F.col("depth")]
    return search.results.select(
        "place", "trees", "depth", "min_leaf",
        (F.col("validation_RMSE") >= F.col("validation_MAE")).alias("errors_in_order"),
        (F.col("validation_R2") > 0).alias("better_than_the_mean"),
        (best == (chosen[0] & chosen[1])).alias("best_is_chosen"),
    )


def feature_model_roundtrip(spark, d):
    """Encoder stored and loaded again; both must give the same vectors."""
    rows = split_rows(spark, d)
    train = rows.filter(F.col("split") == SPLITS[0])
    fit = lambda: X.fit_keep_unknown(train, ROLES)
    path = scratch_path(spark, "encoders")
    fitted, _ = X.load_or_fit(path, fit, rows)
    loaded, was_stored = X.load_or_fit(path, fit, rows)
    sums = []
    for encoder in (fitted, loaded):
        total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, v: a + v)
        sums.append(encoder.transform(rows).select("record_id", total.alias("total")))
    both = M.one_to_one_join(sums[0], sums[1], "record_id", ("_fitted", "_loaded"))
    return M.disagreements(both, "total_fitted", "total_loaded").withColumn("was_stored", F.lit(was_stored))


def loaded_encoder_vectors(spark, d):
    """What a stored encoder makes of the rows once it is loaded again."""
    rows = split_rows(spark, d)
    path = scratch_path(spark, "encoders")
    X.fit_keep_unknown(rows.filter(F.col("split") == SPLITS[0]), ROLES).save(path)
    return _encoded_text(X.load_encoder(spark, path).transform(rows), len(ROLES.numeric))


# --- damaged copies: checks that find something ------------------------------


def damaged(df: DataFrame, key: str, missing: str | None = None, not_a_number: str | None = None, infinite: str | None = None) -> DataFrame:
    """One rule for all damaged copies, by the remainder of the key divided by 97.

    1: ``missing`` is NULL. 2: ``not_a_number`` is NaN. 3: ``infinite`` is
    infinity, 4: minus infinity. The other remainders are left to ``changed``.
    """
    by = F.col(key) % 97
    cells: dict[str, Column] = {}
    if missing:
        cells[missing] = F.when(by != 1, F.col(missing))
    if not_a_number:
        value = cells.get(not_a_number, F.col(not_a_number))
        cells[not_a_number] = F.when(by == 2, F.lit(float("nan"))).otherwise(value)
    if infinite:
        value = cells.get(infinite, F.col(infinite))
        cells[infinite] = F.when(by == 3, F.lit(float("inf"))).when(by == 4, F.lit(float("-inf"))).otherwise(value)
    return df.withColumns(cells)


def changed(df: DataFrame, key: str, actual: str) -> DataFrame:
    """A damaged prediction table: remainder 5 comes twice, 6 is lost, 7 has another actual value, 1 no key."""
    by = F.col(key) % 97
    out = df.filter(by != 6).withColumns({actual: F.when(by == 7, F.col(actual) + 1).otherwise(F.col(actual))})
    out = out.unionByName(out.filter(by == 5))
    return out.withColumn(key, F.when(by != 1, F.col(key)))


def null_profile_damaged(spark, d):
    lines = damaged(table(spark, d, "lineitem"), "l_orderkey", "l_quantity", "l_tax")
    return P.null_profile(files.normalised(lines))


def reconcile_damaged(spark, d):
    both = staged(predictors(spark, d), "predictors")
    source = one_model(both, "segment", "test")
    return M.reconcile(changed(one_model(both, "priority", "test"), "record_id", "actual_target"), source, "record_id", "actual_target")


def feature_matrix_damaged(spark, d):
    rows = damaged(split_rows(spark, d), "record_id", "qty", "totalprice", "acctbal")
    done = training.prepare(rows, ROLES, invalid="keep")
    return X.feature_matrix_check(done.rows, "split")


def importance_checks_damaged(spark, d):
    """Brands by the last digit of their name: some without an importance, some with a negative one."""
    value = F.when(F.col("p_brand").endswith("1"), F.lit("nan")).when(F.col("p_brand").endswith("2"), F.lit("-0.5")).otherwise(F.lit("0.25"))
    encoded = table(spark, d, "part").select("p_brand").distinct().select(
        F.substring("p_brand", 1, 7).alias("model"), F.concat(F.lit("f"), "p_brand").alias("feature"), value.alias("importance")
    )
    rolled = I.rolled_up(encoded, [])
    return I.importance_checks(rolled.withColumn("importance_encoded", F.when(F.col("feature").endswith("3"), F.lit(float("inf"))).otherwise(F.col("importance_encoded")))).drop("total")


def histogram_damaged(spark, d):
    events = damaged(table(spark, d, "events"), "event_id", "value", "value", "value")
    cells = D.equal_width_histogram(events, "value", 50)
    finite = lambda c: F.when(F.abs(c) < float("inf"), F.round(c, 6)).alias(c)
    return cells.select("bin", finite("lower"), finite("upper"), "n")


# --- results of another program ----------------------------------------------


def _foreign_csv(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """``df`` written as CSV under other column names and read back as text."""
    spark = df.sparkSession
    path = scratch_path(spark, "foreign")
    files.write_table(df.select(*[F.col(c).alias(n) for c, n in names.items()]).coalesce(1), path, "csv")
    return spark.read.option("header", True).csv(path)


def foreign_searches(spark, d) -> dict[str, DataFrame]:
    """Two search tables in the columns of two other programs, mapped to the names used here."""
    search = staged(mean_search(spark, d), "search").orderBy("place")
    single = {"trees": "n_estimators", "depth": "max_depth", "leaf": "min_samples_leaf", "RMSE": "rmse_val", "MAE": "mae_val", "R2": "r2_val", "fit_seconds": "train_time_s", "share": "pred_time_s"}
    spread = {"trees": "numTrees", "depth": "maxDepth", "MAE": "validation_MAE", "RMSE": "validation_RMSE", "R2": "validation_R2", "fit_seconds": "fit_time_seconds"}
    # One of them writes whole numbers with a fraction where a cell of the column is empty.
    first = search.filter("place % 2 = 0").withColumns({"depth": F.col("depth").cast("double"), "leaf": F.col("place"), "share": F.lit("n/a")})
    return {
        "single": mapped(_foreign_csv(first, single), SINGLE_NODE.search, "single-node search"),
        "spread": mapped(_foreign_csv(search.filter("place % 2 = 1"), spread), DISTRIBUTED.search, "distributed search"),
    }


def foreign_summary(spark, d):
    """Model summary from search tables and run info in the layouts of two other programs."""
    found = foreign_searches(spark, d)
    info = staged_run_info(spark, d)
    lines = []
    for name, layout, mode, own in (("single", SINGLE_NODE, "one machine", None), ("spread", DISTRIBUTED, "cluster", info)):
        best = C.best_configuration(found[name], "validation_RMSE", "place", layout.configuration(), "fit_seconds")
        lines.append(C.summary_row(best, name, layout.framework, mode, own))
    return rounded(lines[0].unionByName(lines[1]))


def foreign_search_rows(spark, d):
    found = foreign_searches(spark, d)
    columns = ["trees", "depth", "validation_MAE", "validation_RMSE", "validation_R2", "fit_seconds"]
    parts = [found[n].select(F.lit(n).alias("model"), *columns, more.cast("double").alias("predict_seconds")) for n, more in (("single", F.col("predict_seconds")), ("spread", F.lit(None)))]
    return rounded(parts[0].unionByName(parts[1]), 4, columns[2:])


def foreign_comparison(spark, d):
    """Metric table of two models from files whose other columns are not wanted."""
    both = staged(predictor_metrics(spark, d), "metrics")
    tables = {}
    for model, layout, more in (("priority", SINGLE_NODE, {"n": "pred_time_s"}), ("segment", DISTRIBUTED, {})):
        names = {"split": "split", **{m: m for m in C.METRICS}, **more}
        tables[model] = mapped(_foreign_csv(both.filter(F.col("model") == model), names), layout.metrics, model)
    place = split_position(F.col("split")).cast("long").alias("place")
    return rounded_metrics(C.metric_table(tables).select(place, "split", "model", *C.METRICS))


def foreign_importances(spark, d):
    """Roll-up of importances whose files name the columns differently and hold cells that are no number."""
    encoded = staged(encoded_importances(spark, d), "importances")
    parts = None
    for model, layout, shown in (("ignore", SINGLE_NODE, "feature"), ("keep", DISTRIBUTED, "feature_name")):
        text = F.when(F.col("feature") == "p_container", F.lit("none given")).otherwise(F.col("importance").cast("string"))
        rows = encoded.filter(F.col("model") == model).select("feature", text.alias("importance"))
        part = mapped(_foreign_csv(rows, {"feature": shown, "importance": "importance"}), layout.importances, model).withColumn("model", F.lit(model))
        parts = part if parts is None else parts.unionByName(part)
    out = I.importance_rollup(parts, PART_FEATURES).withColumn("rank", F.col("rank").cast("long"))
    return rounded(out, 6)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "zero_rate_by_category": zero_rate_by_category,
    "zero_rate_by_bin": zero_rate_by_bin,
    "zero_share": zero_share,
    "null_profile": null_profile,
    "schema_profile": schema_profile,
    "preview": preview,
    "duplicate_rows": duplicate_rows,
    "describe_numeric": describe_numeric,
    "quantiles_by_counting": quantiles_by_counting,
    "describe_by_zero": describe_by_zero,
    "cardinality": cardinality,
    "value_counts_top": value_counts_top,
    "rule_violations": rule_violations,
    "dataset_summary": dataset_summary,
    "iqr_outliers": iqr_outliers,
    "upper_outlier_describe": upper_outlier_describe,
    "upper_outlier_top": upper_outlier_top,
    "target_by_category": target_by_category,
    "correlation_with_target": correlation_with_target,
    "correlation_ascending": correlation_ascending,
    "stratified_split": stratified,
    "split_zero_ratio": split_zero_ratio,
    "seeded_sample": sample,
    "equal_width_histogram": equal_width_histogram,
    "scatter_grid": scatter_grid,
    "one_to_one_compare": one_to_one_compare,
    "reconcile_predictions": reconcile_predictions,
    "actual_agreement": actual_agreement,
    "positional_attach": positional_attach,
    "regression_metrics": regression_metrics,
    "comparison_metrics": comparison_metrics,
    "generalisation_gap": generalisation_gap,
    "metric_deltas": metric_deltas,
    "prediction_difference": prediction_difference,
    "prediction_bounds": prediction_bounds,
    "best_config": best_config,
    "configs_in_order": configs_in_order,
    "importance_rollup": importance_rollup,
    "importance_expected_set": importance_expected_set,
    "importance_checks": importance_checks,
    "importance_by_model": importance_by_model,
    "importance_totals": importance_totals,
    "top_features_per_model": top_features_per_model,
    "run_info_parse": run_info_parse,
    "run_info_sink": run_info_sink,
    "csv_roundtrip": csv_roundtrip,
    "csv_missing_tokens": csv_missing_tokens,
    "coerced_cast": coerced_cast,
    "scaled_numeric": scaled_numeric,
    "onehot_ignore": onehot_ignore,
    "onehot_keep": onehot_keep,
    "encoded_feature_names": encoded_feature_names,
    "level_dictionary": level_dictionary,
    "full_vector_scaled": full_vector_scaled,
    "feature_matrix_check": feature_matrix_check,
    "forest_metrics": forest_metrics,
    "forest_baseline": forest_baseline,
    "forest_importance": forest_importance,
    "forest_importance_rollup": forest_importance_rollup,
    "forest_grid_search": forest_grid_search,
    "forest_best_metrics": forest_best_metrics,
    "forest_predictions": forest_predictions,
    "forest_prediction_records": forest_prediction_records,
    "forest_reconciled": forest_reconciled,
    "forest_checks": forest_checks,
    "forest_search_checks": forest_search_checks,
    "feature_model_roundtrip": feature_model_roundtrip,
    "loaded_encoder_vectors": loaded_encoder_vectors,
    "null_profile_damaged": null_profile_damaged,
    "reconcile_damaged": reconcile_damaged,
    "feature_matrix_damaged": feature_matrix_damaged,
    "importance_checks_damaged": importance_checks_damaged,
    "histogram_damaged": histogram_damaged,
    "foreign_summary": foreign_summary,
    "foreign_search_rows": foreign_search_rows,
    "foreign_comparison": foreign_comparison,
    "foreign_importances": foreign_importances,
}
