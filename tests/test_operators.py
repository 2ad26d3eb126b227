import math
import random

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import comparison as C
from ridgeline.operators import distribution as D
from ridgeline.operators import importance as I
from ridgeline.operators import matching as M
from ridgeline.operators import profiling as P
from ridgeline.operators import quality as Q
from ridgeline.operators import quantiles as QT
from ridgeline.operators import ranking as RK
from ridgeline.operators import regression as R
from ridgeline.operators import splitting as S
from ridgeline.plans.catalog import group_mean_predictions


def brute_quantile(values, p):
    ordered = sorted(values)
    at = p * (len(ordered) - 1)
    low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


VALUE_SETS = {
    "ties": [5.0] * 70 + [6.0] * 20 + [-3.0] * 10,
    "signs": [float(x) for x in range(-50, 50)],
    "wide": [10.0**e * s for e in range(-300, 300, 7) for s in (1, -1)],
    "one": [4.25],
    "zeros": [0.0] * 5 + [1e-320, -1e-320],
    "close": [1.0 + i * 2**-52 for i in range(300)],
}


@pytest.mark.parametrize("limit", [0, 7, 10**6])
@pytest.mark.parametrize("name", sorted(VALUE_SETS))
def test_quantiles_match_brute_force(spark, name, limit):
    values = VALUE_SETS[name]
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    df = spark.createDataFrame([(v,) for v in values + [None]], "v double")
    got = {r["prob"]: r["value"] for r in QT.exact_quantiles(df, ["v"], probs, interval_limit=limit).collect()}
    for p in probs:
        assert math.isclose(got[p], brute_quantile(values, p), rel_tol=1e-14), (p, got[p])


def test_quantiles_by_group_and_column(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), rng.gauss(0, 1), rng.randrange(5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, x double, n int")
    for limit in (0, 50, 10**6):
        got = QT.exact_quantiles(df, ["x", "n"], [0.25, 0.9], by=["g"], interval_limit=limit).collect()
        assert len(got) == 12
        for r in got:
            place = 1 if r["column"] == "x" else 2
            members = [float(row[place]) for row in rows if row[0] == r["g"]]
            assert math.isclose(r["value"], brute_quantile(members, r["prob"]), rel_tol=1e-12)


@pytest.mark.parametrize("limit", [2, 1_000_000])
def test_quantiles_skip_nan_and_keep_infinity(spark, limit):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(nan,)] * 5 + [(None,)], "v double")
    got = {r["prob"]: r["value"] for r in QT.exact_quantiles(df, ["v"], [0.0, 0.5, 0.75, 0.9], interval_limit=limit).collect()}
    assert got == {0.0: 0.0, 0.5: 4.5, 0.75: 6.75, 0.9: pytest.approx(8.1)}
    df = spark.createDataFrame([(-inf,), (1.0,), (2.0,), (3.0,), (inf,)], "v double")
    got = {r["prob"]: r["value"] for r in QT.exact_quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.9, 1.0], interval_limit=limit).collect()}
    assert got == {0.0: -inf, 0.1: -inf, 0.5: 2.0, 0.9: inf, 1.0: inf}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert QT.exact_quantiles(df, ["v"], [0.5]).collect() == []


def test_describe_single_row(spark):
    row = P.describe(spark.createDataFrame([(2.0,)], "v double"), ["v"]).first()
    assert (row["count"], row["mean"], row["std"], row["q50"]) == (1, 2.0, None, 2.0)


def test_describe_empty(spark):
    row = P.describe(spark.createDataFrame([], "v double"), ["v"]).first()
    assert (row["count"], row["mean"], row["q25"]) == (0, None, None)


def test_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "v int")
    assert P.duplicate_rows(df).first().asDict() == {"n_rows": 3, "n_duplicates": 1}
    assert P.null_profile(df).first().asDict() == {"column": "v", "n_missing": 2, "total_missing": 2, "warn": True}
    assert P.duplicate_rows(df.limit(0)).first().asDict() == {"n_rows": 0, "n_duplicates": 0}


def test_cardinality_and_counts_skip_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "v string")
    assert P.cardinality(df, ["v"]).first()["n_distinct"] == 1
    assert [tuple(r) for r in P.value_counts(df, ["v"]).collect()] == [("v", 1, "a", 2)]


def test_dataset_summary(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 0.0), (2, None), (3, 5.0)], "a int, y double")
    got = {r["key"]: r["value"] for r in P.dataset_summary(df, "y").collect()}
    assert got == {
        "records": "4",
        "columns": "2",
        "missing_values": "1",
        "duplicate_rows": "1",
        "target": "y",
        "target_zero": "2",
        "target_zero_rate": "50.00%",
    }


def test_describe_by_zero_leaves_out_negative(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 3.0), (-1.0, 9.0)], "y double, x double")
    got = {r["subset"]: r["max"] for r in P.describe_by_zero(df, "y", ["x"]).collect()}
    assert got == {"zero": 1.0, "positive": 3.0}


def test_rules(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (2.0,), (None,)], "v double")
    got = {r["rule"]: r["n"] for r in Q.rule_violations(df, [Q.below("v", 0), Q.at_or_below("v", 0), Q.outside("v", 0, 1)]).collect()}
    assert got == {"v < 0": 1, "v <= 0": 2, "v outside [0, 1]": 2}
    assert len(Q.turbine_rules()) == 6


def test_outliers(spark):
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 100, 90])], "v double, i int")
    row = Q.iqr_outliers(df, ["v"]).first()
    assert (row["n_outliers"], row["percent"]) == (2, 20.0)
    assert [r["v"] for r in Q.upper_outlier_top(df, "v", "i", 1).collect()] == [100.0]
    assert Q.upper_outlier_describe(df, "v", ["v"]).first()["count"] == 2
    assert Q.iqr_outliers(df.limit(0), ["v"]).first()["n_outliers"] == 0


def test_histogram_of_values_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v, g) for v in (0.0, 10.0, inf, inf, -inf, nan, None) for g in "ab"] + [(5.0, "a"), (None, "c")], "v double, g string")
    got = {r["bin"]: (r["lower"], r["upper"], r["n"]) for r in D.equal_width_histogram(df, "v", 2).collect()}
    assert got == {0: (0.0, 5.0, 2), 1: (5.0, 10.0, 3), -1: (-inf, 0.0, 2), 2: (10.0, inf, 4), None: (None, None, 2)}
    by_group = D.equal_width_histograms(df, "v", 2, "g").filter("bin in (0, 1)").orderBy("g", "bin").collect()
    assert [(r["g"], r["n"]) for r in by_group] == [("a", 1), ("a", 2), ("b", 1), ("b", 1)]
    only = df.filter("v is null or isnan(v)")
    assert [(r["bin"], r["n"]) for r in D.equal_width_histogram(only, "v", 2).orderBy("bin").collect()] == [(None, 2), (0, 0), (1, 0)]
    assert D.scatter_grid(df, "v", "v", 2).agg(F.sum("n")).first()[0] == 5


def test_histogram_keeps_maximum_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (1.0,), (2.0,)], "v double")
    assert [r["n"] for r in D.equal_width_histogram(df, "v", 5).orderBy("bin").collect()] == [2, 1, 0, 0, 1]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    got = D.equal_width_histogram(flat, "v", 2).orderBy("bin").collect()
    assert [(r["lower"], r["upper"], r["n"]) for r in got] == [(2.5, 3.0, 0), (3.0, 3.5, 2)]


def test_correlation_places(spark):
    rows = [(1.0, -1.0, 5, 1.0), (2.0, -2.0, 1, 2.0), (3.0, -3.5, 4, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c int, y double")
    got = {r["feature"]: r for r in D.correlation_with_target(df, "y").collect()}
    assert got["a"]["place_by_strength"] == 1 and got["b"]["place_by_value"] == 1
    assert set(got) == {"a", "b", "c"}


def test_target_by_category_orders_by_mean(spark):
    rows = [("x", 1.0), ("x", 2.0), ("x", 9.0), ("y", 5.0), (None, 99.0)]
    got = D.target_by_category(spark.createDataFrame(rows, "g string, y double"), ["g"], "y").orderBy("place").collect()
    assert [(r["category"], r["count"], r["mean"], r["median"]) for r in got] == [("y", 1, 5.0, 5.0), ("x", 3, 4.0, 2.0)]


# --- split and sample -------------------------------------------------------


def numbered(spark, n):
    return spark.range(n).select(F.col("id"), F.when(F.col("id") % 7 == 0, 0.0).otherwise(1.0).alias("y"))


@pytest.mark.parametrize("limit", [0, 3, 10**6])
def test_split_is_exact(spark, limit):
    df = numbered(spark, 1000)
    got = S.stratified_split(df, "id", "y", rank_limit=limit).groupBy("split", "y").count().collect()
    counts = {(r["split"], r["y"]): r["count"] for r in got}
    zeros = 143
    expected = {}
    for y, n in ((0.0, zeros), (1.0, 1000 - zeros)):
        train, upto = n * 70 // 100, n * 85 // 100
        expected |= {("train", y): train, ("validation", y): upto - train, ("test", y): n - upto}
    assert counts == expected


def test_split_does_not_depend_on_layout(spark):
    df = numbered(spark, 300)
    a = S.stratified_split(df.repartition(3), "id", "y").orderBy("id").collect()
    b = S.stratified_split(df.repartition(5, "y"), "id", "y", rank_limit=0).orderBy("id").collect()
    assert a == b


@pytest.mark.parametrize("n", [0, 1, 37, 500, 900])
def test_sample_size(spark, n):
    df = numbered(spark, 500)
    for limit in (0, 10**6):
        assert S.seeded_sample(df, "id", n, rank_limit=limit).count() == min(n, 500)


def test_tiny_tables(spark):
    assert S.stratified_split(numbered(spark, 0), "id", "y").count() == 0
    assert [r["split"] for r in S.stratified_split(numbered(spark, 1), "id", "y").collect()] == ["test"]


def test_hot_identifier_ends(spark):
    df = spark.range(50).select(F.lit(1).alias("id"), F.lit(1.0).alias("y"))
    for limit in (0, 10**6):
        assert S.seeded_sample(df, "id", 10, rank_limit=limit).count() == 10


@pytest.mark.parametrize("limit", [0, 10**6])
def test_repeated_ids_keep_exact_shares(spark, limit):
    """Ten rows for every identifier, half of them alike in everything, and rows without one."""
    n = F.col("id")
    df = spark.range(1000).select((n % 100).alias("key"), F.when(n % 3 == 0, 0.0).otherwise(1.0).alias("y"), F.when(n < 500, n).alias("more"))
    df = df.withColumn("key", F.when(F.col("key") != 7, F.col("key")))
    counts = {(r["split"], r["y"]): r["count"] for r in S.stratified_split(df, "key", "y", rank_limit=limit).groupBy("split", "y").count().collect()}
    for y, rows in ((0.0, 334), (1.0, 666)):
        train, upto = rows * 70 // 100, rows * 85 // 100
        assert [counts[s, y] for s in ("train", "validation", "test")] == [train, upto - train, rows - upto]
    for size in (0, 5, 15, 333, 2000):
        assert S.seeded_sample(df, "key", size, rank_limit=limit).count() == min(size, 1000)
    first = S.stratified_split(df.repartition(3), "key", "y", rank_limit=limit).groupBy("key", "y", "more", "split").count()
    other = S.stratified_split(df.repartition(7, "y"), "key", "y", rank_limit=limit).groupBy("key", "y", "more", "split").count()
    assert first.exceptAll(other).count() == 0


def test_places_and_starts(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), (F.col("id") % 5).alias("n"))
    placed = RK.with_places(df.repartition(5), ["g"], [F.col("v").desc()], "place").collect()
    expected = {(g, v): i for g in range(3) for i, v in enumerate(sorted((v for v in range(2000) if v % 3 == g), reverse=True))}
    assert {(r["g"], r["v"]): r["place"] for r in placed} == expected
    started = {r["v"]: r["start"] for r in RK.with_starts(df.repartition(4), [F.col("v")], "n", "start").collect()}
    assert started == {v: sum(x % 5 for x in range(v)) for v in range(2000)}


# --- matching ---------------------------------------------------------------


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, actual double, p double")


def test_one_to_one_guard(spark):
    left = frame(spark, [(1, 1.0, 2.0), (2, 2.0, 2.0)])
    assert M.one_to_one_join(left, left, "id", ("_a", "_b")).count() == 2
    twice = frame(spark, [(1, 1.0, 2.0), (1, 1.0, 2.0)])
    with pytest.raises(Exception, match="not unique"):
        M.one_to_one_join(left, twice, "id", ("_a", "_b")).collect()
    assert M.one_to_one_join(frame(spark, [(None, 1.0, 1.0)]), left, "id", ("_a", "_b")).count() == 0


def test_reconcile(spark):
    source = frame(spark, [(1, 1.0, 0.0), (2, 2.0, 0.0), (3, 3.0, 0.0)])
    predicted = frame(spark, [(1, 1.0, 0.0), (1, 1.0, 0.0), (2, 2.5, 0.0), (9, 1.0, 0.0), (None, 1.0, 0.0)])
    got = {r["check"]: r["violations"] for r in M.reconcile(predicted, source, "id", "actual").collect()}
    assert got == {
        "row_count_difference": 2,
        "missing_key": 1,
        "repeated_key": 1,
        "not_predicted": 1,
        "not_in_source": 1,
        "actual_changed": 1,
    }
    M.require_reconciled(source, source, "id", "actual")
    with pytest.raises(ValueError, match="not_in_source"):
        M.require_reconciled(predicted, source, "id", "actual")


def test_actuals_must_agree(spark):
    left = spark.createDataFrame([(1, 1.0, 2.0)], "id long, actual_y double, predicted_y double")
    right = spark.createDataFrame([(1, 1.5, 2.5)], "id long, actual_y double, predicted_y double")
    with pytest.raises(Exception, match="differ"):
        C.compare_predictions(left, right, "id", "y", ("a", "b")).collect()
    row = C.compare_predictions(left, left, "id", "y", ("a", "b")).first()
    assert (row["error_a"], row["absolute_error_b"], row["prediction_difference"]) == (-1.0, 1.0, 0.0)


def test_positions_over_many_files(spark, tmp_path):
    values, ids = str(tmp_path / "values"), str(tmp_path / "ids")
    spark.range(0, 5000, 1, 4).select((F.col("id") * 2).alias("v")).write.csv(values, header=True)
    spark.range(0, 5000, 1, 7).select(F.col("id").alias("record_id")).write.csv(ids, header=True)
    read = lambda path, ddl: spark.read.schema(ddl).csv(path, header=True)
    joined = M.attach_ids(read(values, "v long"), read(ids, "record_id long"), "record_id")
    assert joined.count() == 5000 and joined.filter("v <> 2 * record_id").count() == 0
    with pytest.raises(ValueError, match="rows expected"):
        M.attach_ids(read(values, "v long"), read(ids, "record_id long").limit(10), "record_id")
    with pytest.raises(ValueError, match="exactly"):
        M.attach_ids(read(values, "v long"), read(ids, "other long"), "record_id")


def test_rows_of_a_task_are_bounded_when_ids_are_attached(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(0, 5000, 1, 2).select("id", (F.col("id") * 2).alias("v")).write.parquet(path)
    monkeypatch.setattr(M, "ROWS_PER_PARTITION", 500)
    files = spark.read.parquet(path)
    joined = M.attach_ids(files.select("v"), files.select("id"), "id")
    assert joined.count() == 5000 and joined.filter("v <> 2 * id").count() == 0
    dealt = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert len(dealt) == 10 and max(dealt) < 1000
    assert "hashpartitioning(_path" not in joined._jdf.queryExecution().executedPlan().toString()


def test_positions_survive_other_file_splits(spark, tmp_path):
    """Files cut in one way when the frame is built and in another when it runs."""
    values, ids = str(tmp_path / "values"), str(tmp_path / "ids")
    spark.range(0, 60000, 1, 3).select((F.col("id") * 2).alias("v"), F.lit("x" * 30).alias("w")).write.csv(values, header=True)
    spark.range(0, 60000, 1, 2).select(F.col("id").alias("record_id")).write.csv(ids, header=True)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "200000")
        files = spark.read.schema("v long, w string").csv(values, header=True)
        joined = M.attach_ids(files, spark.read.schema("record_id long").csv(ids, header=True), "record_id")
        spark.conf.set(key, "300000")
        assert joined.count() == 60000 and joined.filter("v <> 2 * record_id").count() == 0
    finally:
        spark.conf.set(key, before)


def test_group_means_keep_rows_of_unseen_levels(spark):
    rows = spark.createDataFrame(
        [("train", "a", 1.0), ("train", "a", 2.0), ("train", "b", 6.0), ("test", "c", 5.0), ("test", None, 4.0)],
        "split string, kind string, target double",
    )
    out = {(r["split"], r["kind"], r["target"]): r["by_kind"] for r in group_mean_predictions(rows, ["kind"]).collect()}
    assert len(out) == 5 and out["test", "c", 5.0] == out["test", None, 4.0] == 3.0 and out["train", "a", 1.0] == 1.5


def test_rows_in_order(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    assert [r["v"] for r in M.rows_in_order(df, ["c", "a"], "k").collect()] == [3, 1]


# --- metrics and comparison -------------------------------------------------


def test_metrics(spark):
    df = spark.createDataFrame([("t", 1.0, 2.0), ("t", 3.0, 3.0), ("c", 5.0, 5.0), ("t", None, 1.0)], "s string, y double, p double")
    got = {r["s"]: r for r in R.regression_metrics(df, "y", "p", "s").collect()}
    assert (got["t"]["n"], got["t"]["MAE"], got["t"]["R2"]) == (2, 0.5, 0.5)
    assert got["t"]["RMSE"] == pytest.approx(math.sqrt(0.5))
    assert got["c"]["R2"] is None


# Published metrics of the two models; the expected deltas follow from them.
FIRST = [("train", 9.039618580155702, 11.107241026725278, 0.7524813863961306),
         ("test", 12.587086901289055, 15.896207518903505, 0.4919988423955154)]
SECOND = [("train", 11.955564896690827, 14.854791835827372, 0.5572805399653369),
          ("test", 12.6137502256603, 15.843621072637434, 0.4953543332098589)]


def published(spark):
    ddl = "split string, MAE double, RMSE double, R2 double"
    return C.metric_table({"a": spark.createDataFrame(FIRST, ddl), "b": spark.createDataFrame(SECOND, ddl)})


def test_published_deltas(spark):
    got = {r["metric"]: r for r in C.metric_deltas(published(spark), "a", "b").collect()}
    assert round(got["RMSE"]["difference"], 6) == -0.052586 and got["RMSE"]["verdict"] == "better"
    assert round(got["MAE"]["difference"], 6) == 0.026663 and got["MAE"]["verdict"] == "worse"
    assert round(got["R2"]["difference"], 6) == 0.003355 and got["R2"]["verdict"] == "better"
    assert round(got["RMSE"]["percent"], 2) == 0.33 and round(got["MAE"]["percent"], 2) == 0.21


def test_published_gaps(spark):
    got = {r["model"]: round(r["gap"], 6) for r in C.generalisation_gap(published(spark)).collect()}
    assert got == {"a": 4.788966, "b": 0.988829}


def test_metric_table_order(spark):
    assert [(r["split"], r["model"]) for r in published(spark).collect()] == [
        ("train", "a"), ("train", "b"), ("test", "a"), ("test", "b"),
    ]


def test_best_configuration_first_wins(spark):
    from ridgeline.plans.comparison import forest_label

    search = spark.createDataFrame(
        [(1, 100, None, 2, 9.0, 1.0), (2, 200, 20.0, 2, 8.0, 2.0), (3, 300, None, 2, 8.0, 3.0)],
        "place int, trees int, depth double, min_leaf int, rmse double, s double",
    )
    label = forest_label("trees", "depth", "min_leaf")
    row = C.best_configuration(search, "rmse", "place", label, "s").first()
    assert tuple(row) == ("trees=200, depth=20, min_leaf=2", 3, 8.0, 2.0)
    unlimited = C.best_configuration(search.filter("place = 3"), "rmse", "place", label, "s").first()
    assert unlimited["best_configuration"] == "trees=300, depth=None, min_leaf=2"


def test_value_bounds(spark):
    df = spark.createDataFrame([(1.0, 5.0), (-2.0, 3.0)], "a double, b double")
    assert tuple(C.value_bounds(df, ["a", "b"]).first()) == (-2.0, 5.0)
    assert tuple(C.value_bounds(df, ["a"]).first()) == (-2.0, 1.0)


# --- importances ------------------------------------------------------------


def encoded(spark, rows):
    return spark.createDataFrame([("m", *r) for r in rows], "model string, feature string, importance string")


def test_rank_ties_and_rollup(spark):
    df = encoded(spark, [("num__a", "0.4"), ("cat__b_1", "0.1"), ("cat__b_2", "0.3"), ("num__c", "0.2"), ("odd", "0")])
    got = {r["feature"]: (round(r["importance"], 9), r["rank"]) for r in I.importance_rollup(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (0.4, 1), "b": (0.4, 1), "c": (0.2, 3)}
    extra = I.expected_set_check(I.rolled_up(df, ["a", "b", "c"]), ["a", "b", "c"]).collect()
    assert [(r["feature"], r["problem"]) for r in extra] == [("odd", "extra")]


def test_rollup_refuses_gaps_and_bad_values(spark):
    with pytest.raises(ValueError, match="missing features: m: b"):
        I.importance_rollup(encoded(spark, [("a", "1")]), ["a", "b"])
    with pytest.raises(ValueError, match="bad importances"):
        I.importance_rollup(encoded(spark, [("a", "-1")]), ["a"])
    coerced = I.importance_rollup(encoded(spark, [("a", "1"), ("b", "none")]), ["a", "b"]).collect()
    assert {r["feature"]: r["importance"] for r in coerced} == {"a": 1.0, "b": 0.0}


def test_importance_checks(spark):
    row = I.importance_checks(I.rolled_up(encoded(spark, [("a", "0.995"), ("b", "Infinity")]), ["a", "b"])).first()
    assert row["n_not_finite"] == 1 and not row["total_is_one"]


def test_by_model_fills_zero_and_orders(spark):
    ranked = spark.createDataFrame([("m", "a", 0.1), ("m", "b", 0.6), ("n", "a", 0.9)], "model string, feature string, importance double")
    got = [tuple(r) for r in I.importance_by_model(ranked, ["m", "n"]).collect()]
    assert got == [("b", 0.6, 0.0, 0.6), ("a", 0.1, 0.9, 0.9)]


def test_parts_of_one_scan(spark):
    """What operators make of a shared row is what they make of their own, and all of it takes one scan."""
    from ridgeline.operators.fused import together

    rows = [(i, float(i % 7) if i % 5 else None, float(i * 37 % 101), f"k{i % 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, y double, c string")
    parts = {
        "missing": P.null_part(df.columns),
        "summary": P.summary_part(df.columns, "x", (200, 200)),
        "described": P.describe_part(df, ["x"]),
        "rules": Q.rule_part([Q.below("x", 3), Q.outside("id", 10, 20)]),
        "zeros": P.zero_part("x"),
        "correlation": D.correlation_part(df, "x", ["id"]),
    }
    alone = {
        "missing": P.null_profile(df),
        "summary": P.dataset_summary(df, "x"),
        "described": P.describe(df, ["x"]),
        "rules": Q.rule_violations(df, [Q.below("x", 3), Q.outside("id", 10, 20)]),
        "zeros": P.zero_rate(df, "x"),
        "correlation": D.correlation_with_target(df, "x", ["id"]),
    }
    got = together(df, parts)
    for name, frame in got.items():
        assert sorted(map(str, frame.collect())) == sorted(map(str, alone[name].collect())), name
    fences = Q.fences_of(got["described"]).first()
    assert tuple(fences) == tuple(Q.iqr_fences(df, ["x"]).first())
    distinct, frequent = P.category_tables(df, ["c"], 2)
    assert distinct.collect() == P.cardinality(df, ["c"]).collect() and frequent.collect() == P.value_counts(df, ["c"], 2).collect()
