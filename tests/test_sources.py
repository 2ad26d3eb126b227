import pytest
from pyspark.sql import types as T

from ridgeline.model import TURBINE
from ridgeline.operators.regression import ForestConfig
from ridgeline.sources import files, scratch
from ridgeline.sources import results as RS
from ridgeline.sources import run_info as RI


def test_csv_missing_tokens(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,x,s\n1,NA,null\n2,,\n3,NaN,keep\n4, 2.5 ,-\n")
    rows = files.read_csv(spark, str(path), T.StructType.fromDDL("id long, x double, s string")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None, None), (2, None, None), (3, None, "keep"), (4, 2.5, "-")]
    some = files.read_csv(spark, str(path), T.StructType.fromDDL("id long, x string, s string"), missing=["NA"])
    assert [r["s"] for r in some.orderBy("id").collect()] == ["null", None, "keep", "-"]


def test_csv_bad_value_is_an_error(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("x\nabc\n")
    with pytest.raises(Exception, match="CAST"):
        files.read_csv(spark, str(path), T.StructType.fromDDL("x double")).collect()


def test_csv_header_must_fit(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("y\n1\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(path), T.StructType.fromDDL("x double")).collect()


def test_csv_text_survives(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, "x,y"), (3, None)], "id long, s string")
    files.write_small_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_required_columns(spark):
    df = spark.range(1)
    assert files.require_columns(df, ["id"], "t") is df
    with pytest.raises(ValueError, match=r"t: missing columns \['a', 'b'\]"):
        files.require_columns(df, ["b", "a", "id"], "t")


def test_normalised(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], "a double, s string")
    assert [r["a"] for r in files.normalised(df).orderBy("s").collect()] == [None, 1.0]


def test_run_info_roundtrip(spark, tmp_path):
    info = RI.run_info(spark, (1, 2, 3), (7.318, 141.42, 500.39), ForestConfig(200, 12), 42, spark.createDataFrame([], "split string, MAE double, RMSE double, R2 double"))
    RI.write_run_info(info, str(tmp_path / "info"))
    row = RI.parse_run_info(spark, str(tmp_path / "info" / "text")).first()
    assert row["spark_version"] == spark.version and row["spark_master"] == spark.sparkContext.master
    assert tuple(row)[2:7] == (7.32, 141.42, 500.39, 200, 12)
    assert spark.read.schema(RI.RUN_INFO_SCHEMA).json(str(tmp_path / "info" / "json")).first() == info.first()


def test_run_info_missing_entries(spark, tmp_path):
    (tmp_path / "t.txt").write_text("Spark Version: \nPreprocessing fit time: 1.2.3s\nnumTrees: 5\n")
    row = RI.parse_run_info(spark, str(tmp_path / "t.txt")).first()
    assert (row["spark_version"], row["preprocessing_fit_time_s"], row["best_num_trees"]) == (None, None, 5)


def test_scratch_follows_the_session(spark):
    assert scratch.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = spark.range(3)
    assert sorted(r["id"] for r in scratch.staged(df, "t").collect()) == [0, 1, 2]


def test_columns_of_another_program(spark):
    df = spark.createDataFrame(
        [("200", "20.0", "2", "15.825", "12.5", "", "97.2", "0.3", "x"), ("300", "", "2.5", "NaN", "n/a", "0.4", "oops", None, "y")],
        ", ".join(f"{c} string" for c in ("n_estimators", "max_depth", "min_samples_leaf", "rmse_val", "mae_val", "r2_val", "train_time_s", "pred_time_s", "more")),
    )
    rows = RS.mapped(df, RS.SINGLE_NODE.search, "search").drop("place").collect()
    assert tuple(rows[0]) == (200, 20, 2, 12.5, 15.825, None, 97.2, 0.3)
    assert tuple(rows[1]) == (300, None, None, None, None, 0.4, None, None)
    with pytest.raises(ValueError, match="missing columns .'fit_time_seconds', 'maxDepth', 'numTrees'"):
        RS.mapped(df.withColumnsRenamed({"rmse_val": "validation_RMSE", "mae_val": "validation_MAE", "r2_val": "validation_R2"}), RS.DISTRIBUTED.search, "search")
    either = [spark.createDataFrame([("a", "0.5")], f"{n} string, importance string") for n in ("feature", "feature_name")]
    assert [tuple(RS.mapped(e, RS.IMPORTANCES, "i").first()) for e in either] == [("a", 0.5)] * 2


def test_run_info_keeps_what_is_missing(spark, tmp_path):
    metrics = spark.createDataFrame([("train", 1.25, 2.0, 0.5), ("test", 1.0, 2.5, -0.25)], "split string, MAE double, RMSE double, R2 double")
    info = RI.run_info(spark, (1, 2, 3), (0.5, 1.25, 9.0), ForestConfig(10, None), 42, metrics)
    RI.write_run_info(info, str(tmp_path / "i"))
    row = RI.parse_run_info(spark, str(tmp_path / "i" / "text")).first()
    assert (row["train_MAE"], row["validation_RMSE"], row["test_R2"], row["best_max_depth"]) == (1.25, None, -0.25, None)
    assert (row["mode"], row["executors"]) == (f"Local mode: {spark.sparkContext.master}", "N/A (local mode)")


def test_turbine_schema():
    assert len(TURBINE.columns) == 15 and len(TURBINE.features) == 13
    assert [f.dataType.simpleString() for f in TURBINE.schema().fields].count("double") == 10
