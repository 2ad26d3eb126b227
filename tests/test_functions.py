from pyspark.sql import functions as F

from ridgeline.functions import scalars as S
from ridgeline.model import TURBINE


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_right_closed_bins(spark):
    values = [-1.0, 0.0, 0.5, 3.0, 3.1, 5.0, 30.0, 31.0, None]
    edges = [0, 3, 5, 30]
    label = S.bin_label(S.right_closed_bin(F.col("v"), edges), edges)
    expected = [None, None, "(0, 3]", "(0, 3]", "(3, 5]", "(3, 5]", "(5, 30]", None, None]
    assert column(spark, values, "double", label) == expected


def test_nan_becomes_null(spark):
    assert column(spark, [1.0, None, float("nan")], "double", S.nan_to_null(F.col("v"))) == [1.0, None, None]


def test_agreement(spark):
    rows = [(1.0, 1.000005), (1.0, 1.1), (None, 1.0), (float("nan"), float("nan")), (0.0, 0.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a double, b double").orderBy("i")
    got = [r[0] for r in df.select(S.agrees(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False, False, False, True]


def test_zero_denominator(spark):
    assert column(spark, [0], "int", S.percent(F.col("v"), F.col("v"))) == [None]


def test_texts(spark):
    assert column(spark, [27.485], "double", S.percent_text(F.col("v")))[0] in ("27.48%", "27.49%")
    assert column(spark, [0.026663], "double", S.fixed_text(F.col("v"), 6, signed=True)) == ["+0.026663"]
    assert column(spark, [None, 20.0], "double", S.depth_text(F.col("v"))) == ["None", "20"]


def test_verdict(spark):
    df = spark.createDataFrame([("R2", 0.1), ("R2", -0.1), ("MAE", 0.1), ("RMSE", -0.1)], "m string, d double")
    got = [r[0] for r in df.select(S.verdict(F.col("m"), F.col("d"))).collect()]
    assert got == ["better", "worse", "worse", "better"]


def test_base_feature(spark):
    names = [
        "cat__turbine_id_TB0011",
        "region_indexed_encoded___unknown",
        "num__humidity",
        " wind_speed ",
        "cat__region_Off_shore",
        "cat__unheard_of",
        "other",
        "other_indexed_encoded_x",
    ]
    expected = ["turbine_id", "region", "humidity", "wind_speed", "region", "cat__unheard_of", "other", "other"]
    assert column(spark, names, "string", S.base_feature(F.col("v"), TURBINE.features)) == expected


def test_longest_feature_wins(spark):
    assert column(spark, ["cat__wind_speed_max_1"], "string", S.base_feature(F.col("v"), ["wind_speed", "wind_speed_max"])) == [
        "wind_speed_max"
    ]


def test_finite(spark):
    values = [1.0, float("inf"), float("-inf"), float("nan"), None]
    assert column(spark, values, "double", S.is_finite(F.col("v"))) == [True, False, False, False, False]
