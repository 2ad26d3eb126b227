"""Hot keys and plan shapes."""

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import matching as M
from ridgeline.operators import profiling as P
from ridgeline.operators import splitting as S
from ridgeline.plans.order_profile import order_profile


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def apply(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield apply
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_tables(spark, folder):
    """Half of all orders from one customer, half of all lines on one order."""
    n = 40_000
    i = F.col("id")
    hot = i % 2 == 0
    orders = spark.range(n).select(
        i.alias("o_orderkey"),
        F.when(hot, 5).otherwise(i % 997).cast("long").alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
        (i * 1.5).cast("double").alias("o_totalprice"),
        F.lit(None).cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    customer = spark.range(997).select(
        i.alias("c_custkey"),
        F.lit("c").alias("c_name"),
        (i % 25).cast("int").alias("c_nationkey"),
        i.cast("double").alias("c_acctbal"),
        F.lit("s").alias("c_mktsegment"),
    )
    nation = spark.range(25).select(
        i.cast("int").alias("n_nationkey"), F.lit("n").alias("n_name"), F.lit(0).alias("n_regionkey")
    )
    lineitem = spark.range(2 * n).select(
        F.when(hot, 7).otherwise(i % n).cast("long").alias("l_orderkey"),
        *[F.lit(1).cast("long").alias(c) for c in ("l_partkey", "l_suppkey")],
        F.lit(1).alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"),
        F.lit(10.0).alias("l_extendedprice"),
        F.lit(0.05).alias("l_discount"),
        F.lit(0.0).alias("l_tax"),
        F.lit("R").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
        F.lit(None).cast("timestamp_ntz").alias("l_shipdate"),
    )
    for name, df in {"orders": orders, "customer": customer, "nation": nation, "lineitem": lineitem}.items():
        df.repartition(4).write.parquet(f"{folder}/{name}.parquet")


def test_hot_customer_is_split_and_hot_order_combined(spark, tmp_path, settings):
    hot_tables(spark, str(tmp_path))
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    )
    q = order_profile(spark, str(tmp_path)).groupBy("status").agg(
        F.count(F.lit(1)), F.sum("n_lines"), F.sum("target"), F.sum("acctbal"), F.max("n_lines")
    )
    row = q.first()
    assert tuple(row)[1:4] == (40_000, 80_000.0, 800_000.0)
    assert row[5] == 40_002.0  # the even lines, and lines 7 and 40,007
    q.collect()
    assert "skew=true" in plan_of(q)


def test_split_and_sample_shuffle_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", (F.col("id") % 3).cast("double").alias("y")).write.parquet(path)
    df = spark.read.parquet(path)
    for result in (S.stratified_split(df, "id", "y"), S.seeded_sample(df, "id", 10)):
        assert "Exchange" not in plan_of(result) and "Window" not in plan_of(result)


def test_filters_and_columns_reach_the_scan(spark, data_dir):
    from ridgeline.operators.quality import above_upper_fence
    from ridgeline.plans.order_profile import table

    high = above_upper_fence(table(spark, data_dir, "events"), "value").select("event_id", "value")
    plan = plan_of(high)
    assert "GreaterThan(value" in plan and "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_unique_check_shares_the_join_shuffle(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    a = spark.range(100).select("id", F.rand(1).alias("v"))
    joined = M.one_to_one_join(a, a.withColumnRenamed("v", "w"), "id", ("_a", "_b"))
    assert plan_of(joined).count("Exchange hashpartitioning") == 2


def test_duplicates_shuffle_hashes_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    i = F.col("id")
    spark.range(3000).select((i % 2500).alias("a"), F.when(i % 3 > 0, (i % 2500).cast("string")).alias("b"), F.lit("x" * 40).alias("c")).write.parquet(path)
    df = spark.read.parquet(path)
    plans = []
    real = P.staged
    monkeypatch.setattr(P, "staged", lambda frame, label: plans.append(plan_of(frame)) or real(frame, label))
    expected = df.distinct().count()
    assert P.distinct_rows(df) == (3000, expected) and expected < 3000
    assert "Exchange hashpartitioning(_print_1" in plans[0] and "hashpartitioning(a" not in plans[0]


def test_rows_that_share_a_hash_stay_apart(spark, monkeypatch):
    rows = [(1, None, "x"), (None, 1, "x"), (1, None, "x"), (2, 2, None), (0, 3, "y"), (0, 3, "y"), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, b int, c string")
    assert P.distinct_rows(df) == (7, 5)
    names = ["_print_1", "_print_2"]
    monkeypatch.setattr(P, "_fingerprinted", lambda df: (df.withColumns({n: F.lit(1) for n in names}), names))
    assert P.distinct_rows(df) == (7, 5)
    assert P.distinct_rows(df.limit(0)) == (0, 0)


def test_top_values_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("string").alias("v"))
    assert "WindowGroupLimit" in plan_of(P.value_counts(df, ["v"], 3))
