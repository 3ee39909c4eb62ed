import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetgauge.functions import one_hot, ratio, scale_units
from fleetgauge.operators import clean


def xs(spark, *values, schema="x double"):
    return spark.createDataFrame([(v,) for v in values], schema)


@pytest.mark.parametrize("values", [[7.0], [0.1] * 10, [None, None]])
def test_clip_leaves_degenerate_columns_alone(spark, values):
    out = clean.sigma_clip(xs(spark, *values), ["x"]).collect()
    assert [r.x for r in out] == values
    assert {r.outlier_count for r in out} == {0}


def test_clip_and_count(spark):
    df = spark.createDataFrame([(10.0, 1.0)] * 30 + [(500.0, 1.0), (None, 1.0)], "x double, y double")
    out = clean.sigma_clip(df, ["x", "y"])
    hit = out.where("outlier_count > 0").collect()
    mean = (10 * 30 + 500) / 31
    dev = ((30 * (10 - mean) ** 2 + (500 - mean) ** 2) / 30) ** 0.5
    assert len(hit) == 1 and hit[0].x == pytest.approx(mean + 3 * dev)
    assert out.where("x is null").count() == 1
    report = {r.field: r for r in clean.outlier_report(df, ["x", "y"]).collect()}
    assert report["x"].n == 1 and report["y"].n == 0
    assert report["x"].hi == pytest.approx(mean + 3 * dev)


def test_remove_drops_outliers_and_nulls(spark):
    df = xs(spark, *([10.0] * 30), 500.0, None)
    assert clean.sigma_clip(df, ["x"], method="remove").count() == 30


def test_without_zeros(spark):
    assert [r.x for r in clean.sigma_clip(xs(spark, 0.0, 0.0), ["x"], ignore_zero=True).collect()] == [0, 0]
    df = xs(spark, *([0.0] * 50), *([10.0] * 30), 500.0, None)
    out = clean.sigma_clip(df, ["x"], ignore_zero=True)
    assert "outlier_count" not in out.columns
    assert out.where("x = 0").count() == 50 and out.where("x > 10 and x < 500").count() == 1
    assert clean.sigma_clip(df, ["x"], method="remove", ignore_zero=True).count() == 80


def test_unknown_method_is_refused(spark):
    with pytest.raises(ValueError):
        clean.sigma_clip(xs(spark, 1.0), ["x"], method="drop")


def test_reset_flag(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 3), (None, 1)], "f int, n int")
    out = clean.reset_flag(df, "f", F.col("n") > 0)
    assert [r.f for r in out.collect()] == [0, 1, 0, None]


@pytest.mark.parametrize("min_rows", [10**6, 0])
def test_group_mean_fill(spark, min_rows):
    def fill(*items):
        df = spark.createDataFrame(list(items), "k string, i int, x double")
        return rows(clean.group_mean_fill(df, ["k"], ["x"], min_rows=min_rows), "i", "x")

    assert fill(("a", 1, 2.0), ("a", 2, None), ("a", 3, 4.0), ("b", 4, None)) == [(1, 2), (2, 3), (3, 4), (4, 3)]
    # the mean of the filled column, not of the original one
    assert fill(("a", 1, 0.0), ("a", 2, None), ("a", 3, None), ("b", 4, 9.0), ("c", 5, None))[-1] == (5, 2.25)
    # rows without a key have no group, but count for the overall mean
    assert fill((None, 1, 6.0), (None, 2, None), ("a", 3, 2.0), ("a", 4, None)) == [
        (1, 6), (2, pytest.approx(10 / 3)), (3, 2), (4, 2),
    ]


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert rows(clean.standardize(df, ["x", "y"])) == [(-1, 0), (1, 0)]
    only = clean.standardize(df, ["x"], fit_on=df.where("x = 1"))
    assert rows(only, "x") == [(0,), (2,)]


def test_global_statistics_are_one_reused_subquery(spark, table):
    out = clean.sigma_clip(table("events"), ["value"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_units_ratio_one_hot(spark):
    df = spark.createDataFrame([(1000.0, 0.0, "b"), (0.0, 0.0, None)], "a double, b double, c string")
    assert [r.r for r in df.select(ratio("a", "b").alias("r")).collect()] == [None, None]
    assert scale_units(df, {"a": 1000}).first().a == 1.0
    hot = one_hot(df, "c", ["a", "b"])
    assert hot.columns == ["a", "b", "c_a", "c_b"] and hot.first().c_b == 1 and hot.collect()[1].c_b == 0
