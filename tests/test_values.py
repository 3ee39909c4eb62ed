"""NaN, mixed identifiers, hot keys, refined buckets, chunks and sinks."""

import os

import pytest
from pyspark.sql import functions as F

from fleetgauge import functions as fn, sources as io
from fleetgauge.operators import clean, fill, join, sampling, skew

from conftest import rows

NAN = float("nan")


def test_nan_is_null(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, NAN), (1, 3, None), (2, 1, NAN), (2, 2, 2.0)], "k int, t int, v double")
    assert rows(fn.nan_to_null(df)) == [(1, 1, 5.0), (1, 2, None), (1, 3, None), (2, 1, None), (2, 2, 2.0)]
    assert rows(fill.forward_fill(df, ["k"], ["t"], ["v"])) == [(1, 1, 5.0), (1, 2, 5.0), (1, 3, 5.0), (2, 1, None), (2, 2, 2.0)]
    assert rows(fill.fill_forward_backward(df, ["k"], ["t"], "v")) == [(1, 1, 5.0), (1, 2, 5.0), (1, 3, 5.0), (2, 1, 2.0), (2, 2, 2.0)]
    assert rows(clean.group_mean_fill(df, ["k"], ["v"])) == [(1, 1, 5.0), (1, 2, 5.0), (1, 3, 5.0), (2, 1, 2.0), (2, 2, 2.0)]
    assert clean.sigma_bounds(df, ["v"]).first().v.lo is not None
    assert rows(clean.standardize(df, ["v"]).select("k", "t", "v").where("t = 2")) [0][2] is None


def test_text_and_numbers(spark):
    df = spark.createDataFrame([("1.0", 1.0), ("2.", 0.0), ("1.5", None), ("90071992547409930", 3.0), ("1e3", 4.0)], "t string, n double")
    assert [r.i for r in df.select(fn.to_number(df, "t", "bigint").alias("i")).collect()] == [1, 2, None, 90071992547409930, None]
    assert df.where(fn.has_text("n")).count() == 4
    assert [r.x for r in df.select(fn.as_text(df, "n").alias("x")).collect()] == ["1", "0", None, "3", "4"]


def test_hot_keys_go_by_rows(spark, monkeypatch):
    df = spark.range(10_000).select(F.when(F.col("id") < 300, 7).otherwise(F.col("id")).alias("k"), "id")
    hot = skew.hot_keys(df, ["k"], min_rows=200)
    assert rows(hot) == [(7, 3)] and skew.hot_keys(df, ["k"], min_rows=300) is None
    monkeypatch.setattr(skew, "MOST_LISTED", 0)  # a list that is not sent to every executor
    right = spark.range(20).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert skew.skew_join(df, right, ["k"], min_rows=200).where("v = 1").count() == 300


@pytest.mark.parametrize("strata", [None, "s"])
def test_refined_buckets_give_the_same_cut(spark, monkeypatch, strata):
    df = spark.range(3000).withColumn("s", F.col("id") % 3)
    cuts = [lambda n: F.floor(n / 3), lambda n: F.floor(n / 2)]
    plain = rows(sampling.exact_cuts(df, "id", cuts, strata=strata))
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 1)
    monkeypatch.setattr(sampling, "RANKED_ROWS", 2)
    assert rows(sampling.exact_cuts(df, "id", cuts, strata=strata)) == plain


def test_chunks_carry_values_over_their_edges(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), "id", F.when(F.col("id") % 250 == 3, F.col("id")).alias("v"))
    chunked = fill.forward_fill(df, ["k"], ["id"], ["v"], across_groups=True, chunks=9)
    assert rows(chunked) == rows(fill.forward_fill(df, ["k"], ["id"], ["v"]))
    ranged = df.repartitionByRange(9, "k", "id").select(F.spark_partition_id()).distinct().count()
    assert ranged == 9


def test_trace_of_tables_that_multiply(spark):
    spine = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    many = spark.createDataFrame([(1, 5), (1, 6), (1, 6), (2, 5)], "k int, j int")
    more = spark.createDataFrame([(5, 1), (5, 2), (6, 3)], "j int, x int")
    dims = [join.Dim("many", many, ["k"]), join.Dim("more", more, ["j"])]
    want, out = [3], spine
    for d in (many, more):
        out = out.join(d, ["k"] if d is many else ["j"], "left")
        want.append(out.count())
    assert [r.rows for r in join.row_trace(spine, dims).orderBy("step").collect()] == want


def test_parquet_sinks(spark, tmp_path):
    path = str(tmp_path / "days")
    day = lambda d, n: spark.range(n).select(F.lit(d).alias("d"), F.col("id").alias("v")).repartition(5)
    assert io.write_parquet(day(1, 50).union(day(2, 50)), path, partition_by=["d"])
    assert len([f for f in os.listdir(f"{path}/d=1") if f.endswith(".parquet")]) == 1  # not one per task
    io.write_parquet(day(2, 7), path, partition_by=["d"], mode="replace_partitions")
    io.write_parquet(day(3, 4), path, partition_by=["d"], mode="append")
    assert rows(spark.read.parquet(path).groupBy("d").count()) == [(1, 50), (2, 7), (3, 4)]
    assert not io.write_parquet(day(1, 0), path, partition_by=["d"])
    with pytest.raises(ValueError):
        io.write_parquet(day(1, 1), path, mode="replace_partitions")
    assert spark.read.parquet(path).count() == 61


def test_an_empty_check_does_not_run_the_plan_twice(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(40).repartition(2).mapInArrow(count, "id long")
    assert io.write_parquet(df, str(tmp_path / "once")) and seen.value == 40
