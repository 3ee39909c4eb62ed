import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from fleetgauge.operators import fill, panel


def day(n):
    return dt.date(2024, 1, n)


def days_frame(spark, *items, schema="k string, d date, x double"):
    return spark.createDataFrame(list(items), schema)


def test_streak_counts_days_before(spark):
    df = days_frame(spark, *[("a", day(n), 0.0) for n in (1, 2, 4, 5, 6, 9, 6)])
    out = panel.streak_before(df, ["k"], "d")
    assert [r.streak_before for r in out.orderBy("d").collect()] == [0, 1, 0, 1, 2, 0]


def test_streak_on_a_panel_shares_its_exchange_with_rolling(spark):
    df = days_frame(spark, *[("a", day(n), float(n)) for n in (1, 2, 4, 5, 6, 9)])
    out = panel.streak_before(df, ["k"], "d", on_panel=True)
    assert [(r.x, r.streak_before) for r in out.orderBy("d").collect()] == [(1, 0), (2, 1), (4, 0), (5, 1), (6, 2), (9, 0)]
    plan = panel.rolling(out, ["k"], "d", ["x"], ["sum"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_streak_equals_its_definition(spark, table):
    events = table("events").select("user_id", F.to_date("ts").alias("d"))
    got = {(r.user_id, r.d): r.streak_before for r in panel.streak_before(events, ["user_id"], "d").collect()}
    assert len(got) == 4006
    for (user, d), streak in got.items():
        n = 0
        while (user, d - dt.timedelta(days=n + 1)) in got:
            n += 1
        assert n == streak


def test_densify_and_runs(spark):
    df = days_frame(spark, ("a", day(1), 0.0), ("a", day(2), 0.0), ("a", day(5), 0.0), ("b", day(3), 0.0))
    out = panel.densify_days(df, ["k"], "d")
    assert rows(out, "k", "d", "present") == [
        ("a", day(1), 1), ("a", day(2), 1), ("a", day(3), 0), ("a", day(4), 0), ("a", day(5), 1),
        ("b", day(3), 1),
    ]
    numbered = panel.runs(out, ["k"], "d", "present")
    assert [(r.run, r.run_total) for r in numbered.where("k = 'a'").orderBy("d").collect()] == [
        (1, 1), (1, 2), (2, 0), (2, 0), (3, 1),
    ]


def test_rolling_sum_includes_eight_days(spark):
    df = days_frame(spark, ("a", day(1), 1.0), ("a", day(8), 2.0), ("a", day(9), 4.0))
    out = panel.rolling(df, ["k"], "d", ["x"], ["sum"], days=8, exclude_current=False)
    assert [r.x_8d_sum for r in out.orderBy("d").collect()] == [1, 3, 6]


def test_rolling_without_current(spark):
    df = days_frame(spark, ("a", day(1), 2.0), ("a", day(2), 4.0), ("a", day(3), None), ("a", day(9), 10.0))
    out = panel.rolling(df, ["k"], "d", ["x"], ["mean", "count", "std", "max"], days=8).orderBy("d").collect()
    assert [r.x_8d_mean for r in out] == [None, 2.0, None, 4.0]
    assert out[0].x_8d_count is None and out[1].x_8d_count == 1
    assert out[0].x_8d_std is None
    assert [r.x_8d_max for r in out] == [2, 4, 4, 10]


def test_rolling_plans_one_window_and_one_sort(spark):
    df = days_frame(spark, ("a", day(1), 2.0)).withColumn("y", F.col("x") + 1)
    out = panel.rolling(df, ["k"], "d", ["x", "y"], panel.ROLLING_FUNCS, days=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("Sort [") == 1


def test_rolling_refuses_bad_input(spark):
    df = days_frame(spark, ("a", day(1), 2.0), ("a", day(1), 3.0))
    with pytest.raises(ValueError):
        panel.rolling(df, ["k"], "d", ["x"], ["median"])
    with pytest.raises(SparkRuntimeException, match="more than one row"):
        panel.rolling(df, ["k"], "d", ["x"], ["sum"]).collect()


def test_rolling_mean_equals_self_join(spark, table):
    daily = table("events").groupBy("user_id", F.to_date("ts").alias("d")).agg(F.sum("value").alias("x"))
    got = panel.rolling(daily, ["user_id"], "d", ["x"], ["mean"], days=8)
    other = daily.select(F.col("user_id").alias("u"), F.col("d").alias("e"), F.col("x").alias("y"))
    before = F.datediff("d", "e").between(1, 7)
    want = daily.join(other, (F.col("user_id") == F.col("u")) & before, "left").groupBy("user_id", "d").agg(F.avg("y").alias("w"))
    bad = got.join(want, ["user_id", "d"]).where(
        ~F.round("x_8d_mean", 6).eqNullSafe(F.round("w", 6))
    )
    assert bad.count() == 0


@pytest.mark.parametrize("min_rows", [10**6, 0])
def test_fill_forward_backward(spark, min_rows):
    items = [("a", day(1), None), ("a", day(2), 0.0), ("a", day(3), 5.0), ("a", day(4), -1.0), ("a", day(5), 7.0)]
    items += [("b", day(1), 0.0), ("b", day(2), None), (None, day(1), None), (None, day(2), 3.0)]
    out = fill.fill_forward_backward(days_frame(spark, *items), ["k"], ["d"], "x", min_rows=min_rows)
    got = {}
    for r in out.orderBy("d").collect():
        got.setdefault(r.k, []).append(r.x)
    assert got == {"a": [5, 5, 5, 5, 7], "b": [-1, -1], None: [-1, -1]}


def test_fill_through_the_whole_table(spark):
    df = days_frame(spark, ("a", day(1), 1.0), ("b", day(1), None), ("b", day(2), 2.0), ("c", day(1), None))
    whole = fill.forward_fill(df, ["k"], ["d"], ["x"], across_groups=True)
    assert rows(whole, "k", "d", "x") == [("a", day(1), 1), ("b", day(1), 1), ("b", day(2), 2), ("c", day(1), 2)]
    grouped = fill.forward_fill(df, ["k"], ["d"], ["x"])
    assert rows(grouped.where("k = 'b'"), "d", "x") == [(day(1), None), (day(2), 2)]


def test_chunked_fill_equals_the_plain_window_on_hot_keys(spark):
    n = 5000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        F.col("id").alias("d"),
        F.when(F.col("id") % 401 == 0, F.col("id").cast("double")).alias("x"),
    )
    chunked = fill.fill_forward_backward(df, ["k"], ["d"], "x", valid=F.col("x").isNotNull(), min_rows=1000)
    plain = fill.fill_forward_backward(df, ["k"], ["d"], "x", valid=F.col("x").isNotNull())
    assert chunked.count() == n
    assert chunked.exceptAll(plain).count() == 0


@pytest.mark.parametrize("min_rows", [10**6, 0])
def test_a_backward_fill_reads_the_rows_of_a_key_once(spark, min_rows):
    items = [("a", day(n), x) for n, x in enumerate([None, None, 5.0, None, 7.0], 1)] + [("b", day(1), None), ("b", day(2), 3.0)]
    out = fill.fill_forward_backward(days_frame(spark, *items), ["k"], ["d"], "x", min_rows=min_rows, chunks=3)
    assert rows(out) == [
        ("a", day(1), 5), ("a", day(2), 5), ("a", day(3), 5), ("a", day(4), 5), ("a", day(5), 7), ("b", day(1), 3), ("b", day(2), 3),
    ]
    # A frame from a row to the end is made anew for every row.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    ends = [part[-40:] for part in plan.split("unboundedfollowing$()")[:-1]]
    assert ends and all("unboundedpreceding$()" in end for end in ends)
