import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetgauge import functions as fn
from fleetgauge.operators import dims, join, rollup, skew


def test_latest_per_key_and_nulls(spark):
    df = spark.createDataFrame([("v", None, 1), ("v", dt.date(2024, 1, 1), 2), ("w", None, 3)], "k string, t date, i int")
    assert rows(dims.latest_per_key(df, ["k"], ["t", "i"]), "k", "i") == [("v", 2), ("w", 3)]
    assert rows(dims.latest_per_key(df, ["k"], ["t", "i"], nulls_win=True), "k", "i") == [("v", 1), ("w", 3)]
    assert rows(dims.first_per_key(df, ["k"], ["t", "i"]), "k", "i") == [("v", 2), ("w", 3)]


def test_one_row_per_key_is_cut_before_the_shuffle(table):
    plan = dims.latest_per_key(table("orders"), ["o_custkey"], ["o_orderdate"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_crosstab(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, None), (3, 9), (None, 1)], "k int, t int")
    assert rows(rollup.crosstab(df, ["k"], "t", {1: "one", 2: "two"})) == [(1, 1, 1), (3, 0, 0)]


def test_sum_of_nulls_is_zero(spark):
    df = spark.createDataFrame([("a", None), (None, 1.0)], "k string, x double")
    assert rows(rollup.sum_numeric(df, ["k"])) == [("a", 0.0)]


def test_id_attributes(spark):
    ids = [("440301198001011234",), ("110101198013011234",), ("1101011980010112X4",), ("440301",), (None,)]
    df = spark.createDataFrame(ids, "n string").where(F.length("n") == 18)
    got = df.select(fn.prefix_flag("n", "44").alias("r"), fn.digit_parity("n", 17).alias("s"), fn.compact_date("n", 7).alias("b"))
    assert rows(got) == rows(
        spark.createDataFrame(
            [(1, 1, dt.date(1980, 1, 1)), (0, 1, None), (0, None, dt.date(1980, 1, 1))], "r int, s int, b date"
        )
    )


def test_day_type(spark):
    listed = [
        (0, dt.date(2024, 1, 6), "transfer_workday"), (1, dt.date(2024, 1, 1), "public_holiday"),
        (2, dt.date(2024, 1, 3), "school_holiday"), (3, dt.date(2024, 1, 1), "transfer_workday"),
    ]
    holidays = spark.createDataFrame(listed, "position int, date date, type string")
    days = spark.createDataFrame([(dt.date(2024, 1, n),) for n in (1, 3, 6, 7)], "d date")
    assert rows(dims.day_type(days, "d", holidays)) == [
        (dt.date(2024, 1, 1), "public_holiday"), (dt.date(2024, 1, 3), "workday"),
        (dt.date(2024, 1, 6), "transfer_workday"), (dt.date(2024, 1, 7), "weekend"),
    ]


def test_exclude_keeps_null(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",)], "k string")
    assert rows(fn.exclude(df, {"k": ["x"]})) == [("y",), (None,)]


def test_normalise_ids(spark):
    df = spark.createDataFrame([(12, 12.0, "12"), (None, None, None), (7, 7.5, "07")], "a int, b double, c string")
    assert rows(fn.normalise_ids(df, "a", "b", "c")) == [("12", "12", "12"), ("7", "7.5", "07"), (None, None, None)]


@pytest.mark.parametrize("tz, day", [("UTC", 1), ("Asia/Shanghai", 2), ("+08:00", 2)])
def test_epoch_day(spark, tz, day):
    df = spark.createDataFrame([(1754070000,)], "t long")
    for session_tz in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", session_tz)
        try:
            assert df.select(fn.epoch_to_day("t", tz)).first()[0] == dt.date(2025, 8, day)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_warning_class_and_valid_alarm(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0), (4.0, 9.0), (3.0, None)], "t double, s double")
    got = df.select(fn.warning_class(fn.as_text(df, "t"), fn.as_text(df, "s")).alias("c"))
    assert [r.c for r in got.collect()] == ["fcw", "radar_brake", "inactive_warning", "ldw"]
    alarms = spark.createDataFrame([(0, 0), (0, 5), (1, 5), (2, 0), (None, 0)], "s int, t int")
    assert rows(alarms.where(fn.valid_alarm("s", "t"))) == [(0, 0), (1, 5)]


def test_contains_flag(spark):
    df = spark.createDataFrame([("CK-R1",), ("zz",), (None,)], "m string")
    assert [r.f for r in df.select(fn.contains_flag("m", "CK-R").alias("f")).collect()] == [1, 0, None]


def test_label_does_not_multiply(spark):
    spine = spark.createDataFrame([("a", 1), ("b", 1)], "k string, d int")
    events = spark.createDataFrame([("a", 1), ("a", 1), (None, 1)], "k string, d int")
    assert rows(dims.label_from_events(spine, events, ["k", "d"])) == [("a", 1, 1), ("b", 1, 0)]


def test_gate_refuses_fan_out(spark):
    spine = spark.createDataFrame([("a",), ("b",)], "k string")
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "id string, v int")
    with pytest.raises(join.FanOutError):
        join.wide_join(spine, [join.Dim("twice", twice, {"k": "id"})])
    # a repeated key no spine row asks for does no harm
    other = spark.createDataFrame([("z", 1), ("z", 2), ("a", 3)], "id string, v int")
    assert rows(join.wide_join(spine, [join.Dim("other", other, {"k": "id"})])) == [("a", 3), ("b", None)]
    trace = join.row_trace(spine, [join.Dim("other", other, {"k": "id"}), join.Dim("twice", twice, {"k": "id"}, drop=("v",))])
    assert rows(trace) == [(0, "spine", 2), (1, "other", 2), (2, "twice", 3)]
    with pytest.raises(join.FanOutError):
        join.row_count_gate(spine, spine.join(twice, spine.k == twice.id, "left"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_plain_join(spark, how):
    left = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 4000).cast("string"))).alias("k"),
        (F.col("id") % 5).alias("v"),
    )
    right = spark.range(0, 4000, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("w"))
    right = right.union(spark.createDataFrame([("hot", -1), (None, -2)], "k string, w long"))
    hot = skew.hot_keys(left, ["k"], min_rows=100)
    assert rows(hot) == [("hot", 31), (None, 31)]
    salted = skew.skew_join(left, right, ["k"], how, min_rows=100)
    plain = left.join(right, ["k"], how)
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).count() == 0


def test_many_hot_keys_are_joined_as_a_spread_table(spark, monkeypatch):
    monkeypatch.setattr(skew, "MOST_LISTED", 1)
    monkeypatch.setattr(skew, "SPREAD", 5)
    left = spark.range(6000).select((F.col("id") % 6).alias("k"), "id").withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    right = spark.range(0, 6, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    hot = skew.hot_keys(left, ["k"], min_rows=500)
    assert hot.count() == 6 * 5 and "__place" in hot.columns
    marked = skew.mark_hot(left, hot, ["k"])
    assert marked.columns == ["k", "id", "__salts"] and rows(marked.groupBy("__salts").count()) == [(3, 6000)]
    assert rows(skew.skew_join(left, right, ["k"], min_rows=500)) == rows(left.join(right, ["k"], "left"))


def test_null_safe_dimension(spark):
    spine = spark.createDataFrame([("a",), (None,)], "k string")
    one = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    dim = lambda df: [join.Dim("d", df, ["k"], null_safe=True)]
    assert rows(join.wide_join(spine, dim(one))) == [("a", 1), (None, 2)]
    with pytest.raises(join.FanOutError):
        join.wide_join(spine, dim(one.union(one.where("k is null"))))


def test_to_number(spark):
    texts = ["12", " -3 ", "+4", "1.5", "1e3", "x", "", "99999999999", None, "NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(fn.to_number(df, "t").alias("i"), fn.to_number(df, "t", "double").alias("d")).collect()
    assert [r.i for r in got] == [12, -3, 4, None, None, None, None, None, None, None]
    assert [r.d for r in got] == [12.0, -3.0, 4.0, 1.5, 1000.0, None, None, 99999999999.0, None, None]
    numbers = spark.createDataFrame([(600.7,)], "t double")
    assert numbers.select(fn.to_number(numbers, "t").alias("i")).first().i == 600


def test_compact_date_and_parity(spark):
    df = spark.createDataFrame([("20240229",), ("20230229",), ("20231301",), ("2024022",), ("abcdefgh",), (None,)], "t string")
    assert [r.d for r in df.select(fn.compact_date("t", 1).alias("d")).collect()] == [dt.date(2024, 2, 29)] + [None] * 5
    odd = spark.createDataFrame([("7",), ("0",), ("x",), ("",), (None,)], "t string")
    assert [r.p for r in odd.select(fn.digit_parity("t", 1).alias("p")).collect()] == [1, 0, None, None, None]
