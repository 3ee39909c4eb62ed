import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetgauge.operators import join
from fleetgauge.operators.layout import Layout, read_bucketed, store_bucketed
from fleetgauge.session import drop_hand_offs

LAYOUT = Layout(("driver", "day"), 4)


def daily(spark, n, *cols):
    day = F.date_add(F.lit(dt.date(2025, 8, 1)), (F.col("id") % 5).cast("int"))
    return spark.range(n).select(F.concat(F.lit("d"), F.col("id") % 17).alias("driver"), day.alias("day"), (F.col("id") % 3).alias("plate"), *cols)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def dims_of(spark):
    alarms = daily(spark, 200, F.col("id").alias("a")).groupBy("driver", "day", "plate").agg(F.sum("a").alias("a"))
    logins = daily(spark, 100, F.col("id").alias("b")).groupBy("day", "driver").agg(F.max("b").alias("b"))
    cars = spark.range(3).select(F.col("id").alias("plate"), (F.col("id") * 10).alias("device"))
    warned = daily(spark, 150).select("driver", "day", (F.col("plate") * 10).alias("device")).distinct().withColumn("w", F.lit(1))
    return [
        join.Dim("alarms", alarms, ["day", "driver", "plate"], unique=True),
        join.Dim("logins", logins, {"driver": "driver", "day": "day"}),
        join.Dim("cars", cars, ["plate"], unique=True),
        join.Dim("warned", warned, ["day", "device", "driver"], unique=True),
    ]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_in_buckets_shuffle_nothing(spark, no_broadcast):
    spine = daily(spark, 300, F.col("id").alias("x"))
    plain = join.wide_join(spine, dims_of(spark))
    got = join.wide_join(spine, dims_of(spark), layout=LAYOUT)
    cols = ["driver", "day", "plate", "x", "a", "b", "device", "w"]
    assert rows(got, *cols) == rows(plain, *cols)
    assert plan_of(plain).count("Exchange") >= 6
    plan = plan_of(got)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
    assert plan.count("SelectedBucketsCount: 4 out of 4") == 4


def test_one_file_a_bucket(spark):
    stored = store_bucketed(daily(spark, 500), LAYOUT, "files")
    assert len(stored.inputFiles()) <= 4
    assert rows(stored) == rows(daily(spark, 500))
    drop_hand_offs(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("fleetgauge_files")]


def test_named_tables_are_read_again(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "kept")
    store_bucketed(daily(spark, 90), LAYOUT, "kept", name="kept_daily", path=path)
    again = store_bucketed(daily(spark, 60), LAYOUT, "kept", name="kept_daily", path=path)
    assert again.count() == 60
    spark.sql("DROP TABLE kept_daily")  # a new session does not know the table
    found = read_bucketed(spark, LAYOUT, "kept_daily", path)
    assert rows(found) == rows(daily(spark, 60))
    other = store_bucketed(daily(spark, 30).withColumnRenamed("plate", "p"), LAYOUT, "other")
    assert "Exchange" not in plan_of(found.join(other, ["driver", "day"]))
    spark.sql("DROP TABLE kept_daily")
    with pytest.raises(ValueError):
        store_bucketed(daily(spark, 9), LAYOUT, "kept", name="kept_daily")


def test_gate_types_and_order_are_checked(spark):
    spine = daily(spark, 30)
    twice = daily(spark, 60).select("driver", "day", F.lit(1).alias("z"))
    with pytest.raises(join.FanOutError):
        join.wide_join(spine, [join.Dim("twice", twice.unionByName(twice), ["driver", "day"])], layout=LAYOUT)
    stamped = twice.distinct().withColumn("day", F.col("day").cast("timestamp"))
    with pytest.raises(TypeError):
        join.wide_join(spine, [join.Dim("stamped", stamped, ["driver", "day"], unique=True)], layout=LAYOUT)
    brings = daily(spark, 30).select("driver", "day", F.lit(1).alias("k")).distinct()
    needs = spark.range(3).select(F.col("id").cast("int").alias("k"), "id")
    with pytest.raises(ValueError):
        join.wide_join(spine, [join.Dim("b", brings, ["driver", "day"], unique=True), join.Dim("n", needs, ["k"], unique=True)], layout=LAYOUT)
    with pytest.raises(ValueError):
        Layout((), 4)


def test_empty_tables_and_null_keys(spark):
    spine = daily(spark, 20).unionByName(spark.createDataFrame([(None, None, 1)], "driver string, day date, plate long"))
    none = daily(spark, 0, F.col("id").alias("a"))
    got = join.wide_join(spine, [join.Dim("none", none.drop("plate"), ["driver", "day"], unique=True)], layout=LAYOUT)
    assert got.count() == 21 and got.where("a IS NOT NULL").count() == 0
    assert join.wide_join(spine.limit(0), dims_of(spark), layout=LAYOUT).count() == 0
