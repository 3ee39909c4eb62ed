import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetgauge import sources as io


def test_scan_union_skips_absent_names(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, "x")], "t int, s string").write.parquet(a)
    spark.createDataFrame([(2,)], "t int").write.parquet(b)
    got = io.scan_union(spark, [a, str(tmp_path / "none"), b, "no_such_table"])
    assert rows(got) == [(1, "x"), (2, None)]
    empty = io.scan_union(spark, [str(tmp_path / "none")], schema=got.schema)
    assert empty.isEmpty() and empty.schema == got.schema
    with pytest.raises(FileNotFoundError):
        io.scan_union(spark, [a, str(tmp_path / "none")], on_missing="error")
    with pytest.raises(ValueError):
        io.scan_union(spark, [str(tmp_path / "none")])


def test_scan_union_mixed_types_and_pushdown(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, 5)], "c int, v int").write.parquet(a)
    spark.createDataFrame([("2", 6)], "c string, v int").write.parquet(b)
    got = io.scan_union(spark, [a, b], text=["c"])
    assert rows(got) == [("1", 5), ("2", 6)]
    plan = got.where("v > 5").select("v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(v,5)") == 2 and plan.count("ReadSchema: struct<v:int>") == 2


def test_dated_names():
    assert io.dated_names("Location", dt.date(2025, 8, 3), 3) == ["Location20250802", "Location20250801", "Location20250731"]


def test_daily_partitions_are_pruned(spark, tmp_path):
    days = spark.range(20).select(F.date_add(F.lit(dt.date(2025, 8, 1)), F.col("id").cast("int")).alias("day"), "id")
    path = str(tmp_path / "daily")
    assert io.write_parquet(days, path, partition_by=["day"])
    got = io.read_days(spark.read.parquet(path), "day", dt.date(2025, 8, 11), 8)
    assert got.count() == 8 and "PartitionFilters: [day" in got._jdf.queryExecution().executedPlan().toString()


def test_extract_and_schema(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    assert rows(io.extract(df, ["b"], "a > 1")) == [("y",)]
    assert rows(io.extract(df, [], F.col("a") == 1)) == [(1, "x")]
    assert rows(io.schema_report(df, ["b"])) == [("b", "string", True)]


def test_scan_days_is_half_open(spark, table):
    orders = table("orders")
    got = io.scan_days(orders, "o_orderdate", dt.date(1998, 1, 16))
    days = {r.d for r in got.select(F.to_date("o_orderdate").alias("d")).distinct().collect()}
    assert days == {dt.date(1998, 1, n) for n in range(1, 16)}
    assert "GreaterThanOrEqual(o_orderdate" in got._jdf.queryExecution().executedPlan().toString()


def test_csv_keeps_identifiers_as_text(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([("007", 1)], "id string, n int")
    assert io.write_csv(df, path)
    assert rows(io.read_csv(spark, path, "id int, n int", text=["id"])) == [("007", 1)]
    assert not io.write_csv(df.where("n > 1"), str(tmp_path / "none"))
    assert not io.write_parquet(df.where("n > 1"), str(tmp_path / "none"))


def test_holidays(spark, tmp_path):
    path = tmp_path / "h.json"
    path.write_text(json.dumps({"holidays": [{"date": "2024-01-01", "type": "public_holiday"}, {"date": "2024-02-04", "type": "x"}]}, indent=1))
    assert rows(io.read_holidays(spark, str(path))) == [(0, dt.date(2024, 1, 1), "public_holiday"), (1, dt.date(2024, 2, 4), "x")]


def test_jdbc_round_trip(spark):
    # an in-memory database of this process; no server, no port
    url = "jdbc:derby:memory:fleet;create=true"
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(100).select(F.col("id").alias("ID"), (F.col("id") * 2.5).alias("X"))
    assert io.jdbc_write(df, url, "T", options=opts)
    assert not io.jdbc_write(df.where("ID < 0"), url, "T", options=opts)
    back = io.jdbc_read(spark, url, "T", partition=("ID", 0, 50, 4), options=opts)
    assert back.count() == 100 and back.rdd.getNumPartitions() == 4
    assert "PushedFilters: [*IsNotNull(ID), *GreaterThan(ID,90)]" in back.where("ID > 90")._jdf.queryExecution().executedPlan().toString()
    assert io.jdbc_write(df.limit(10), url, "T", mode="truncate", options=opts)
    assert io.jdbc_write(df.limit(5), url, "T", mode="append", options=opts)
    assert io.jdbc_read(spark, url, "T", options=opts).count() == 15
    preview = io.jdbc_copy(
        spark, url, url, "T", fields=["ID"], where="ID >= 5", target_table="T2",
        column_types="ID INTEGER", source_options=opts, target_options=opts,
    )
    assert preview.count() == 5 and preview.columns == ["ID"] and preview.schema["ID"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        io.jdbc_write(df, url, "T", mode="merge", options=opts)
