"""Results that are checked before they are shown, and collections that differ in types."""

from __future__ import annotations

import os
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import join
from ..session import hand_off, scratch_folder
from ..sources import dated_names, read_csv, read_days, read_holidays, scan_union, schema_report, write_csv, write_parquet
from ..sources.published import Gate, RefusedError, Versions, publish, read_published
from ..sources.schemas import reconcile
from .panel_queries import GAPPY, gappy_days
from .registry import query, table
from .rollup_queries import K, events_with_code

PUBLISHED = ["user_id", "day", "n", "total", "x"]


@query(
    f"""
    WITH {GAPPY}
    SELECT c.field, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count(CASE c.field WHEN 'x' THEN x ELSE n END) AS BIGINT) AS nulls,
           CAST(1 AS BIGINT) AS version, CAST(count(*) AS BIGINT) AS stored
    FROM gappy, (VALUES {", ".join(f"('{c}')" for c in PUBLISHED)}) AS c(field) GROUP BY c.field
    """
)
def published_counts(spark, sf_dir):
    """What was counted while the panel was written; a second version, in which a column is empty, is refused and changes nothing."""
    days = gappy_days(spark, sf_dir).select(*PUBLISHED)
    folder = scratch_folder(spark, "published")
    gate = Gate(least_rows=1, most_nulls={"x": 0.9})
    publish(days, folder, gate)
    try:
        publish(days.withColumn("x", F.lit(None).cast("double")), folder, gate)
    except RefusedError:
        stored = read_published(spark, folder).count()
    shown = Versions(folder).shown(spark)
    return shown.select(F.explode("nulls").alias("field", "nulls"), "rows", "version", F.lit(stored).alias("stored"))


def _feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three collections of one kind of rows: numbers as text, whole numbers as doubles, days as text, some of them wrong."""
    e = events_with_code(spark, sf_dir)
    part = lambda n, *cols: e.where(F.col("event_id") % 3 == n).selectExpr(*cols)
    return {
        "a": part(0, "cast(event_id AS int) AS event_id", "k AS code", "IF(event_id % 33 = 0, 'none', cast(value AS string)) AS amount", "cast(ts AS date) AS day"),
        "b": part(1, "IF(event_id % 50 = 1, concat('E', event_id), cast(event_id AS string)) AS event_id", "cast(k AS double) AS code", "value AS amount",
                  "IF(event_id % 77 = 1, 'n/a', date_format(ts, 'yyyy-MM-dd')) AS day"),
        "c": part(2, "event_id", "concat(k, IF(k % 7 = 0, '.5', '.0')) AS code", "cast(value AS float) AS amount", "cast(ts AS date) AS day", "'late' AS remark"),
    }


WANTED = {"event_id": "bigint", "code": "int", "amount": "double", "day": "date"}


@query(
    f"""
    SELECT event_id, CAST({K} AS INTEGER) AS code, round(CASE WHEN event_id % 3 = 2 THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END, 4) AS amount,
           CAST(ts AS DATE) AS day, CASE WHEN event_id % 3 = 2 THEN 'late' END AS remark FROM events
    WHERE CASE event_id % 3 WHEN 0 THEN event_id % 33 <> 0 WHEN 1 THEN event_id % 50 <> 1 AND event_id % 77 <> 1 ELSE CAST({K} AS INTEGER) % 7 <> 0 END
    """
)
def reconciled_rows(spark, sf_dir):
    """All rows that fit one schema, from collections that each have their own."""
    rows, _ = reconcile(_feeds(spark, sf_dir), WANTED)
    return rows.withColumn("amount", F.floor(F.col("amount") * 10000 + 0.5) / 10000)


@query(
    f"""
    WITH r AS (
      SELECT 'a' AS source, 'amount: none is no double' AS reasons, event_id FROM events WHERE event_id % 3 = 0 AND event_id % 33 = 0
      UNION ALL
      SELECT 'b', concat_ws('; ', CASE WHEN event_id % 50 = 1 THEN 'event_id: E' || event_id || ' is no bigint' END, CASE WHEN event_id % 77 = 1 THEN 'day: n/a is no date' END), event_id
      FROM events WHERE event_id % 3 = 1 AND (event_id % 50 = 1 OR event_id % 77 = 1)
      UNION ALL
      SELECT 'c', 'code: ' || CAST({K} AS INTEGER) || '.5 is no int', event_id FROM events WHERE event_id % 3 = 2 AND CAST({K} AS INTEGER) % 7 = 0)
    SELECT source, reasons, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY source, reasons
    """
)
def rejected_rows(spark, sf_dir):
    """Rows that were set aside, by source and reason."""
    _, rejected = reconcile(_feeds(spark, sf_dir), WANTED)
    return rejected.groupBy("source", F.array_join("reasons", "; ").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, sf_dir):
    """Written with a header and read with a schema; identifiers stay text with their leading zeros."""
    people = table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("id"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    path = scratch_folder(spark, "csv")
    write_csv(people, path)
    kinds = people.schema["c_nationkey"].dataType.simpleString()
    return read_csv(spark, path, f"id bigint, c_name string, c_nationkey {kinds}, c_acctbal double, c_mktsegment string", text=["id"])


@query(
    """
    SELECT CAST(row_number() OVER (ORDER BY day) - 1 AS INTEGER) AS position, day AS date, CASE WHEN isodow(day) < 6 THEN 'public_holiday' ELSE 'transfer_workday' END AS type
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) % 4 = 1)
    """
)
def holiday_list(spark, sf_dir):
    """A list of days as one JSON document, read back with the position of each entry."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).where("day(day) % 4 = 1").distinct()
    kind = F.when(F.weekday("day") < 5, "public_holiday").otherwise("transfer_workday")
    listed = days.agg(F.array_sort(F.collect_list(F.struct(F.col("day").cast("string").alias("date"), kind.alias("type")))).alias("holidays"))
    path = scratch_folder(spark, "holidays")
    listed.write.json(path)
    return read_holidays(spark, path)


@query(
    """
    SELECT column_name AS field, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS type, true AS nullable
    FROM (DESCRIBE orders) WHERE column_name IN ('o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice')
    """
)
def schema_fields(spark, sf_dir):
    """Names and types of chosen fields, as the store has them."""
    return schema_report(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])


RUN_DATE = date(2024, 1, 25)


@query(
    f"""
    SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '{RUN_DATE - timedelta(days=8)}' AND DATE '{RUN_DATE - timedelta(days=1)}' AND CAST(ts AS DATE) <> DATE '2024-01-20' GROUP BY ALL
    """
)
def dated_folders(spark, sf_dir):
    """The last eight daily collections by their dated names, one of which does not exist."""
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    root = scratch_folder(spark, "dated")
    names = dated_names(os.path.join(root, "Events"), RUN_DATE, 8)
    for name in names:
        day = date.fromisoformat(f"{name[-8:-4]}-{name[-4:-2]}-{name[-2:]}")
        if day != date(2024, 1, 20):
            write_parquet(events.where(F.col("day") == F.lit(day)), name)
    return scan_union(spark, names).groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query(
    f"""
    SELECT CAST(ts AS DATE) AS day, event_type, CAST(count(*) AS BIGINT) AS n FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '{RUN_DATE - timedelta(days=8)}' AND DATE '{RUN_DATE - timedelta(days=1)}' AND NOT (day(ts) = 22 AND event_type = 'click') GROUP BY ALL
    """
)
def daily_partitions(spark, sf_dir):
    """Events stored by day, one day replaced, the last eight days read."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    path = scratch_folder(spark, "by-day")
    write_parquet(events, path, partition_by=["day"])
    write_parquet(events.where("day(day) = 22 AND event_type <> 'click'"), path, partition_by=["day"], mode="replace_partitions")
    return read_days(spark.read.parquet(path), "day", RUN_DATE, 8).groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    WITH e AS (SELECT event_type, value FROM events), t AS (SELECT * FROM (VALUES ('csv', 'click'), ('csv', 'none'), ('parquet', 'error'), ('parquet', 'none')) AS t(sink, kind))
    SELECT sink, kind, count(value) > 0 AS written, CAST(count(value) AS BIGINT) AS n FROM t LEFT JOIN e ON event_type = kind GROUP BY sink, kind
    """
)
def sinks_skip_empty(spark, sf_dir):
    """Sinks say whether they wrote; an empty frame writes nothing."""
    events = table(spark, sf_dir, "events").select("event_type", "value")
    lines = []
    for sink, write in (("csv", write_csv), ("parquet", write_parquet)):
        for kind in ("click" if sink == "csv" else "error", "none"):
            path = scratch_folder(spark, "sink")
            written = write(events.where(F.col("event_type") == kind), path)
            stored = 0
            if written:
                stored = (read_csv(spark, path, "event_type string, value double") if sink == "csv" else spark.read.parquet(path)).count()
            lines.append((sink, kind, written, stored))
    return spark.createDataFrame(lines, "sink string, kind string, written boolean, n bigint")


@query(
    """
    SELECT name, n > 0 AS refused, rows FROM (
      SELECT 'orders' AS name, (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1) JOIN customer ON c_custkey = o_custkey) AS n,
             CAST((SELECT sum(coalesce(k, 1)) FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) ON o_custkey = c_custkey) AS BIGINT) AS rows
      UNION ALL SELECT 'nation', 0, CAST(count(*) AS BIGINT) FROM customer)
    """
)
def refused_fan_out(spark, sf_dir):
    """A table with many rows per key is refused at the gate; a unique one keeps the rows of the spine."""
    spine = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dims_of = {
        "orders": join.Dim("orders", table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), {"c_custkey": "o_custkey"}),
        "nation": join.Dim("nation", table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), {"c_nationkey": "n_nationkey"}),
    }
    lines = []
    for name, dim in dims_of.items():
        refused = False
        try:
            join.wide_join(spine, [dim])
        except join.FanOutError:
            refused = True
        joined = hand_off(join.wide_join(spine, [dim], gate=False), "ungated")
        lines.append(joined.agg(F.lit(name).alias("name"), F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("rows")))
    return lines[0].unionByName(lines[1])
