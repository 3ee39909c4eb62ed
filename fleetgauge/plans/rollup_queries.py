"""Scans and daily roll-ups."""

from __future__ import annotations

import os
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn
from ..functions.codes import WARNING_CLASSES
from ..operators import clean, rollup
from ..sources import extract, preview, scan_days, scan_union, union_all
from ..session import work_folder
from .registry import query, table

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def events_with_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their day and the number in ``props``, which plays the status codes."""
    return table(spark, sf_dir, "events").withColumns(
        {
            "day": F.to_date("ts"),
            "k": F.get_json_object("props", "$.k").try_cast("int"),
        }
    )


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
VALID = f"(({K} % 3 = 0 AND {K} % 2 = 0) OR {K} % 3 = 1)"


@query(
    f"""
    SELECT CAST(ts AS DATE) AS day, user_id,
           {", ".join(f"CAST(count(*) FILTER (event_type = '{t}') AS BIGINT) AS n_{t}" for t in EVENT_TYPES)}
    FROM events WHERE {VALID} GROUP BY 1, 2
    """
)
def daily_conditional_counts(spark, sf_dir):
    valid = events_with_code(spark, sf_dir).where(fn.valid_alarm(F.col("k") % 3, F.col("k") % 2))
    return rollup.code_counts(
        valid, ["day", "user_id"], {"event_type": {t: f"n_{t}" for t in EVENT_TYPES}}
    )


KIND = "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END"


@query(
    f"""
    WITH c AS (SELECT CAST(ts AS DATE) AS day, user_id, {KIND} AS kind, {K} % 5 AS status FROM events)
    SELECT day, user_id,
      CAST(count(*) FILTER (kind = 1) AS BIGINT) AS fcw,
      CAST(count(*) FILTER (kind = 2) AS BIGINT) AS hmw,
      CAST(count(*) FILTER (kind = 3) AS BIGINT) AS ldw,
      CAST(count(*) FILTER (kind = 4 AND status = 0) AS BIGINT) AS no_brake,
      CAST(count(*) FILTER (kind = 4 AND status = 1) AS BIGINT) AS stereo_brake,
      CAST(count(*) FILTER (kind = 4 AND status = 2) AS BIGINT) AS radar_brake,
      CAST(count(*) FILTER (kind = 4 AND status = 3) AS BIGINT) AS ultrasonic_brake,
      CAST(count(*) FILTER (kind = 4 AND status = 4) AS BIGINT) AS inactive_warning
    FROM c WHERE kind BETWEEN 1 AND 4 GROUP BY 1, 2
    """
)
def warning_class_counts(spark, sf_dir):
    kinds = {"click": 1.0, "view": 2.0, "signup": 3.0, "purchase": 4.0}
    raw = events_with_code(spark, sf_dir).withColumn(
        "kind", fn.pick_class([(F.col("event_type") == t, v) for t, v in kinds.items()], 5.0)
    )
    kind = fn.as_text(raw, "kind")
    status = (F.col("k") % 5).cast("string")
    classed = raw.where(kind.isin("1", "2", "3", "4")).withColumn(
        "class", fn.warning_class(kind, status)
    )
    return rollup.code_counts(
        classed, ["day", "user_id"], {"class": {c: c for c in WARNING_CLASSES}}
    )


@query(
    f"""
    SELECT CAST(ts AS DATE) AS day, user_id, CAST(count(*) AS BIGINT) AS over_speed_cnt
    FROM events WHERE {VALID} AND value > 20 AND value < 250 GROUP BY 1, 2
    """
)
def range_filtered_counts(spark, sf_dir):
    fast = events_with_code(spark, sf_dir).where(
        fn.valid_alarm(F.col("k") % 3, F.col("k") % 2) & fn.open_range("value", 20, 250)
    )
    return rollup.daily_agg(
        fast, ["day", "user_id"], aggs={"over_speed_cnt": F.count(F.lit(1))}
    )


@query(
    """
    SELECT CAST(ts AS DATE) AS day_utc, CAST(ts + INTERVAL 8 HOURS AS DATE) AS day_local,
           CAST(count(*) AS BIGINT) AS n
    FROM events GROUP BY 1, 2
    """
)
def epoch_day_rollup(spark, sf_dir):
    seconds = (
        F.unix_date(F.to_date("ts")).cast("bigint") * 86400
        + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    )
    days = table(spark, sf_dir, "events").select(
        fn.epoch_to_day(seconds).alias("day_utc"),
        fn.epoch_to_day(seconds, "Asia/Shanghai").alias("day_local"),
    )
    return rollup.daily_agg(days, ["day_utc", "day_local"], aggs={"n": F.count(F.lit(1))})


@query(
    """
    SELECT l_suppkey AS supplier, CAST(l_shipdate AS DATE) AS day,
      round(sum(l_quantity), 4) AS free_mileage,
      round(sum(l_extendedprice), 2) AS mileage,
      CAST(coalesce(sum(TRY_CAST(CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS INTEGER)), 0) AS BIGINT) AS passenger_time,
      round(sum(l_tax), 4) AS wait_time,
      round(sum(l_discount), 4) AS money,
      CAST(sum(CASE WHEN l_returnflag IN ('R', 'A') THEN 1 ELSE 0 END) AS BIGINT) AS negative_review,
      CAST(sum(CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) AS BIGINT) AS carry_passenger
    FROM lineitem GROUP BY 1, 2
    """
)
def daily_run_sums(spark, sf_dir):
    text = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(
        F.col("l_quantity").cast("int").cast("string")
    )
    trips = table(spark, sf_dir, "lineitem").withColumns(
        {"supplier": F.col("l_suppkey"), "day": F.to_date("l_shipdate"), "seconds": text}
    )
    daily = rollup.daily_agg(
        trips,
        ["supplier", "day"],
        sums={
            "free_mileage": "l_quantity",
            "mileage": "l_extendedprice",
            "passenger_time": fn.to_number(trips, "seconds"),
            "wait_time": "l_tax",
            "money": "l_discount",
            "negative_review": fn.flag(F.col("l_returnflag").isin("R", "A")),
            "carry_passenger": fn.flag(fn.to_number(trips, "l_tax", "double") > 0),
        },
    )
    digits = {"free_mileage": 4, "mileage": 2, "wait_time": 4, "money": 4}
    return daily.withColumns({c: fn.round_to(c, d) for c, d in digits.items()})


@query(
    """
    SELECT l_suppkey AS device, CAST(l_shipdate AS DATE) AS day,
           max(l_extendedprice) AS daily_max, CAST(count(*) AS BIGINT) AS daily_records
    FROM lineitem GROUP BY 1, 2
    """
)
def daily_max_and_count(spark, sf_dir):
    positions = table(spark, sf_dir, "lineitem").withColumns(
        {"device": F.col("l_suppkey"), "day": F.to_date("l_shipdate")}
    )
    return rollup.daily_agg(
        positions,
        ["device", "day"],
        aggs={"daily_max": F.max("l_extendedprice"), "daily_records": F.count(F.lit(1))},
    )


@query(
    """
    SELECT CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS driver,
      round(sum(value), 4) AS speed_sum, CAST(count(*) AS BIGINT) AS speed_count,
      max(value) AS speed_max, round(avg(value), 6) AS speed_avg,
      round(stddev_pop(value), 6) AS speed_std
    FROM events WHERE value > 5 AND user_id % 50 <> 0 GROUP BY 1, 2
    """
)
def daily_speed_stats(spark, sf_dir):
    # an absent driver is written as null or as empty text
    user = F.col("user_id")
    driver = F.when(user % 100 == 0, F.lit(None)).when(user % 50 == 0, "").otherwise(user.cast("string"))
    moving = (
        table(spark, sf_dir, "events")
        .withColumns({"day": F.to_date("ts"), "driver": driver})
        .where((F.col("value") > 5) & fn.has_text("driver"))
    )
    stats = rollup.speed_stats(moving, ["day", "driver"], "value")
    return stats.withColumns(
        {
            "speed_sum": fn.round_to("speed_sum", 4),
            "speed_avg": fn.round_to("speed_avg", 6),
            "speed_std": fn.round_to("speed_std", 6),
        }
    )


@query(
    """
    SELECT CAST(ts AS DATE) AS day, user_id, CAST(count(*) AS BIGINT) AS n,
           round(sum(value), 4) AS total
    FROM events GROUP BY 1, 2
    """
)
def dated_scan_union(spark, sf_dir):
    # Two collections cut at a noon share one day, and one listed name does not
    # exist. Partial roll-ups are united and summed once more.
    events = scan_union(spark, [f"{sf_dir}/events.parquet", f"{sf_dir}/events_20240131.parquet"])
    cut = F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")
    parts = [
        rollup.daily_agg(
            piece.withColumn("day", F.to_date("ts")),
            ["day", "user_id"],
            sums={"total": "value"},
            aggs={"n": F.count(F.lit(1))},
        )
        for piece in (events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut))
    ]
    summed = rollup.sum_numeric(union_all(parts), ["day", "user_id"])
    return summed.withColumn("total", fn.round_to("total", 4))


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_totalprice > 300000 AND o_orderstatus = 'F'
    """
)
def extract_fields_where(spark, sf_dir):
    return extract(
        table(spark, sf_dir, "orders"),
        ["o_orderkey", "o_custkey", "o_totalprice"],
        "o_totalprice > 300000 AND o_orderstatus = 'F'",
    )


@query(
    """
    SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS BIGINT) AS n,
           CAST(count(*) FILTER (CAST(o_orderdate AS DATE) = DATE '1998-06-30') AS BIGINT) AS n_yesterday
    FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-16' AND DATE '1998-06-30' GROUP BY 1
    """
)
def date_range_scan(spark, sf_dir):
    run_date = date(1998, 7, 1)
    recent = scan_days(table(spark, sf_dir, "orders"), "o_orderdate", run_date)
    day = F.to_date("o_orderdate")
    return rollup.conditional_counts(
        recent.withColumn("day", day),
        ["day"],
        {"n": F.lit(True), "n_yesterday": F.col("day") == F.date_sub(F.lit(run_date), 1)},
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5
    """
)
def sorted_preview(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders, ["o_totalprice", "o_orderkey"])


@query(
    """
    SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1
    """
)
def day_text_counts(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"))
    counts = days.agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    """
    SELECT 'seconds' AS field, 'int' AS type, CAST(count(*) FILTER (l_linenumber = 7) AS BIGINT) AS bad FROM lineitem
    UNION ALL SELECT 'l_returnflag', 'double', CAST(count(*) AS BIGINT) FROM lineitem
    """
)
def coercion_report(spark, sf_dir):
    text = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(
        F.col("l_quantity").cast("int").cast("string")
    )
    trips = table(spark, sf_dir, "lineitem").withColumn("seconds", text)
    return clean.coercion_report(trips, {"seconds": "int", "l_returnflag": "double"})


@query("SELECT count(*)::BIGINT AS n, count(DISTINCT user_id)::BIGINT AS users FROM events")
def row_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users")
    )


@query(
    """
    SELECT o_orderkey, CAST(o_orderkey % 5 AS VARCHAR) AS code, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price
    FROM orders
    """
)
def scan_union_mixed(spark, sf_dir):
    """Two stored collections: one has no status, and codes are numbers in one and text in the other; NaN is read as null."""
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).otherwise(float("nan")).alias("price")
    code = F.col("o_orderkey") % 5
    folder = os.path.join(work_folder(spark), f"collections-{uuid.uuid4().hex}")
    even, odd = orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 <> 0")
    even.select("o_orderkey", code.cast("int").alias("code"), "o_orderstatus", price).write.parquet(f"{folder}/even")
    odd.select("o_orderkey", code.cast("string").alias("code"), price).write.parquet(f"{folder}/odd")
    names = [f"{folder}/{n}" for n in ("even", "absent", "odd")]
    return scan_union(spark, names, text=["code"]).select("o_orderkey", "code", "o_orderstatus", "price")
