"""Time windows, fills, outliers and scaling on the daily panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn
from ..operators import clean, fill, panel, sampling
from .dim_queries import STREAKS, USER_DAYS, user_days
from .registry import query, table
from .rollup_queries import K, events_with_code

FRAME = "OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)"
GAPPY = f"""{USER_DAYS}, gappy AS (
    SELECT user_id, day, n, total, CASE WHEN n % 3 <> 0 THEN total END AS x FROM user_days)"""


def gappy_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with a column that has empty cells."""
    return user_days(spark, sf_dir).withColumn("x", F.when(F.col("n") % 3 != 0, F.col("total")))


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: fn.round_to(c, digits) for c in cols})


@query(
    f"""
    WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
    span AS (SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
             FROM days GROUP BY user_id)
    SELECT s.user_id, s.day, CASE WHEN d.day IS NOT NULL THEN 1 ELSE 0 END AS present
    FROM span s LEFT JOIN days d ON d.user_id = s.user_id AND d.day = s.day
    """
)
def densify_days(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", "day")
    return panel.densify_days(events, ["user_id"], "day")


@query(
    """
    WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
    span AS (SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
             FROM days GROUP BY user_id),
    dense AS (SELECT s.user_id, s.day, CASE WHEN d.day IS NOT NULL THEN 1 ELSE 0 END AS present
              FROM span s LEFT JOIN days d ON d.user_id = s.user_id AND d.day = s.day),
    marked AS (SELECT *, CASE WHEN present IS DISTINCT FROM lag(present) OVER (PARTITION BY user_id ORDER BY day) THEN 1 ELSE 0 END AS fresh FROM dense),
    numbered AS (SELECT user_id, day, present, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY day) AS BIGINT) AS run FROM marked)
    SELECT *, CAST(sum(present) OVER (PARTITION BY user_id, run ORDER BY day) AS BIGINT) AS run_total FROM numbered
    """
)
def presence_runs(spark, sf_dir):
    return panel.runs(densify_days(spark, sf_dir), ["user_id"], "day", "present")


@query(
    f"""
    WITH {GAPPY}
    SELECT user_id, day,
      round(avg(x) {FRAME}, 6) AS x_8d_mean, round(sum(x) {FRAME}, 6) AS x_8d_sum,
      CAST(count(x) {FRAME} AS BIGINT) AS x_8d_count, max(x) {FRAME} AS x_8d_max,
      min(x) {FRAME} AS x_8d_min, round(stddev_samp(x) {FRAME}, 6) AS x_8d_std
    FROM gappy
    """
)
def rolling_include(spark, sf_dir):
    out = panel.rolling(
        gappy_days(spark, sf_dir), ["user_id"], "day", ["x"], panel.ROLLING_FUNCS,
        days=8, exclude_current=False,
    )
    return rounded(out.drop("n", "total", "x"), 6, "x_8d_mean", "x_8d_sum", "x_8d_std")


def _without(expr: str) -> str:
    return f"CASE WHEN count(x) {FRAME} > 1 THEN {expr} END"


@query(
    f"""
    WITH {GAPPY}
    SELECT user_id, day,
      round({_without(f"(sum(x) {FRAME} - x) / (count(x) {FRAME} - 1)")}, 6) AS x_8d_mean,
      round({_without(f"sum(x) {FRAME} - x")}, 6) AS x_8d_sum,
      CAST({_without(f"count(x) {FRAME} - 1")} AS BIGINT) AS x_8d_count,
      max(x) {FRAME} AS x_8d_max, min(x) {FRAME} AS x_8d_min,
      round(stddev_samp(x) {FRAME}, 6) AS x_8d_std,
      CAST(CASE WHEN count(n) {FRAME} > 1 THEN sum(n) {FRAME} - n END AS BIGINT) AS n_8d_sum
    FROM gappy
    """
)
def rolling_exclude_current(spark, sf_dir):
    out = panel.rolling(
        gappy_days(spark, sf_dir), ["user_id"], "day",
        {"x": panel.ROLLING_FUNCS, "n": ["sum"]}, days=8,
    )
    return rounded(out.drop("n", "total", "x"), 6, "x_8d_mean", "x_8d_sum", "x_8d_std")


@query(
    """
    WITH v AS (SELECT event_id, user_id, ts, CASE WHEN value > 60 THEN value END AS x FROM events)
    SELECT event_id, coalesce(
      last_value(x IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(x IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
      -1) AS value
    FROM v
    """
)
def fill_forward_backward(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    out = fill.fill_forward_backward(
        events, ["user_id"], ["ts", "event_id"], "value", valid=F.col("value") > 60
    )
    return out.select("event_id", "value")


@query(
    """
    WITH v AS (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS k,
                      CASE WHEN value > 60 THEN value END AS x FROM events)
    SELECT event_id, coalesce(
      last_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
      -1) AS value
    FROM v
    """
)
def skewed_fill(spark, sf_dir):
    # a third of all rows share one key; a low limit sends it the chunked way
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")).alias("k"),
        "value",
    )
    out = fill.fill_forward_backward(
        events, ["k"], ["ts", "event_id"], "value", valid=F.col("value") > 60, min_rows=200, chunks=12
    )
    return out.select("event_id", "value")


@query(
    f"""
    WITH {USER_DAYS}, g AS (SELECT user_id, day, CASE WHEN n >= 4 THEN n END AS f FROM user_days)
    SELECT user_id, day, last_value(f IGNORE NULLS) OVER (ORDER BY user_id, day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f
    FROM g
    """
)
def global_forward_fill(spark, sf_dir):
    days = user_days(spark, sf_dir).select(
        "user_id", "day", F.when(F.col("n") >= 4, F.col("n")).alias("f")
    )
    return fill.forward_fill(days, ["user_id"], ["day"], ["f"], across_groups=True, chunks=12)


@query(
    f"""
    WITH {USER_DAYS}, g AS (SELECT user_id, day, CASE WHEN n >= 4 THEN n END AS f FROM user_days)
    SELECT user_id, day, last_value(f IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f
    FROM g
    """
)
def grouped_forward_fill(spark, sf_dir):
    days = user_days(spark, sf_dir).select(
        "user_id", "day", F.when(F.col("n") >= 4, F.col("n")).alias("f")
    )
    return fill.forward_fill(days, ["user_id"], ["day"], ["f"])


BOUNDS = "b AS (SELECT avg(value) - 3 * stddev_samp(value) AS lo, avg(value) + 3 * stddev_samp(value) AS hi FROM v)"


@query(
    f"""
    WITH v AS (SELECT event_id, event_type, value, CAST({K} AS DOUBLE) AS k FROM events), {BOUNDS},
    c AS (SELECT avg(k) - 3 * stddev_samp(k) AS klo, avg(k) + 3 * stddev_samp(k) AS khi FROM v),
    o AS (SELECT *, (CASE WHEN value < lo OR value > hi THEN 1 ELSE 0 END)
                  + (CASE WHEN k < klo OR k > khi THEN 1 ELSE 0 END) AS outlier_count FROM v, b, c)
    SELECT event_id, round(least(greatest(value, lo), hi), 6) AS value,
           round(least(greatest(k, klo), khi), 6) AS k, outlier_count,
           CASE WHEN event_type = 'purchase' AND outlier_count = 0 THEN 1 ELSE 0 END AS has_device
    FROM o
    """
)
def outlier_clip(spark, sf_dir):
    events = events_with_code(spark, sf_dir).select(
        "event_id", "value", "k", fn.flag(F.col("event_type") == "purchase").alias("has_device")
    )
    out = clean.sigma_clip(events, ["value", "k"])
    return rounded(clean.reset_flag(out, "has_device", F.col("outlier_count") > 0), 6, "value", "k")


@query(
    f"""
    WITH v AS (SELECT value FROM events), {BOUNDS},
    d AS (SELECT CAST(n_chars AS DOUBLE) AS value FROM documents)
    SELECT 'value' AS field, round(any_value(lo), 6) AS lo, round(any_value(hi), 6) AS hi,
           CAST(count(*) FILTER (value < lo OR value > hi) AS BIGINT) AS n FROM v, b
    UNION ALL
    SELECT 'n_chars', round(any_value(lo), 6), round(any_value(hi), 6),
           CAST(count(*) FILTER (value < lo OR value > hi) AS BIGINT)
    FROM d, (SELECT avg(value) - 3 * stddev_samp(value) AS lo, avg(value) + 3 * stddev_samp(value) AS hi FROM d)
    """
)
def outlier_report(spark, sf_dir):
    values = clean.outlier_report(table(spark, sf_dir, "events"), ["value"])
    lengths = clean.outlier_report(table(spark, sf_dir, "documents"), ["n_chars"])
    return rounded(values.unionByName(lengths), 6, "lo", "hi")


@query(
    f"""
    WITH v AS (SELECT event_id, CASE WHEN value >= 1 THEN value END AS value FROM events), {BOUNDS}
    SELECT event_id, value FROM v, b WHERE value BETWEEN lo AND hi
    """
)
def outlier_remove(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("value") >= 1, F.col("value")).alias("value")
    )
    return clean.sigma_clip(events, ["value"], method="remove")


ZEROED = "SELECT event_id, CASE WHEN event_type = 'signup' THEN 0 WHEN value >= 1 THEN value END AS value FROM events"
NONZERO = "b AS (SELECT avg(value) - 3 * stddev_samp(value) AS lo, avg(value) + 3 * stddev_samp(value) AS hi FROM v WHERE value <> 0)"


def zeroed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_type") == "signup", 0.0).when(F.col("value") >= 1, F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))


@query(
    f"""
    WITH v AS ({ZEROED}), {NONZERO}
    SELECT event_id, round(CASE WHEN value = 0 THEN 0 WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END, 6) AS value
    FROM v, b
    """
)
def outlier_clip_nonzero(spark, sf_dir):
    return rounded(
        clean.sigma_clip(zeroed_events(spark, sf_dir), ["value"], ignore_zero=True), 6, "value"
    )


@query(
    f"""
    WITH v AS ({ZEROED}), {NONZERO}
    SELECT event_id, value FROM v, b WHERE value = 0 OR value BETWEEN lo AND hi
    """
)
def outlier_remove_nonzero(spark, sf_dir):
    return clean.sigma_clip(
        zeroed_events(spark, sf_dir), ["value"], method="remove", ignore_zero=True
    )


HOLES = f"""{USER_DAYS}, h AS (
    SELECT user_id, day, CASE WHEN n % 2 = 1 AND user_id % 10 <> 0 THEN total END AS x,
           CASE WHEN n > 1 THEN CAST(n AS DOUBLE) END AS y FROM user_days)"""


@query(
    f"""
    WITH {HOLES},
    g AS (SELECT user_id, day, coalesce(x, avg(x) OVER (PARTITION BY user_id)) AS x,
                 coalesce(y, avg(y) OVER (PARTITION BY user_id)) AS y FROM h)
    SELECT user_id, day, round(coalesce(x, avg(x) OVER ()), 6) AS x, round(coalesce(y, avg(y) OVER ()), 6) AS y FROM g
    """
)
def group_mean_fill(spark, sf_dir):
    days = user_days(spark, sf_dir).select(
        "user_id",
        "day",
        F.when((F.col("n") % 2 == 1) & (F.col("user_id") % 10 != 0), F.col("total")).alias("x"),
        F.when(F.col("n") > 1, F.col("n").cast("double")).alias("y"),
    )
    return rounded(clean.group_mean_fill(days, ["user_id"], ["x", "y"]), 6, "x", "y")


@query(f"WITH {HOLES} SELECT user_id, day, coalesce(x, 0) AS x, coalesce(y, -1) AS y FROM h")
def constant_fill(spark, sf_dir):
    days = user_days(spark, sf_dir).select(
        "user_id",
        "day",
        F.when((F.col("n") % 2 == 1) & (F.col("user_id") % 10 != 0), F.col("total")).alias("x"),
        F.when(F.col("n") > 1, F.col("n").cast("double")).alias("y"),
    )
    return days.na.fill({"x": 0.0, "y": -1.0})


@query(
    """
    WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity / 1000 AS free_km, l_extendedprice / 1000 AS km,
                      l_discount / 3600 AS ride_hours, l_tax / 3600 AS wait_hours FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(free_km + km, 8) AS distance,
      round(free_km / nullif(free_km + km, 0), 8) AS empty_distance_ratio,
      round(ride_hours + wait_hours, 8) AS duration,
      round(wait_hours / nullif(ride_hours + wait_hours, 0), 8) AS idle_time_ratio
    FROM t
    """
)
def unit_and_ratio_features(spark, sf_dir):
    trips = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("free_km"),
        F.col("l_extendedprice").alias("km"), F.col("l_discount").alias("ride_hours"),
        F.col("l_tax").alias("wait_hours"),
    )
    units = {"free_km": 1000, "km": 1000, "ride_hours": 3600, "wait_hours": 3600}
    sums = fn.scale_units(trips, units).withColumns(
        {
            "distance": F.col("free_km") + F.col("km"),
            "duration": F.col("ride_hours") + F.col("wait_hours"),
        }
    )
    out = sums.withColumns(
        {
            "empty_distance_ratio": fn.ratio("free_km", "distance"),
            "idle_time_ratio": fn.ratio("wait_hours", "duration"),
        }
    ).drop(*units)
    return rounded(out, 8, "distance", "empty_distance_ratio", "duration", "idle_time_ratio")


@query(
    f"""
    WITH {USER_DAYS}
    SELECT user_id, day, round((total - avg(total) OVER ()) / stddev_pop(total) OVER (), 6) + 0.0 AS total,
      round((n - avg(n) OVER ()) / stddev_pop(n) OVER (), 6) + 0.0 AS n, CAST(0 AS DOUBLE) AS same
    FROM user_days
    """
)
def standardize(spark, sf_dir):
    days = user_days(spark, sf_dir).withColumn("same", F.lit(0.1))
    return rounded(clean.standardize(days, ["total", "n", "same"]), 6, "total", "n", "same")


HASHED = "md5('42|' || CAST(o_orderkey AS VARCHAR))"


@query(
    f"""
    WITH y AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {HASHED}, o_orderkey) AS r,
                 count(*) OVER (PARTITION BY y) AS c FROM y)
    SELECT o_orderkey, CASE WHEN y = 0 AND r <= floor(c * CAST(0.1 AS DOUBLE)) THEN 1 ELSE y END AS y FROM r
    """
)
def label_noise(spark, sf_dir):
    labelled = table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.flag(F.col("o_orderstatus") == "F").alias("y")
    )
    return sampling.flip_labels(labelled, "o_orderkey", "y", ratio=0.1, seed=42)


@query(
    f"""
    SELECT o_orderkey, CASE WHEN r <= ceil(c * CAST(0.2 AS DOUBLE)) THEN 1 ELSE 0 END AS is_test
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {HASHED}, o_orderkey) AS r, count(*) OVER () AS c FROM orders)
    """
)
def hash_split(spark, sf_dir):
    return sampling.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query(
    f"""
    SELECT o_orderkey, o_orderstatus, CAST((r > floor(c / 3)) AS INTEGER) + CAST((r > floor(c * 2 / 3)) AS INTEGER) AS fold
    FROM (SELECT o_orderkey, o_orderstatus,
                 row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASHED}, o_orderkey) AS r,
                 count(*) OVER (PARTITION BY o_orderstatus) AS c FROM orders)
    """
)
def stratified_folds(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_folds(orders, "o_orderkey", "o_orderstatus")


@query(
    f"""
    WITH {USER_DAYS}, {STREAKS},
    p AS (SELECT user_id, day, CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS purchases FROM
            (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events) GROUP BY 1, 2),
    j AS (SELECT d.user_id, d.day, d.n, d.total, purchases, streak_before FROM user_days d
          JOIN p ON p.user_id = d.user_id AND p.day = d.day
          JOIN streaks s ON s.user_id = d.user_id AND s.day = d.day)
    SELECT user_id, day, n, total, purchases, streak_before,
      round(CASE WHEN count(total) {FRAME} > 1 THEN (sum(total) {FRAME} - total) / (count(total) {FRAME} - 1) END, 6) AS total_8d_mean,
      CAST(CASE WHEN count(purchases) {FRAME} > 1 THEN sum(purchases) {FRAME} - purchases END AS BIGINT) AS purchases_8d_sum,
      round(stddev_samp(n) {FRAME}, 6) AS n_8d_std
    FROM j
    """
)
def daily_feature_panel(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    daily = events.groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("n"),
        fn.round_to(F.sum("value"), 4).alias("total"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    )
    streaks = panel.streak_before(daily, ["user_id"], "day", on_panel=True)
    out = panel.rolling(
        streaks, ["user_id"], "day",
        {"total": ["mean"], "purchases": ["sum"], "n": ["std"]}, days=8,
    )
    return rounded(out, 6, "total_8d_mean", "n_8d_std")
