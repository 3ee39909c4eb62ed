"""Tables kept up to date night by night: the results must be those of one run over everything."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn
from ..operators import carry, clean, incremental, moments, panel
from ..session import scratch_folder
from ..sources.days import DayTable
from .dim_queries import USER_DAYS, user_days
from .panel_queries import gappy_days, rounded
from .registry import ORACLES, query, table
from .rollup_queries import K, events_with_code

FIRST, SECOND = date(2024, 1, 12), date(2024, 1, 22)


def _steps(days: DataFrame) -> list[DataFrame]:
    """Three nights' rows: the days up to the first date, up to the second, and the rest; one row in nine is a night late."""
    night = F.when(F.col("day") <= F.lit(FIRST), 0).when(F.col("day") <= F.lit(SECOND), 1).otherwise(2)
    late = F.when((F.col("user_id") + F.dayofmonth("day")) % 9 == 0, 1).otherwise(0)
    return [days.where(F.least(night + late, F.lit(2)) == n) for n in range(3)]


@query(ORACLES["rolling_exclude_current"])
def rolling_in_steps(spark, sf_dir):
    """Three updates of a stored panel and its windows, two of them with late rows."""
    base, rolled = (DayTable(scratch_folder(spark, name), ("user_id",)) for name in ("panel", "rolled"))
    for rows in _steps(gappy_days(spark, sf_dir)):
        incremental.update_rolling(base, rolled, rows, {"x": panel.ROLLING_FUNCS, "n": ["sum"]}, days=8)
    out = rolled.read(spark).drop("n", "total", "x")
    return rounded(out, 6, "x_8d_mean", "x_8d_sum", "x_8d_std")


@query(
    f"""
    WITH {USER_DAYS}, g AS (SELECT user_id, day, CASE WHEN n >= 4 THEN n END AS f FROM user_days)
    SELECT user_id, day, last_value(f IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f
    FROM g
    """
)
def carried_fill_in_steps(spark, sf_dir):
    """A forward fill that goes on, each night, from the last valid values stored as of a day."""
    days = user_days(spark, sf_dir).select("user_id", "day", F.when(F.col("n") >= 4, F.col("n")).alias("f"))
    base, filled = (DayTable(scratch_folder(spark, name), ("user_id",)) for name in ("base", "filled"))
    state = carry.CarriedState(scratch_folder(spark, "carried"), ("user_id",), ("f",))
    for rows in _steps(days):
        carry.advance(base, filled, state, rows)
    return filled.read(spark).select("user_id", "day", "f")


START, END = date(2024, 1, 6), date(2024, 1, 25)
COLS = ["value", "k", "large"]
KEPT = f"""v AS (SELECT event_id, value, CAST({K} AS DOUBLE) AS k, CASE WHEN value > 40 THEN value WHEN value < 10 THEN 0 END AS large
                 FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{START}' AND DATE '{END}')"""


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of twenty days, merged from days that were stored in two nights; the second corrects a day of the first."""
    large = F.when(F.col("value") > 40, F.col("value")).when(F.col("value") < 10, 0.0)
    rows = events_with_code(spark, sf_dir).select(F.to_date("ts").alias("day"), "value", F.col("k").cast("double").alias("k"), large.alias("large"))
    states = DayTable(scratch_folder(spark, "moments"), ())
    wrong = rows.withColumn("value", F.when(F.col("day") == F.lit(FIRST), 1e6).otherwise(F.col("value")))
    moments.update_moments(states, wrong.where(F.col("day") <= F.lit(FIRST)), COLS, ignore_zero=["large"])
    moments.update_moments(states, rows.where(F.col("day") >= F.lit(FIRST)), COLS, ignore_zero=["large"])
    return moments.stored_moments(states, spark, COLS, start=START, end=END)


@query(
    f"""
    WITH {KEPT}, f AS (SELECT 'value' AS field, value AS x FROM v UNION ALL SELECT 'k', k FROM v UNION ALL SELECT 'large', nullif(large, 0) FROM v)
    SELECT field, CAST(count(x) AS BIGINT) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS scale,
           round(avg(x) - 3 * stddev_samp(x), 6) AS lo, round(avg(x) + 3 * stddev_samp(x), 6) AS hi, min(x) AS low, max(x) AS high
    FROM f GROUP BY field
    """
)
def bounds_from_stored_days(spark, sf_dir):
    """Bounds, means and scales of a range of days, from states of days alone."""
    state = _states(spark, sf_dir)
    lines = state.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("s")) for c in COLS])))
    bounds, scaler = moments.sigma_bounds_of(state, COLS), moments.scaler_of(state, COLS)
    pick = lambda df, part: F.element_at(F.create_map(*[x for c in COLS for x in (F.lit(c), F.col(c)[part])]), F.col("field"))
    fits = bounds.select(*[F.col(c).alias(c) for c in COLS]).select(F.explode(F.array(*map(F.lit, COLS))).alias("field"), *COLS)
    fits = fits.select("field", pick(fits, "lo").alias("lo"), pick(fits, "hi").alias("hi"))
    scales = scaler.select(F.explode(F.array(*map(F.lit, COLS))).alias("field"), *COLS)
    scales = scales.select("field", pick(scales, "mean").alias("mean"), pick(scales, "scale").alias("scale"))
    out = lines.join(fits, "field").join(scales, "field")
    out = out.select("field", F.col("s")["n"].alias("n"), "mean", "scale", "lo", "hi", F.col("s")["low"].alias("low"), F.col("s")["high"].alias("high"))
    return rounded(out, 6, "mean", "scale", "lo", "hi")


@query(
    f"""
    WITH {KEPT}, b AS (SELECT avg(value) - 3 * stddev_samp(value) AS lo, avg(value) + 3 * stddev_samp(value) AS hi, avg(k) AS m, stddev_pop(k) AS s FROM v)
    SELECT event_id, round(least(greatest(e.value, lo), hi), 6) AS value, round((CAST({K} AS DOUBLE) - m) / s, 6) + 0.0 AS k FROM events e, b
    """
)
def clip_and_scale_from_stored_days(spark, sf_dir):
    """All events, clipped and scaled by the states of a range of days; the range itself is not read again."""
    state = _states(spark, sf_dir)
    events = events_with_code(spark, sf_dir).select("event_id", "value", F.col("k").cast("double").alias("k"))
    clipped = clean.sigma_clip(events, ["value"], bounds=moments.sigma_bounds_of(state, ["value"]), count_col=None)
    return rounded(clean.standardize(clipped, ["k"], fit=moments.scaler_of(state, ["k"])), 6, "value", "k")


@query(
    """
    WITH v AS (SELECT event_id, user_id, CASE WHEN value > 30 THEN value END AS x FROM events),
    g AS (SELECT event_id, coalesce(x, avg(x) OVER (PARTITION BY user_id)) AS x FROM v)
    SELECT event_id, round(coalesce(x, avg(x) OVER ()), 6) AS x FROM g
    """
)
def group_means_from_stored_days(spark, sf_dir):
    """Gaps filled with means of users that are merged from states of their days."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), F.when(F.col("value") > 30, F.col("value")).alias("x"))
    states = DayTable(scratch_folder(spark, "group-moments"), ("user_id",))
    for part in (F.col("day") > F.lit(SECOND), F.col("day") <= F.lit(SECOND)):
        moments.update_moments(states, events.where(part), ["x"])
    stats = moments.group_means_of(moments.stored_moments(states, spark, ["x"]), ["user_id"], ["x"])
    out = clean.group_mean_fill(events.select("event_id", "user_id", "x"), ["user_id"], ["x"], stats=stats)
    return out.select("event_id", fn.round_to("x", 6).alias("x"))
