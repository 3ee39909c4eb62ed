"""Count, mean, squared deviations and extremes, kept by day and merged instead of counted anew.

A state table has a column ``rows`` and, for each measure, a struct (n, mean, m2, low, high). Rows of states merge into
the state of the rows together; nulls and NaN are left out throughout.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import nan_to_null
from ..session import interim
from ..sources.days import DayTable

FIELDS = ("n", "mean", "m2", "low", "high")


def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), *, ignore_zero: Sequence[str] = ()) -> DataFrame:
    """The state of ``cols`` for each value of ``by``; zeros of the columns ``ignore_zero`` are left out."""

    def state(c):
        x = F.col(c).cast("double")
        x = F.when(x != 0, x) if c in ignore_zero else x
        n = F.count(x)
        return F.struct(
            n.alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * n).alias("m2"), F.min(x).alias("low"), F.max(x).alias("high")
        ).alias(c)

    return nan_to_null(df, cols).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[state(c) for c in cols])


def merge_moments(states: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One state for each value of ``by`` from many; without any there is one of no rows if ``by`` is empty.

    Squared deviations are taken about the common mean, not derived from sums of squares, so large means cost no digits.
    """
    over = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))  # states are few: one a day
    weight = lambda c: F.col(c)["n"] * F.col(c)["mean"]
    centred = states.select("*", *[(F.sum(weight(c)).over(over) / F.nullif(F.sum(F.col(c)["n"]).over(over), F.lit(0))).alias(f"__mean_{c}") for c in cols])

    def merged(c):
        n, mean = F.col(c)["n"], F.col(c)["mean"]
        spread = F.sum(F.col(c)["m2"] + n * F.pow(mean - F.col(f"__mean_{c}"), F.lit(2)))
        return F.struct(
            F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.max(f"__mean_{c}").alias("mean"), spread.alias("m2"),
            F.min(F.col(c)["low"]).alias("low"), F.max(F.col(c)["high"]).alias("high"),
        ).alias(c)

    return centred.groupBy(*by).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *[merged(c) for c in cols])


def take_out(total: DataFrame, part: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The state of the rows that are in ``total`` and not in ``part``, both with one row for each value of ``by``.

    Extremes that the part reaches cannot be known from states: they become null. Keep states by day and merge the days that stay
    where extremes matter.
    """
    gone = part.select(*by, F.col("rows").alias("__rows"), *[F.col(c).alias(f"__{c}") for c in cols])
    both = total.join(gone, list(by), "left") if by else total.join(gone, F.lit(True), "left")  # one row each

    def left(c):
        a, b = F.col(c), F.col(f"__{c}")
        nb = F.coalesce(b["n"], F.lit(0))
        n = a["n"] - nb
        mean = F.when(nb == 0, a["mean"]).when(n > 0, (a["n"] * a["mean"] - nb * b["mean"]) / n)
        m2 = F.when(nb == 0, a["m2"]).when(n > 0, F.greatest(F.lit(0.0), a["m2"] - b["m2"] - F.pow(mean - b["mean"], F.lit(2)) * n * nb / a["n"]))
        low = F.when((nb == 0) | ((n > 0) & (a["low"] < b["low"])), a["low"])
        high = F.when((nb == 0) | ((n > 0) & (a["high"] > b["high"])), a["high"])
        return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"), low.alias("low"), high.alias("high")).alias(c)

    return both.select(*by, (F.col("rows") - F.coalesce("__rows", F.lit(0))).alias("rows"), *[left(c) for c in cols])


def update_moments(states: DayTable, rows: DataFrame, cols: Sequence[str], *, ignore_zero: Sequence[str] = ()) -> list[date]:
    """Store the states of whole days: ``rows`` are all rows of the days they belong to, which they replace."""
    with interim(rows.sparkSession):
        keyed = rows.withColumn(states.day, F.to_date(states.day))
        return states.upsert(states.new_rows(moments(keyed, cols, [*states.keys, states.day], ignore_zero=ignore_zero)))


def stored_moments(
    states: DayTable, spark, cols: Sequence[str], *, start: date | None = None, end: date | None = None
) -> DataFrame:
    """The state of all stored days from ``start`` to ``end``, for each value of the table's keys; no raw row is read."""
    stored = states.read(spark, since=start)
    if stored is None:
        raise ValueError(f"{states.folder}: nothing is stored")
    if end is not None:
        stored = stored.where(F.col(states.day) <= F.lit(end))
    return merge_moments(stored, cols, states.keys)


def _deviation(state: Column, sample: bool) -> Column:
    n = state["n"] - 1 if sample else state["n"]
    return F.sqrt(F.when(n > 0, state["m2"] / n))


def sigma_bounds_of(state: DataFrame, cols: Sequence[str]) -> DataFrame:
    """What ``clean.sigma_bounds`` gives for the rows behind the state, for ``sigma_clip(bounds=...)``."""

    def interval(c):
        s = F.col(c)
        same = (s["n"] > 1) & (s["low"] == s["high"])
        reach = 3 * _deviation(s, True)
        return F.struct(F.when(same, s["low"]).otherwise(s["mean"] - reach).alias("lo"), F.when(same, s["high"]).otherwise(s["mean"] + reach).alias("hi")).alias(c)

    return state.select(*[interval(c) for c in cols])


def scaler_of(state: DataFrame, cols: Sequence[str]) -> DataFrame:
    """What ``clean.fit_scaler`` gives for the rows behind the state, for ``standardize(fit=...)``."""

    def fitted(c):
        s = F.col(c)
        return F.struct(s["mean"].alias("mean"), F.when(s["low"] == s["high"], 1.0).otherwise(_deviation(s, False)).alias("scale")).alias(c)

    return state.select(*[fitted(c) for c in cols])


def group_means_of(state: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Counts and means of groups for ``group_mean_fill(stats=...)``."""
    return state.select(
        *keys, F.col("rows").alias("__rows"), *[F.col(c)["mean"].alias(f"__mean_{c}") for c in cols], *[F.col(c)["n"].alias(f"__n_{c}") for c in cols]
    )
