"""Outliers, gaps and scaling.

Statistics of all columns come from one aggregation. Global ones reach the rows
as a one-row scalar subquery, never as a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import all_of, any_null, flag, nan_to_null, to_number
from ..session import hand_off
from .skew import HOT_ROWS, skew_join

_FIT = "__fit"


def _sigma_interval(col: str, ignore_zero: bool) -> Column:
    x = F.col(col).cast("double")
    if ignore_zero:
        x = F.when(x != 0, x)
    mean, dev = F.avg(x), F.stddev_samp(x)
    # A constant column is its own interval: rounding in the mean must not
    # make its only value an outlier.
    constant = (F.count(x) > 1) & (F.min(x) == F.max(x))
    return F.struct(
        F.when(constant, F.min(x)).otherwise(mean - 3 * dev).alias("lo"),
        F.when(constant, F.max(x)).otherwise(mean + 3 * dev).alias("hi"),
    ).alias(col)


def sigma_bounds(df: DataFrame, cols: Sequence[str], *, ignore_zero: bool = False) -> DataFrame:
    """One row with a struct (lo, hi) per column: mean -/+ 3 sample deviations, nulls and NaN skipped."""
    return nan_to_null(df, cols).agg(*[_sigma_interval(c, ignore_zero) for c in cols])


def _with_fit(df: DataFrame, fit: DataFrame) -> DataFrame:
    return df.withColumn(_FIT, fit.select(F.struct(*fit.columns)).scalar())


def sigma_clip(
    df: DataFrame,
    cols: Sequence[str],
    *,
    method: str = "truncate",
    ignore_zero: bool = False,
    count_col: str | None = "outlier_count",
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Three-sigma outliers: ``truncate`` them to the bounds or ``remove`` their rows.

    ``truncate`` keeps nulls and counts the clipped fields of a row in
    ``count_col``; ``remove`` also drops rows with a null. With ``ignore_zero``
    zeros neither enter the statistics nor change, and nothing is counted.
    """
    if method not in ("truncate", "remove"):
        raise ValueError("method must be 'truncate' or 'remove'")
    df = nan_to_null(df, cols)
    fit = sigma_bounds(df, cols, ignore_zero=ignore_zero) if bounds is None else bounds
    out = _with_fit(df, fit)
    low = {c: F.col(_FIT)[c]["lo"] for c in cols}
    high = {c: F.col(_FIT)[c]["hi"] for c in cols}

    if method == "remove":
        inside = [(F.col(c) >= low[c]) & (F.col(c) <= high[c]) for c in cols]
        if ignore_zero:
            inside = [(F.col(c) == 0) | ok for c, ok in zip(cols, inside)]
        return out.where(F.coalesce(all_of(inside), F.lit(False))).drop(_FIT)

    touched = {c: F.col(c) != 0 if ignore_zero else F.lit(True) for c in cols}
    below = {c: touched[c] & (F.col(c) < low[c]) for c in cols}
    above = {c: touched[c] & (F.col(c) > high[c]) for c in cols}
    new = {
        c: F.when(below[c], low[c]).when(above[c], high[c]).otherwise(F.col(c).cast("double"))
        for c in cols
    }
    if count_col and not ignore_zero:
        new[count_col] = reduce(add, [flag(below[c] | above[c]) for c in cols])
    return out.withColumns(new).drop(_FIT)


def reset_flag(df: DataFrame, col: str, when: Column) -> DataFrame:
    """Set a 1 back to 0 where the condition holds."""
    return df.withColumn(col, F.when((F.col(col) == 1) & when, 0).otherwise(F.col(col)))


def outlier_report(df: DataFrame, cols: Sequence[str], *, ignore_zero: bool = False) -> DataFrame:
    """Bounds and number of outliers per field."""
    df = nan_to_null(df, cols)
    out = _with_fit(df, sigma_bounds(df, cols, ignore_zero=ignore_zero))

    def line(c):
        x, fit = F.col(c), F.col(_FIT)[c]
        outside = (x < fit["lo"]) | (x > fit["hi"])
        if ignore_zero:
            outside = outside & (x != 0)
        return F.struct(
            F.lit(c).alias("field"),
            F.max(fit["lo"]).alias("lo"),
            F.max(fit["hi"]).alias("hi"),
            F.count_if(outside).alias("n"),
        )

    return out.agg(F.array(*[line(c) for c in cols]).alias("lines")).select(
        F.inline("lines")
    )


def coercion_report(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Per column: how many values are lost when it is read as a number of the given type."""

    def line(c, kind):
        lost = F.col(c).isNotNull() & to_number(df, c, kind).isNull()
        return F.struct(
            F.lit(c).alias("field"), F.lit(kind).alias("type"), F.count_if(lost).alias("bad")
        )

    lines = F.array(*[line(c, kind) for c, kind in targets.items()])
    return df.agg(lines.alias("lines")).select(F.inline("lines"))


def group_mean_fill(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    *,
    min_rows: int = HOT_ROWS,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Fill nulls with the mean of their group, then with the mean of the filled column.

    One aggregation gives count and means per group, unless ``stats`` brings them from a stored state
    (``moments.group_means_of``), which may hold more rows than ``df``. The mean of the filled
    column follows from it without another pass: a group with a mean weighs all
    its rows. Rows with a null key get no group mean. NaN counts as null.
    """
    keys, cols = list(keys), list(cols)
    df = nan_to_null(df, cols)
    if stats is None:
        stats = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__rows"),
            *[F.avg(c).alias(f"__mean_{c}") for c in cols],
            *[F.count(c).alias(f"__n_{c}") for c in cols],
        )
    stats = hand_off(stats, "group-means")

    def overall(c):
        mean, seen = F.col(f"__mean_{c}"), F.col(f"__n_{c}")
        weight = F.when(any_null(keys), seen).when(seen > 0, F.col("__rows")).otherwise(0)
        return F.try_divide(F.sum(mean * weight), F.sum(weight)).alias(c)

    joined = skew_join(
        df,
        stats.dropna(subset=keys).select(*keys, *[f"__mean_{c}" for c in cols]),
        keys,
        counts=stats,
        min_rows=min_rows,
    )
    joined = _with_fit(joined, stats.agg(*[overall(c) for c in cols]))
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"__mean_{c}"), F.col(_FIT)[c]) for c in cols}
    ).select(*df.columns)


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with a struct (mean, scale) per column; population deviation, 1 for a constant; NaN counts as null."""
    df = nan_to_null(df, cols)

    def fitted(c):
        constant = F.min(c) == F.max(c)
        dev = F.when(constant, 1.0).otherwise(F.stddev_pop(c))
        return F.struct(F.avg(c).alias("mean"), dev.alias("scale")).alias(c)

    return df.agg(*[fitted(c) for c in cols])


def standardize(
    df: DataFrame,
    cols: Sequence[str],
    *,
    fit_on: DataFrame | None = None,
    fit: DataFrame | None = None,
) -> DataFrame:
    """Centre and scale; statistics of ``df``, of ``fit_on`` or of a stored ``fit``."""
    df = nan_to_null(df, cols)
    if fit is None:
        fit = fit_scaler(df if fit_on is None else fit_on, cols)

    # A column that is constant where it was fitted may still vary in ``df``.
    def scaled(c):
        f = F.col(_FIT)[c]
        centred = F.col(c) - f["mean"]
        return centred / f["scale"]

    return _with_fit(df, fit).withColumns({c: scaled(c) for c in cols}).drop(_FIT)
