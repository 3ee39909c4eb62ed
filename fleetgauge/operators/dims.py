"""Cleaning of dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import flag
from ..functions.codes import HOLIDAY_TYPES
from .skew import skew_join


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Spark keeps one row per key and task before the shuffle (WindowGroupLimit),
    # so a hot key sends one row per task, not all of its rows.
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    *,
    nulls_win: bool = False,
) -> DataFrame:
    """The row with the largest order value; later columns break ties.

    A null order value never wins unless ``nulls_win`` asks for it.
    """
    cols = [_as_column(c) for c in order]
    ranked = [c.desc_nulls_first() if nulls_win else c.desc_nulls_last() for c in cols]
    return _one_per_key(df, keys, ranked)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the smallest order value; null order values come last."""
    return _one_per_key(df, keys, [_as_column(c).asc_nulls_last() for c in order])


def known_holidays(holidays: DataFrame, day: str = "date", kind: str = "type") -> DataFrame:
    """One row per day: the first entry of a known type, in list order.

    ``holidays`` may carry ``position`` for the list order.
    """
    known = holidays.where(F.col(kind).isin(*HOLIDAY_TYPES))
    order = F.col("position") if "position" in holidays.columns else F.col(kind)
    return known.groupBy(F.to_date(F.col(day)).alias("__holiday")).agg(
        F.min_by(kind, order).alias("__kind")
    )


# Calendar days a holiday list may have to be sent to every executor: 273 years.
BROADCAST_DAYS = 100_000


def day_type(
    df: DataFrame, day: str, holidays: DataFrame, *, output: str = "date_type"
) -> DataFrame:
    """Holiday table first, weekday or weekend otherwise.

    The lookup holds one row per listed calendar day. It is broadcast if counting
    it stays below ``BROADCAST_DAYS``, so the table itself is not shuffled.
    """
    known = known_holidays(holidays)
    if known.limit(BROADCAST_DAYS + 1).count() <= BROADCAST_DAYS:
        known = F.broadcast(known)
    by_week = F.when(F.weekday(F.to_date(F.col(day))) < 5, "workday").otherwise("weekend")
    return (
        df.join(known, F.to_date(F.col(day)) == F.col("__holiday"), "left")
        .withColumn(output, F.coalesce(F.col("__kind"), by_week))
        .drop("__holiday", "__kind")
    )


def label_from_events(
    spine: DataFrame, events: DataFrame, on: Sequence[str], *, output: str = "target", skewed: bool = True
) -> DataFrame:
    """1 where an event exists for the spine row, else 0.

    Events are reduced to one row per key first, so the spine never multiplies. Spine rows of
    a hot key, such as a null, are spread; this counts the keys of the spine, which ``skewed=False`` saves where
    they are known to be spread.
    """
    keys = list(on)
    seen = events.select(*keys).dropna().distinct().withColumn("__seen", F.lit(1))
    return (
        (skew_join(spine, seen, keys) if skewed else spine.join(seen, keys, "left"))
        .withColumn(output, flag(F.col("__seen").isNotNull()))
        .drop("__seen")
    )
