"""Rolling statistics kept up to date: a new or late day changes only the windows that look at it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..session import hand_off, interim
from ..sources.days import DayTable, days_around
from .panel import rolling


def update_rolling(
    panel: DayTable,
    rolled: DayTable,
    rows: DataFrame,
    wanted: Mapping[str, Sequence[str]] | Sequence[str],
    funcs: Sequence[str] | None = None,
    *,
    days: int = 7,
    exclude_current: bool = True,
) -> list[date]:
    """Add new, late or corrected ``rows`` to ``panel`` and bring ``rolled`` up to date; gives the days that changed.

    ``rolled`` then holds what ``rolling`` gives for the whole panel. A row of day d stands in the windows of its key on
    d and the ``days - 1`` days after, which in turn look back ``days - 1`` days: these days are read, for the keys of the new
    rows alone, and the results replace the rows of just these keys and days. Making the same update again changes nothing.
    """
    spark, keys, day = rows.sparkSession, list(panel.keys), panel.day
    if (rolled.keys, rolled.day) != (panel.keys, panel.day):
        raise ValueError("both tables need the same keys and day")
    with interim(spark):
        rows = panel.new_rows(rows)
        touched = panel.upsert(rows)
        if not touched:
            return []
        seen = panel.read(spark, days_around(touched, days - 1, days - 1))
        own = seen.join(rows.select(*keys).distinct(), keys, "left_semi")
        windows = rolling(own, keys, day, wanted, funcs, days=days, exclude_current=exclude_current)
        reached = rows.select(*keys, F.explode(F.sequence(F.col(day), F.date_add(day, days - 1))).alias(day)).distinct()
        return rolled.upsert(hand_off(windows.join(reached, [*keys, day], "left_semi"), "windows"))
