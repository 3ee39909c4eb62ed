"""Stored tables with one row per key and day, one folder per day, changed day by day."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import hand_off
from .files import write_parquet
from .scan import _load

# Days that may be named one by one in a plan: 273 years.
MOST_DAYS = 100_000


def days_around(days: Iterable[date], before: int, after: int) -> list[date]:
    """All days from ``before`` days before to ``after`` days after any of the given ones, in order."""
    return sorted({d + timedelta(days=n) for d in days for n in range(-before, after + 1)})


def listed_days(rows: DataFrame, day: str) -> list[date]:
    """The distinct days of ``rows``, in order; a table of more than ``MOST_DAYS`` is refused."""
    found = [r[0] for r in rows.select(day).distinct().limit(MOST_DAYS + 1).collect()]
    if len(found) > MOST_DAYS:
        raise ValueError(f"{day} has more than {MOST_DAYS} values: not days")
    return sorted(d for d in found if d is not None)


@dataclass(frozen=True)
class DayTable:
    """``folder`` holds at most one row for each value of ``keys`` and ``day``, a date.

    Changes replace whole day folders and leave all others alone. One writer at a time; a change that stopped
    midway is made whole by making it again.
    """

    folder: str
    keys: tuple[str, ...]
    day: str = "day"

    def read(self, spark: SparkSession, days: Sequence[date] | None = None, since: date | None = None) -> DataFrame | None:
        """All rows, or those of the listed days, or from ``since`` on; only their folders are read. None if nothing is stored."""
        stored = _load(spark.read.format("parquet"), self.folder)
        if stored is None:
            return None
        if days is not None:
            stored = stored.where(F.col(self.day).isin(list(days)))
        return stored if since is None else stored.where(F.col(self.day) >= F.lit(since))

    def new_rows(self, rows: DataFrame) -> DataFrame:
        """``rows`` with all keys and a day, stored; repeated ones raise."""
        rows = hand_off(rows.withColumn(self.day, F.to_date(self.day)).dropna(subset=[*self.keys, self.day]), "new-rows")
        if not rows.groupBy(*self.keys, self.day).count().where("count > 1").isEmpty():
            raise ValueError(f"more than one row per ({', '.join(self.keys)}, {self.day})")
        return rows

    def upsert(self, rows: DataFrame) -> list[date]:
        """Add ``rows``, in place of those of the same keys and day; gives the days they belong to.

        ``rows`` must be stored and of distinct keys, as ``new_rows`` gives them.
        """
        spark, touched = rows.sparkSession, listed_days(rows, self.day)
        stored = self.read(spark, touched) if touched else None
        if stored is not None:
            others = stored.join(rows.select(*self.keys, self.day), [*self.keys, self.day], "left_anti")
            rows = rows.unionByName(others, allowMissingColumns=True)
        if touched:
            write_parquet(rows, self.folder, partition_by=[self.day], mode="replace_partitions")
        return touched
