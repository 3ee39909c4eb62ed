"""Forward fills that go on from what was carried before: the last valid values of each key, stored as of a day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import nan_to_null
from ..session import hand_off, interim
from ..sources.days import DayTable, listed_days
from ..sources.files import write_parquet
from ..sources.scan import _load
from .fill import forward_fill
from .skew import skew_join


@dataclass(frozen=True)
class CarriedState:
    """``folder`` holds, for each ``as_of`` day, the last valid values of all keys up to the end of that day."""

    folder: str
    keys: tuple[str, ...]
    cols: tuple[str, ...]

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        return _load(spark.read.format("parquet"), self.folder)

    def days(self, spark: SparkSession) -> list[date]:
        stored = self._stored(spark)
        return [] if stored is None else listed_days(stored, "as_of")

    def read(self, spark: SparkSession, as_of: date) -> DataFrame:
        """keys and cols as of one day; only its folder is read."""
        return self._stored(spark).where(F.col("as_of") == F.lit(as_of)).select(*self.keys, *self.cols)


def _last_valid(rows: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    at = F.struct(*order)
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols])


def _filled_from(rows: DataFrame, before: DataFrame | None, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``rows`` filled forward, and what is empty then from the state ``before``."""
    filled = forward_fill(rows, keys, order, cols)
    if before is None:
        return filled
    carried = before.select(*keys, *[F.col(c).alias(f"__{c}") for c in cols])
    joined = skew_join(filled, carried, keys)
    return joined.withColumns({c: F.coalesce(c, f"__{c}") for c in cols}).select(*filled.columns)


def advance(base: DayTable, filled: DayTable, state: CarriedState, rows: DataFrame) -> list[date]:
    """Add ``rows`` to ``base`` and bring ``filled`` and ``state`` up to date; gives the days of the rows.

    ``filled`` then holds what ``forward_fill`` by day gives for all of ``base``. The fill starts from the last state before
    the earliest new day; of later days only rows of the keys that have new rows are read, so a night of new days reads
    no history at all. States of days that late rows reach are corrected for these keys. Rows with a null in a key or in the day are left
    out. Late rows from before the first state, where rows of their time are stored already, are refused: nothing is known to start from.
    """
    spark, keys, cols, day = rows.sparkSession, list(state.keys), list(state.cols), base.day
    if not base.keys == filled.keys == state.keys or base.day != filled.day:
        raise ValueError("base, filled rows and state need the same keys and day")
    with interim(spark):
        rows = base.new_rows(nan_to_null(rows, cols))
        touched = listed_days(rows, day)
        if not touched:
            return []
        known = state.days(spark)
        start = max((d for d in known if d < touched[0]), default=None)
        stored = base.read(spark)
        if start is None and known and stored is not None and not stored.where(F.col(day) < F.lit(touched[0])).isEmpty():
            raise ValueError(f"rows of {touched[0]} are older than the first state, of {known[0]}")
        base.upsert(rows)
        own = rows.select(*keys).distinct()
        before = None if start is None else hand_off(state.read(spark, start), "state")
        later = base.read(spark, since=touched[0] if start is None else start + timedelta(days=1))
        redone = hand_off(_filled_from(later.join(own, keys, "left_semi"), before, keys, [day], cols), "filled")
        filled.upsert(hand_off(redone.where(F.col(day) >= F.lit(touched[0])), "filled-new"))

        newer = {touched[-1]} if not known or touched[-1] > known[-1] else set()
        for as_of in sorted({d for d in known if d >= touched[0]} | newer):
            now = _last_valid(redone.where(F.col(day) <= F.lit(as_of)), keys, [day], cols)
            if before is not None:  # keys without a row since the start keep what they had
                now = now.unionByName(before.join(own, keys, "left_semi").join(now.select(*keys), keys, "left_anti"))
            last = max((d for d in known if d <= as_of), default=None)
            if last is not None:
                now = now.unionByName(state.read(spark, last).join(own, keys, "left_anti"))
            write_parquet(now.withColumn("as_of", F.lit(as_of)), state.folder, partition_by=["as_of"], mode="replace_partitions")
            known = sorted({*known, as_of})
    return touched
