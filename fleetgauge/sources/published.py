"""Results that become visible only as a whole, after they were looked at.

A version is written aside, under a name of its own, and shown by one small file that is written last. Readers see the last version that
was shown; a write that fails, or that a gate refuses, changes nothing for them. One writer at a time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..session import delete_folder
from .scan import _load

LINE = "version long, place string, rows long, nulls map<string,long>"


class RefusedError(ValueError):
    """A gate kept a result from being published; ``facts`` says what was counted."""

    def __init__(self, reason: str, facts: Facts):
        super().__init__(reason)
        self.facts = facts


@dataclass(frozen=True)
class Facts:
    """Rows of a result, and nulls of each column."""

    rows: int
    nulls: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Gate:
    """What a result must keep to: a range of rows, and the most nulls that some columns may have, as a share of the rows."""

    least_rows: int | None = None
    most_rows: int | None = None
    most_nulls: Mapping[str, float] = field(default_factory=dict)

    def objection(self, facts: Facts) -> str | None:
        """The first rule that is broken, in words."""
        if self.least_rows is not None and facts.rows < self.least_rows:
            return f"{facts.rows} rows, fewer than {self.least_rows}"
        if self.most_rows is not None and facts.rows > self.most_rows:
            return f"{facts.rows} rows, more than {self.most_rows}"
        for c, share in self.most_nulls.items():
            if facts.nulls[c] > share * facts.rows:
                return f"{facts.nulls[c]} of {facts.rows} rows have no {c}"
        return None


def observed_write(df: DataFrame, path: str) -> Facts:
    """Write ``df`` as Parquet; its rows and nulls are counted on the way, by the tasks that write."""
    watch = Observation()
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{k}") for k, c in enumerate(df.columns)]
    df.observe(watch, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
    seen = watch.get
    return Facts(seen["rows"], {c: seen[f"null_{k}"] for k, c in enumerate(df.columns)})


@dataclass(frozen=True)
class Versions:
    """``folder`` with its versions."""

    folder: str

    def shown(self, spark: SparkSession) -> DataFrame:
        """version, place, rows and nulls of all versions that were shown."""
        found = _load(spark.read.format("json").schema(LINE), os.path.join(self.folder, "shown", "*"))
        return spark.createDataFrame([], LINE) if found is None else found

    def new_place(self) -> str:
        return os.path.join(self.folder, "data", uuid.uuid4().hex)

    def show(self, spark: SparkSession, place: str, facts: Facts) -> int:
        """Make what is stored at ``place`` the current version; gives its number, from 1."""
        version = 1 + (self.shown(spark).agg(F.max("version")).first()[0] or 0)
        line = spark.createDataFrame([(version, place, facts.rows, dict(facts.nulls))], LINE)
        line.coalesce(1).write.json(os.path.join(self.folder, "shown", f"{version:09d}"))
        return version

    def place(self, spark: SparkSession, version: int | None = None) -> str:
        """Where the current version, or a numbered one, is stored."""
        found = self.shown(spark)
        found = found.orderBy(F.desc("version")) if version is None else found.where(F.col("version") == version)
        line = found.first()
        if line is None:
            raise FileNotFoundError(f"{self.folder}: no version {version or 'is published'}")
        return line.place


def publish(df: DataFrame, folder: str, gate: Gate = Gate()) -> tuple[int, Facts]:  # noqa: B008
    """Store ``df`` as the next version of ``folder`` if ``gate`` has no objection; gives its number and what was counted.

    The plan runs once: counts come from the tasks that write. A refused result is deleted, and raises; the version before it stays the current one.
    """
    spark, versions = df.sparkSession, Versions(folder)
    place = versions.new_place()
    facts = observed_write(df, place)
    reason = gate.objection(facts)
    if reason is not None:
        delete_folder(spark, place)
        raise RefusedError(reason, facts)
    return versions.show(spark, place, facts), facts


def read_published(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The current version of ``folder``, or a numbered one."""
    return spark.read.parquet(Versions(folder).place(spark, version))
