"""Tables stored in buckets of common keys, and joins of them that shuffle nothing.

A bucketed table holds the rows of a key in one file; tables of the same layout that are joined by
these keys, or by more columns that include them, are read bucket by bucket. The rows of the large side move
once, when it is stored, however many tables are joined to it afterwards.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import register_table, work_folder


@dataclass(frozen=True)
class Layout:
    """``keys`` and the number of ``buckets``, the same for all tables that are to be joined.

    A bucket is read by one task: choose so many that the rows of a bucket fit one, and keys of which no single value
    holds more than that. A driver and a day do; a driver alone need not.
    """

    keys: tuple[str, ...]
    buckets: int

    def __post_init__(self):
        if not self.keys or self.buckets < 1:
            raise ValueError("a layout needs keys and at least one bucket")

    def covers(self, on: Sequence[str]) -> bool:
        """Whether a join by ``on`` finds all its rows within one bucket."""
        return set(self.keys) <= set(on)


def store_bucketed(
    df: DataFrame, layout: Layout, label: str, *, name: str | None = None, path: str | None = None
) -> DataFrame:
    """Write ``df`` in the layout and read it back.

    Each bucket is one file, sorted by the keys: the rows go to as many tasks as there are buckets before they are
    written. With ``name`` and ``path`` the table stays, to be read again by ``read_bucketed``; without them it is an interim
    table in the shared folder, which ``drop_hand_offs`` removes.
    """
    spark = df.sparkSession
    if (name is None) != (path is None):
        raise ValueError("a table that stays needs a name and a path")
    interim = name is None
    if interim:
        name = f"fleetgauge_{label.replace('-', '_')}_{uuid.uuid4().hex}"
        path = os.path.join(work_folder(spark), name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    first, *rest = layout.keys
    (
        df.repartition(layout.buckets, *layout.keys)
        .write.mode("overwrite")
        .bucketBy(layout.buckets, first, *rest)
        .sortBy(first, *rest)
        .option("path", path)
        .saveAsTable(name)
    )
    if interim:
        register_table(spark, name, path)
    return spark.table(name)


def read_bucketed(spark: SparkSession, layout: Layout, name: str, path: str) -> DataFrame:
    """A table that ``store_bucketed`` wrote, also in a session whose catalogue does not know it yet."""
    if not spark.catalog.tableExists(name):
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in layout.keys)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {layout.buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)
