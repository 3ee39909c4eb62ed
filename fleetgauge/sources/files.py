"""Files: CSV and Parquet hand-offs, and the holiday list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import nan_to_null
from ..session import hand_off, interim


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    text: Sequence[str] = (),
) -> DataFrame:
    """CSV with a header and a given schema; columns in ``text`` are read as text,
    so identifiers keep leading zeros."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    typed = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name in text else f.dataType, f.nullable)
            for f in schema.fields
        ]
    )
    return nan_to_null(spark.read.schema(typed).option("header", True).csv(path))


def to_store(df: DataFrame, skip_empty: bool) -> DataFrame | None:
    """What a sink should write; None for an empty frame that is to be skipped.

    The plan runs once: its result is stored, and the stored rows are looked at and written on.
    """
    if not skip_empty:
        return df
    stored = hand_off(df, "to-store")
    return None if stored.isEmpty() else stored


def write_csv(df: DataFrame, path: str, *, skip_empty: bool = True) -> bool:
    """CSV with a header; an empty frame writes nothing and returns False."""
    with interim(df.sparkSession):
        rows = to_store(df, skip_empty)
        if rows is None:
            return False
        rows.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_parquet(
    df: DataFrame, path: str, *, partition_by: Sequence[str] = (), skip_empty: bool = True, mode: str = "replace"
) -> bool:
    """Parquet, by day if asked, so that later reads prune whole days.

    ``mode`` is ``replace`` for the whole target, ``replace_partitions`` for only the partitions that the
    rows belong to, or ``append``. Rows of one partition come together before the write, so that a day is a few files;
    large days are split again at run time.
    """
    if mode not in ("replace", "replace_partitions", "append"):
        raise ValueError("mode must be 'replace', 'replace_partitions' or 'append'")
    if mode == "replace_partitions" and not partition_by:
        raise ValueError("replace_partitions needs partition_by")
    with interim(df.sparkSession):
        rows = to_store(df, skip_empty)
        if rows is None:
            return False
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        writer = rows.write.mode("append" if mode == "append" else "overwrite").partitionBy(*partition_by)
        writer.option("partitionOverwriteMode", "dynamic" if mode == "replace_partitions" else "static").parquet(path)
    return True


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """``{"holidays": [{"date", "type"}, ...]}`` as rows with their list position."""
    schema = "holidays array<struct<date: string, type: string>>"
    listed = spark.read.schema(schema).json(path, multiLine=True)
    return listed.select(F.posexplode("holidays").alias("position", "h")).select(
        "position", F.to_date("h.date").alias("date"), F.col("h.type").alias("type")
    )
