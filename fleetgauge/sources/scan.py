"""Reading many like-named collections as one table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from ..functions import nan_to_null


def dated_names(prefix: str, run_date: date, days: int = 8, fmt: str = "%Y%m%d") -> list[str]:
    """Names of the last ``days`` daily collections, yesterday first."""
    return [f"{prefix}{run_date - timedelta(days=i + 1):{fmt}}" for i in range(days)]


def _load(reader: DataFrameReader, path: str) -> DataFrame | None:
    """The frame at ``path``, or None if nothing is there."""
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_union(
    spark: SparkSession,
    names: Sequence[str],
    *,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    text: Sequence[str] = (),
    on_missing: str = "skip",
    **options: str,
) -> DataFrame:
    """All existing collections of ``names`` as one frame.

    A name is a catalog table or a path. Names that do not exist are skipped, or
    refused with ``on_missing='error'``; if none exists the result is empty with
    ``schema``. Columns in ``text`` are cast to text, for codes stored as numbers
    in one collection and as text in another. NaN becomes null. Filters and projections put on the
    result reach every scan below the union.
    """
    frames, missing = [], []
    for name in names:
        if "/" in name:
            reader = spark.read.format(fmt).options(**options)
            found = _load(reader.schema(schema) if schema else reader, name)
            if found is not None:
                frames.append(found)
                continue
        elif spark.catalog.tableExists(name):
            frames.append(spark.table(name))
            continue
        missing.append(name)
    if missing and on_missing == "error":
        raise FileNotFoundError(", ".join(missing))
    if not frames:
        if schema is None:
            raise ValueError("no collection exists and no schema was given")
        return spark.createDataFrame([], schema)
    if text:
        frames = [
            f.withColumns({c: F.col(c).cast("string") for c in text if c in f.columns})
            for f in frames
        ]
    return nan_to_null(union_all(frames))


def extract(
    df: DataFrame, fields: Sequence[str] | None = None, where: Column | str | None = None
) -> DataFrame:
    """Filter, then keep the listed fields; all of them if none is listed."""
    out = df if where is None else df.where(where)
    return out.select(*fields) if fields else out


def scan_days(df: DataFrame, day: str, run_date: date, lookback_days: int = 15) -> DataFrame:
    """Rows from ``run_date - lookback_days`` to the day before ``run_date``.

    Compares the bare column with literals, so the range reaches the source.
    """
    start = run_date - timedelta(days=lookback_days)
    return df.where((F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(run_date)))


def read_days(df: DataFrame, partition: str, run_date: date, days: int = 8) -> DataFrame:
    """The last ``days`` daily partitions of one partitioned table, instead of dated names."""
    return df.where(F.col(partition).isin(*[run_date - timedelta(days=i + 1) for i in range(days)]))


def schema_report(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Column names and types, of the listed fields or of all."""
    rows = [
        (f.name, f.dataType.simpleString(), f.nullable)
        for f in df.schema.fields
        if not fields or f.name in fields
    ]
    return df.sparkSession.createDataFrame(rows, "field string, type string, nullable boolean")


def preview(df: DataFrame, order: Sequence[str] = (), rows: int = 5) -> DataFrame:
    """The first few rows, in order if one is given; each task keeps only that many."""
    return (df.orderBy(*order) if order else df).limit(rows)
