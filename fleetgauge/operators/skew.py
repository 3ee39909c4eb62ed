"""Finding hot keys and joining through them without one overloaded task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import hand_off

# A key above this many rows does not fit one task.
HOT_ROWS = 1_000_000
# Hot keys that are sent to every executor; a longer list is joined as a table.
MOST_LISTED = 50_000
# Places that rows of one key of such a table are spread over.
SPREAD = 64


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    *,
    counts: DataFrame | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame | None:
    """Keys holding more than ``min_rows`` rows, or None.

    ``counts`` may bring existing row counts per key in a column ``__rows``.
    Counting is one partial aggregation over the key columns only; the list is
    stored, and marked for broadcast unless it has more than ``MOST_LISTED`` rows: then each key stands in it ``SPREAD``
    times, numbered by ``__place``, so that looking up the rows of one key is no single task either. ``__salts`` (at
    least 2) says over how many tasks of about ``min_rows`` rows a key should be spread.
    """
    counts = key_counts(df, keys) if counts is None else counts
    salts = (1 + F.ceil(F.col("__rows") / F.lit(max(min_rows, 1)))).cast("int").alias("__salts")
    found = hand_off(counts.where(F.col("__rows") > min_rows).select(*keys, salts), "hot-keys")
    n = found.count()
    if n == 0:
        return None
    if n <= MOST_LISTED:
        return F.broadcast(found)
    return found.withColumn("__place", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))


def mark_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``__salts``: that of the row's key in the list ``hot``, else 1.

    Null keys are found like any other.
    """
    places = ["__place"] if "__place" in hot.columns else []
    renamed = hot.select(*[F.col(k).alias(f"__hot_{k}") for k in [*keys, *places]], "__salts")
    if places:
        df = df.withColumn("__place", F.pmod(_row_hash(df), F.lit(SPREAD)).cast("int"))
    match = F.lit(True)
    for k in [*keys, *places]:
        match = match & F.col(k).eqNullSafe(F.col(f"__hot_{k}"))
    joined = df.join(renamed, match, "left")
    return joined.drop(*[f"__hot_{k}" for k in [*keys, *places]], *places).withColumn(
        "__salts", F.coalesce(F.col("__salts"), F.lit(1))
    )


def _row_hash(df: DataFrame) -> Column:
    # Value and input partition only: the same on every retry of a task, and
    # copies of one row still spread because they lie in different partitions.
    hashable = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, hashable)]
    return F.xxhash64(F.spark_partition_id(), *plain)


def _row_salt(df: DataFrame) -> Column:
    return F.pmod(_row_hash(df), F.col("__salts")).cast("int")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    counts: DataFrame | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi join whose left side may be dominated by a few keys, null among them.

    Rows of a hot key are spread over tasks of about ``min_rows`` rows, and its
    right rows are repeated once per task. Without hot keys it is the plain join.
    """
    on = list(on)
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    hot = hot_keys(left, on, counts=counts, min_rows=min_rows)
    if hot is None:
        return left.join(right, on, how)
    l = mark_hot(left, hot, on).withColumn("__salt", _row_salt(left)).drop("__salts")
    r = (
        mark_hot(right, hot, on)
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
        .drop("__salts")
    )
    return l.join(r, [*on, "__salt"], how).drop("__salt")
