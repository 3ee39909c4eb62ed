"""Carrying values along an order, within keys or through the whole table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import any_null, nan_to_null
from ..session import hand_off
from .skew import HOT_ROWS, hot_keys, mark_hot


def _ordering(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def _carry(part: Sequence[str], order: Sequence[str], col: str, backward: bool) -> list[Column]:
    w = W.partitionBy(*part).orderBy(*_ordering(order))
    found = [F.last(col, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))]
    if backward:
        # Asked only of rows without a value before them, for which the next value is the first of all. A frame
        # that begins at the row itself is read to its end again for every row.
        found.append(F.first(col, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return found


def _fill_by_window(df, keys, order, cols, backward):
    return df.withColumns({c: F.coalesce(*_carry(keys, order, c, backward)) for c in cols})


def _fill_by_chunks(df, keys, order, cols, backward, chunks=None):
    """Fill without ever putting one key, or the table, into one task.

    Range partitioning by key and order gives even chunks even if one key fills
    them all. Each chunk is filled on its own; what must be carried over its
    edges comes from one summary row per chunk and key. Only keys that cross an
    edge need it: at most two rows per chunk, which bounds the small ordered
    window and the broadcast below by the number of partitions.
    """
    chunk = "__chunk"
    parts = () if chunks is None else (chunks,)
    ranged = df.repartitionByRange(*parts, *_ordering([*keys, *order])).withColumn(
        chunk, F.spark_partition_id()
    )
    # The chunk of a row must be the same in both uses below.
    ranged = hand_off(ranged, "ordered-fill")
    position = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])
    edges = ranged.groupBy(chunk, *keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"__last_{c}") for c in cols],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"__first_{c}") for c in cols],
    )
    if keys:
        edges = edges.withColumn("__chunks", F.count(F.lit(1)).over(W.partitionBy(*keys)))
        edges = edges.where("__chunks > 1")
    w = W.partitionBy(*keys).orderBy(chunk)
    before, whole = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    carried = edges.select(
        F.col(chunk).alias("__at"),
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__in_{c}") for c in cols],
        *[F.first(f"__first_{c}", ignorenulls=True).over(whole).alias(f"__out_{c}") for c in cols],
    )
    same = reduce(
        and_,
        [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys],
        F.col(chunk) == F.col("__at"),
    )

    def filled(c):
        forward, *back = _carry([chunk, *keys], order, c, backward)
        later = [*back, F.col(f"__out_{c}")] if backward else []
        return F.coalesce(forward, F.col(f"__in_{c}"), *later)

    return (
        ranged.join(F.broadcast(carried), same, "left")
        .withColumns({c: filled(c) for c in cols})
        .select(*df.columns)
    )


def _fill(df, keys, order, cols, backward, min_rows, chunks):
    df = nan_to_null(df, cols)
    if not keys:
        return _fill_by_chunks(df, [], order, cols, backward, chunks)
    # Rows without a key belong to no group and are not filled from each other.
    known = df.withColumns({c: F.when(~any_null(keys), F.col(c)) for c in cols})
    hot = hot_keys(df, keys, min_rows=min_rows)
    if hot is None:
        return _fill_by_window(known, keys, order, cols, backward)
    marked = mark_hot(known, hot, keys)
    cold = _fill_by_window(marked.where("__salts = 1"), keys, order, cols, backward)
    large = _fill_by_chunks(marked.where("__salts > 1"), keys, order, cols, backward, chunks)
    return cold.unionByName(large).drop("__salts")


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    *,
    across_groups: bool = False,
    min_rows: int = HOT_ROWS,
    chunks: int | None = None,
) -> DataFrame:
    """Last non-null value so far, in ``order`` within ``keys``; NaN counts as null.

    ``across_groups`` carries values on from one group to the next in key order.
    The order must be total. ``chunks`` sets the number of pieces that large groups, or the
    whole table, are cut into; by default Spark's own number of partitions.
    """
    if across_groups:
        return _fill(df, [], [*keys, *order], list(cols), False, min_rows, chunks)
    return _fill(df, list(keys), list(order), list(cols), False, min_rows, chunks)


def fill_forward_backward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    col: str,
    *,
    valid: Column | None = None,
    sentinel: float | None = -1,
    min_rows: int = HOT_ROWS,
    chunks: int | None = None,
) -> DataFrame:
    """Replace values that are not ``valid`` (default: positive) by the previous valid one,
    else by the next one, else by ``sentinel``."""
    df = nan_to_null(df, [col])
    valid = F.col(col) > 0 if valid is None else valid
    out = _fill(
        df.withColumn(col, F.when(valid, F.col(col))), list(keys), list(order), [col], True, min_rows, chunks
    )
    return out if sentinel is None else out.withColumn(col, F.coalesce(F.col(col), F.lit(sentinel)))
