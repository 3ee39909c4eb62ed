"""Daily roll-ups. Each is one partial-then-final hash aggregation, so a hot key
is reduced to one row per input task before anything is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def conditional_counts(
    df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]
) -> DataFrame:
    """One count per condition; a row may count for several."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def code_counts(
    df: DataFrame, keys: Sequence[str], codes: Mapping[str, Mapping[object, str]]
) -> DataFrame:
    """Counts of listed codes: ``{column: {code: output name}}``."""
    wanted = {
        name: F.col(col) == F.lit(code)
        for col, names in codes.items()
        for code, name in names.items()
    }
    return conditional_counts(df, keys, wanted)


def daily_agg(
    df: DataFrame,
    keys: Sequence[str],
    *,
    sums: Mapping[str, Column | str] | None = None,
    aggs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Sums (0 when every value is null) and other aggregates per key."""
    out = [
        F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in (sums or {}).items()
    ] + [c.alias(name) for name, c in (aggs or {}).items()]
    return df.groupBy(*keys).agg(*out)


def speed_stats(df: DataFrame, keys: Sequence[str], col: str, prefix: str = "speed") -> DataFrame:
    """Sum, count, maximum, mean and population deviation of a measure."""
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum(col), F.lit(0.0)).alias(f"{prefix}_sum"),
        F.count(F.lit(1)).alias(f"{prefix}_count"),
        F.max(col).alias(f"{prefix}_max"),
        F.avg(col).alias(f"{prefix}_avg"),
        F.stddev_pop(col).alias(f"{prefix}_std"),
    )


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in without
    ]


def sum_numeric(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Second-level sum of partial results; rows with a null key are left out.

    Without ``cols`` every numeric column that is not a key is summed.
    """
    cols = numeric_columns(df, keys) if cols is None else cols
    return daily_agg(df.dropna(subset=list(keys)), keys, sums={c: c for c in cols})


def crosstab(
    df: DataFrame, keys: Sequence[str], code_col: str, codes: Mapping[object, str]
) -> DataFrame:
    """Counts per listed code with a fixed schema.

    Rows with a null key or null code are left out; a group that has only other
    codes stays with zeros. Conditional counts need one shuffle where a pivot
    needs two.
    """
    clean = df.dropna(subset=[*keys, code_col])
    return code_counts(clean, keys, {code_col: codes})
