"""Time-series operators on a daily panel: one row per key and calendar day.

With unique (key, day) rows a key owns at most one row per calendar day, so a
window over one key is bounded by the calendar however the raw events are spread.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

ROLLING_FUNCS = ("mean", "sum", "count", "max", "min", "std")


def key_days(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Distinct (key, day) pairs; rows with a null in either are left out."""
    return df.select(*keys, F.to_date(F.col(day)).alias(day)).dropna().distinct()


def streak_before(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    *,
    output: str = "streak_before",
    on_panel: bool = False,
) -> DataFrame:
    """Per key and event day: length of the unbroken run of event days up to the day before.

    A run starts where the previous event day is not yesterday; the streak is the
    distance to the start of the run. Both steps share one sort. Events are first
    reduced to distinct days; with ``on_panel`` the rows of ``df`` already are
    one per key and day, and get the streak as a further column.
    """
    days = df.dropna(subset=[*keys, day]) if on_panel else key_days(df, keys, day)
    w = W.partitionBy(*keys).orderBy(day)
    gap = F.datediff(F.col(day), F.lag(day).over(w))
    starts = F.when(F.coalesce(gap, F.lit(0)) != 1, F.col(day))
    run_start = F.last("__start", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    return (
        days.withColumn("__start", starts)
        .withColumn(output, F.datediff(F.col(day), run_start))
        .drop("__start")
    )


def densify_days(
    df: DataFrame, keys: Sequence[str], day: str, *, output: str = "present"
) -> DataFrame:
    """Every calendar day between a key's first and last event day, flagged 1 or 0.

    Each event day opens the span up to the next one, so no calendar join is needed.
    """
    nxt = F.lead(day).over(W.partitionBy(*keys).orderBy(day))
    until = F.coalesce(F.date_sub(nxt, 1), F.col(day))
    return (
        key_days(df, keys, day)
        .withColumn("__until", until)
        .select(*keys, F.posexplode(F.sequence(F.col(day), F.col("__until"))).alias("__pos", day))
        .withColumn(output, F.when(F.col("__pos") == 0, 1).otherwise(0))
        .drop("__pos")
    )


def runs(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    col: str,
    *,
    number: str = "run",
    total: str = "run_total",
) -> DataFrame:
    """Number the runs of equal values in day order and sum the values within each run."""
    w = W.partitionBy(*keys).orderBy(day)
    changed = ~F.lag(col).over(w).eqNullSafe(F.col(col)) | (F.row_number().over(w) == 1)
    running = w.rowsBetween(W.unboundedPreceding, 0)
    numbered = df.withColumn("__new", changed.cast("int")).withColumn(
        number, F.sum("__new").over(running)
    )
    in_run = W.partitionBy(*keys, number).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    return numbered.withColumn(total, F.sum(col).over(in_run)).drop("__new")


def rolling_name(col: str, days: int, func: str) -> str:
    return f"{col}_{days}d_{func}"


def _rolling_value(x: Column, func: str, w, exclude_current: bool) -> Column:
    n, total = F.count(x).over(w), F.sum(x).over(w)
    others = {
        "mean": (total - x) / (n - 1),
        "sum": total - x,
        "count": n - 1,
    }
    if exclude_current and func in others:
        return F.when(n > 1, others[func])
    plain = {
        "mean": F.avg,
        "sum": F.sum,
        "count": F.count,
        "max": F.max,
        "min": F.min,
        "std": F.stddev_samp,
    }
    return plain[func](x).over(w)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    wanted: Mapping[str, Sequence[str]] | Sequence[str],
    funcs: Sequence[str] | None = None,
    *,
    days: int = 7,
    exclude_current: bool = True,
    check_unique: bool = True,
) -> DataFrame:
    """Statistics over the last ``days`` calendar days up to and including today.

    ``wanted`` maps a column to its functions, or lists columns that all get
    ``funcs``. With ``exclude_current`` today's value is taken out of mean, sum
    and count, which are null when at most one value is in the frame or today's
    value is null; maximum, minimum and deviation always include today. All
    outputs share one sort. Rows with a null key or day are left out. The panel
    must hold one row per key and day; a second one raises.
    """
    if not isinstance(wanted, Mapping):
        wanted = {c: funcs or ("mean",) for c in wanted}
    asked = {f for fs in wanted.values() for f in fs}
    if not asked <= set(ROLLING_FUNCS):
        raise ValueError(f"unknown functions {sorted(asked - set(ROLLING_FUNCS))}; known: {ROLLING_FUNCS}")
    # a range of days needs a number to order by
    ordered = W.partitionBy(*keys).orderBy(F.unix_date(F.to_date(F.col(day))))
    frame = ordered.rangeBetween(-(days - 1), 0)
    twice = F.count(F.lit(1)).over(ordered.rangeBetween(0, 0)) > 1
    message = F.lit(f"rolling: more than one row per ({', '.join(keys)}, {day})")

    def guarded(value: Column) -> Column:
        return F.when(twice, F.raise_error(message)).otherwise(value) if check_unique else value

    return df.dropna(subset=[*keys, day]).select(
        "*",
        *[
            guarded(_rolling_value(F.col(c), f, frame, exclude_current)).alias(
                rolling_name(c, days, f)
            )
            for c, fs in wanted.items()
            for f in fs
        ],
    )
