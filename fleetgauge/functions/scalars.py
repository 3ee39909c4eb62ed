"""Column expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .codes import (
    BRAKE_STATUSES,
    BRAKE_WARNING_TYPE,
    INACTIVE_WARNING,
    WARNING_TYPES,
)

__all__ = [
    "all_of",
    "any_null",
    "as_text",
    "compact_date",
    "contains_flag",
    "days_between",
    "digit_parity",
    "epoch_to_day",
    "exclude",
    "flag",
    "has_text",
    "nan_to_null",
    "normalise_ids",
    "one_hot",
    "open_range",
    "pick_class",
    "prefix_flag",
    "ratio",
    "round_to",
    "scale_units",
    "to_number",
    "valid_alarm",
    "warning_class",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_null(cols: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in cols], F.lit(False))


# ---- time ---------------------------------------------------------------


def epoch_to_day(seconds: Column | str, day_tz: str = "UTC") -> Column:
    """Calendar day of an epoch-second value in ``day_tz``.

    Works on zone-less timestamps, so the session time zone does not matter.
    """
    s = _col(seconds)
    if day_tz == "UTC":
        return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s / 86400).cast("int"))
    zero = F.lit(0)
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, s.cast("decimal(18,6)")
    )
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(day_tz), moment))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole days from ``earlier`` to ``later``; null if either is null."""
    return F.datediff(_col(later), _col(earlier))


# ---- text and identifiers ------------------------------------------------


def normalise_ids(df: DataFrame, *cols: str) -> DataFrame:
    """Turn identifier columns into text that joins: 12 and 12.0 become '12', null stays null."""
    out = {}
    for name in cols:
        kind, c = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.FractionalType):
            whole = c.try_cast("bigint")
            out[name] = F.when(whole == c, whole.cast("string")).otherwise(c.cast("string"))
        else:
            out[name] = c.cast("string")
    return df.withColumns(out)


def as_text(df: DataFrame, col: str) -> Column:
    """Text of a mixed-type code column; whole numbers lose their '.0'."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, T.FractionalType):
        whole = c.try_cast("bigint")
        return F.when(whole == c, whole.cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def prefix_flag(col: Column | str, prefix: str) -> Column:
    return F.coalesce(_col(col).startswith(prefix), F.lit(False)).cast("int")


# Text that cannot be a number or a date is sorted out by pattern before the cast:
# a cast that fails raises and catches an exception per row inside Spark, which
# costs far more than the match.
_WHOLE = r"^\s*[+-]?[0-9]+(\.0*)?\s*$"
_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_COMPACT_DAY = r"^[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$"


def to_number(df: DataFrame, col: str, kind: str = "int") -> Column:
    """Number of a column that may hold text; null where the text is not one.

    Decimal text of a whole number, such as '1.0', is that whole number.
    """
    c = F.col(col)
    if not isinstance(df.schema[col].dataType, T.StringType):
        return c.try_cast(kind)
    if kind in ("double", "float"):
        return F.when(c.rlike(_DECIMAL), c).try_cast(kind)
    return F.when(c.rlike(_WHOLE), F.regexp_extract(c, "[+-]?[0-9]+", 0)).try_cast(kind)


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN as null in the listed floating-point columns, or in all of them."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    chosen = [c for c in (kinds if cols is None else cols) if isinstance(kinds.get(c), (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in chosen}) if chosen else df


def digit_parity(col: Column | str, position: int) -> Column:
    """1 if the digit at ``position`` (from 1) is odd, 0 if even, null if it is no digit."""
    digit = F.substring(_col(col), position, 1)
    return F.when(digit.between("0", "9"), digit).try_cast("int") % 2


def compact_date(col: Column | str, position: int) -> Column:
    """Date written as yyyyMMdd inside a text; null when it is not a real date."""
    text = F.substring(_col(col), position, 8)
    return F.try_to_date(F.when(text.rlike(_COMPACT_DAY), text), "yyyyMMdd")


def contains_flag(col: Column | str, text: str) -> Column:
    """1 or 0 for containing ``text``; null stays null."""
    return _col(col).contains(text).cast("int")


def has_text(col: Column | str) -> Column:
    c = _col(col)
    return c.isNotNull() & (c.cast("string") != "")


# ---- predicates and branches ---------------------------------------------


def valid_alarm(status: Column | str, handled_at: Column | str) -> Column:
    """Not handled and without a handling time, or confirmed."""
    s, t = _col(status), _col(handled_at)
    return ((s == 0) & (t == 0)) | (s == 1)


def open_range(col: Column | str, low: float, high: float) -> Column:
    c = _col(col)
    return (c > low) & (c < high)


def exclude(df: DataFrame, listed: dict[str, Sequence]) -> DataFrame:
    """Drop rows whose column holds a listed value; rows with null are kept."""
    keep = [~F.coalesce(F.col(c).isin(*values), F.lit(False)) for c, values in listed.items()]
    return df.where(all_of(keep))


def flag(condition: Column) -> Column:
    """1 when the condition holds, else 0, also for unknown."""
    return F.when(condition, 1).otherwise(0)


def pick_class(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """First matching rule wins."""
    (condition, value), *rest = rules
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def warning_class(kind: Column | str, status: Column | str) -> Column:
    """Collision-warning class of text codes."""
    k, s = _col(kind), _col(status)
    rules = [(k == code, name) for code, name in WARNING_TYPES.items()]
    rules += [
        ((k == BRAKE_WARNING_TYPE) & (s == code), name) for code, name in BRAKE_STATUSES.items()
    ]
    return pick_class(rules, INACTIVE_WARNING)


# ---- arithmetic ------------------------------------------------------------


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Quotient that is null when the divisor is zero."""
    return F.try_divide(_col(part), _col(whole))


def scale_units(df: DataFrame, divisors: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.col(c) / F.lit(float(d)) for c, d in divisors.items()})


def round_to(col: Column | str, digits: int) -> Column:
    """Rounded value by plain arithmetic; the built-in goes through decimals for every row."""
    unit = F.lit(float(10**digits))
    return F.floor(_col(col) * unit + 0.5) / unit


def one_hot(df: DataFrame, col: str, categories: Sequence, keep: bool = False) -> DataFrame:
    """One 0/1 column per listed category, so the schema does not depend on the data."""
    out = df.withColumns({f"{col}_{v}": flag(F.col(col) == F.lit(v)) for v in categories})
    return out if keep else out.drop(col)
