"""One schema for collections that differ in types, with the rows set aside that do not fit it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import nan_to_null
from .scan import union_all

# Whole numbers from narrow to wide, and what else widens to what.
WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
REASONS = "__reasons"


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text holds everything that is not nested."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    kinds = {type(a), type(b)}
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if kinds <= {T.DoubleType, T.FloatType, *map(type, WHOLE)}:
            return T.DoubleType()
        decimals = [_as_decimal(x) for x in (a, b)]
        if None in decimals:
            return T.DoubleType()
        scale = max(d.scale for d in decimals)
        whole = max(d.precision - d.scale for d in decimals)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if kinds <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return T.TimestampNTZType() if T.TimestampType not in kinds else T.TimestampType()
    if any(isinstance(x, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for x in (a, b)):
        raise TypeError(f"{a.simpleString()} and {b.simpleString()} have no common type")
    return T.StringType()


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(digits[type(kind)], 0) if type(kind) in digits else None


def common_schema(frames: Sequence[DataFrame], wanted: Mapping[str, str] | None = None) -> T.StructType:
    """Every column of any frame with the widest of its types; ``wanted`` states the type of some columns."""
    kinds: dict[str, T.DataType] = {}
    for f in (f for frame in frames for f in frame.schema.fields):
        try:
            kinds[f.name] = _wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
        except TypeError as error:
            raise TypeError(f"{f.name}: {error}") from None
    stated = {c: T.StructType.fromDDL(f"x {kind}")["x"].dataType for c, kind in (wanted or {}).items()}
    return T.StructType([T.StructField(c, stated.get(c, k)) for c, k in {**kinds, **stated}.items()])


def _read_as(c: Column, kind: T.DataType, target: T.DataType) -> Column:
    if kind == target:
        return c
    if isinstance(kind, T.StringType) and target in WHOLE:  # '7.0' is seven, '7.5' is not a whole number
        number = F.trim(c).try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number).try_cast(target)
    if isinstance(kind, T.StringType) and isinstance(target, T.NumericType):
        number = F.trim(c).try_cast(target)
        return F.when(~F.isnan(number.cast("double")), number)
    if isinstance(kind, T.FractionalType) and target in WHOLE:
        return F.when(c == F.floor(c), c).try_cast(target)
    if isinstance(kind, T.FractionalType) and isinstance(target, T.StringType):  # whole numbers lose their '.0'
        whole = c.try_cast("bigint")
        return F.when(whole == c, whole.cast("string")).otherwise(c.cast("string"))
    return c.try_cast(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` and ``REASONS``: for each value that its column's type cannot hold, why not.

    Columns that ``df`` lacks are null, which is no reason.
    """
    own = {f.name: f.dataType for f in df.schema.fields}
    typed, reasons = [], []
    for f in schema.fields:
        if f.name not in own:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`")
        read = _read_as(c, own[f.name], f.dataType)
        typed.append(read.alias(f.name))
        if own[f.name] != f.dataType:
            why = F.concat(F.lit(f"{f.name}: "), c.cast("string"), F.lit(f" is no {f.dataType.simpleString()}"))
            reasons.append(F.when(c.isNotNull() & read.isNull(), why))
    listed = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return df.select(*typed, listed.alias(REASONS))


def reconcile(
    frames: Mapping[str, DataFrame], wanted: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of all named ``frames`` in one schema.

    ``rows`` have the widest type of each column, or the type that ``wanted`` states. Rows with a value that its
    type cannot hold are in ``rejected`` instead: source, reasons, and the row as it came, as JSON text. Both are plans over the same
    scans; nothing is stored here.
    """
    clean = {name: nan_to_null(df) for name, df in frames.items()}
    schema = common_schema(list(clean.values()), wanted)
    good, bad = [], []
    for name, df in clean.items():
        read = conform(df.withColumn("__row", F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))), T.StructType([*schema.fields, T.StructField("__row", T.StringType())]))
        good.append(read.where(F.size(REASONS) == 0).drop(REASONS, "__row"))
        bad.append(read.where(F.size(REASONS) > 0).select(F.lit(name).alias("source"), F.col(REASONS).alias("reasons"), F.col("__row").alias("row")))
    return union_all(good), reduce(DataFrame.unionByName, bad)
