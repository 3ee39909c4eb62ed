"""Exact, repeatable cuts of a table in pseudo-random order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import hand_off

# Hexadecimal digits of the hash that choose a bucket, and those that each refinement adds: 65 536 buckets.
BUCKET_DIGITS = 4
# A bucket above this many rows is refined before its rows are ranked.
RANKED_ROWS = 200_000
HASH_DIGITS = 32
# Values a label may have; the cuts of each are sent to every executor.
MOST_STRATA = 10_000


def hash_order(ident: str, seed: int) -> Column:
    """Text that orders rows at random but the same way on every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(ident).cast("string")))


def exact_cuts(
    df: DataFrame,
    ident: str,
    cuts: Sequence[Callable[[Column], Column]],
    *,
    strata: str | None = None,
    seed: int = 42,
    output: str = "part",
) -> DataFrame:
    """Number the pieces between cut positions of the hash order, exactly.

    Each cut maps the row count (of the stratum) to a position; rows up to the
    first cut get 0, up to the second 1, and so on. ``ident`` must be unique.
    Nothing is ranked globally: a histogram of hash buckets (at most 65 536 rows
    per stratum) shows which bucket holds each position. A bucket above
    ``RANKED_ROWS`` rows is split by further digits of the hash, so that the rows ranked in
    one task do not grow with the table; the rows are then compared with the resulting
    thresholds. The table itself is not shuffled. ``strata`` is a label column; more than ``MOST_STRATA``
    values are refused.
    """
    by = [strata] if strata else []
    keyed = df.select(*by, F.col(ident).alias("__id"), hash_order(ident, seed).alias("__h"))
    hist = keyed.groupBy(*by, F.substring("__h", 1, BUCKET_DIGITS).alias("__b")).agg(F.count(F.lit(1)).alias("__rows"))
    position = F.array(
        *[
            F.struct(F.lit(i).alias("cut"), cut(F.col("__all")).cast("bigint").alias("at"))
            for i, cut in enumerate(cuts)
        ]
    )
    placed = hist.withColumn("__all", F.sum("__rows").over(W.partitionBy(*by)))
    placed = placed.withColumn("__to", F.sum("__rows").over(W.partitionBy(*by).orderBy("__b")))
    placed = placed.withColumn("__cut", F.explode(position)).withColumns({"cut": F.col("__cut.cut"), "__at": F.col("__cut.at")})

    def sought_of(counted):
        """Of running counts, the bucket that holds each position, and the place within."""
        inside = (F.col("__at") > F.col("__to") - F.col("__rows")) & (F.col("__at") <= F.col("__to"))
        need = (F.col("__at") - F.col("__to") + F.col("__rows")).alias("__need")
        named = [F.col(c).alias(f"__s_{c}") for c in by]
        return hand_off(counted.where(inside).select(*named, "cut", "__b", "__rows", need), "sought")

    def match_on(digits):
        match = F.substring("__h", 1, digits) == F.col("__b")
        for c in by:
            match = match & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
        return match

    sought, digits = sought_of(placed), BUCKET_DIGITS
    if strata and sought.limit(MOST_STRATA * len(cuts) + 1).count() > MOST_STRATA * len(cuts):
        raise ValueError(f"{strata} has more than {MOST_STRATA} values: not a label")
    while digits < HASH_DIGITS and (sought.agg(F.max("__rows")).first()[0] or 0) > RANKED_ROWS:
        finer = F.substring("__h", 1, digits + BUCKET_DIGITS)
        found = keyed.join(F.broadcast(sought.withColumnRenamed("__need", "__at").drop("__rows")), match_on(digits))
        hist = found.groupBy(*by, "cut", "__at", finer.alias("__b")).agg(F.count(F.lit(1)).alias("__rows"))
        running = W.partitionBy(*by, "cut").orderBy("__b")
        sought, digits = sought_of(hist.withColumn("__to", F.sum("__rows").over(running))), digits + BUCKET_DIGITS
    match = match_on(digits)
    in_bucket = W.partitionBy(*by, "cut").orderBy("__h", "__id")
    limits = (
        keyed.join(F.broadcast(sought), match)
        .withColumn("__rank", F.row_number().over(in_bucket))
        .where(F.col("__rank") == F.col("__need"))
        .groupBy(*by)
        .agg(
            *[
                F.max(F.when(F.col("cut") == i, F.struct("__h", "__id"))).alias(f"__limit_{i}")
                for i in range(len(cuts))
            ]
        )
    )
    me = F.struct(hash_order(ident, seed).alias("__h"), F.col(ident).alias("__id"))

    def beyond(limit):
        return F.when(limit.isNull() | (me > limit), 1).otherwise(0)

    if strata:
        limits = limits.withColumnRenamed(strata, "__stratum")
        placed = df.join(
            F.broadcast(limits), F.col(strata).eqNullSafe(F.col("__stratum")), "left"
        ).drop("__stratum")
        part = sum((beyond(F.col(f"__limit_{i}")) for i in range(len(cuts))), F.lit(0))
        return placed.withColumn(output, part).drop(*[f"__limit_{i}" for i in range(len(cuts))])
    placed = df.withColumn("__limits", limits.select(F.struct("*")).scalar())
    part = sum((beyond(F.col("__limits")[f"__limit_{i}"]) for i in range(len(cuts))), F.lit(0))
    return placed.withColumn(output, part).drop("__limits")


def flip_labels(
    df: DataFrame, ident: str, label: str, *, ratio: float = 0.3, seed: int = 42
) -> DataFrame:
    """Turn exactly ``int(n * ratio)`` of the n rows labelled 0 into 1."""
    placed = exact_cuts(
        df.withColumn("__zero", F.col(label) == 0),
        ident,
        [lambda n: F.floor(n * F.lit(float(ratio)))],
        strata="__zero",
        seed=seed,
        output="__part",
    )
    hit = F.col("__zero") & (F.col("__part") == 0)
    return placed.withColumn(
        label, F.when(hit, F.lit(1).cast(df.schema[label].dataType)).otherwise(F.col(label))
    ).drop("__zero", "__part")


def hash_split(
    df: DataFrame, ident: str, test_fraction: float = 0.2, *, seed: int = 42, output: str = "is_test"
) -> DataFrame:
    """Mark exactly ``ceil(n * test_fraction)`` rows as test rows (1), the others 0."""
    placed = exact_cuts(
        df, ident, [lambda n: F.ceil(n * F.lit(float(test_fraction)))], seed=seed, output="__part"
    )
    return placed.withColumn(output, F.when(F.col("__part") == 0, 1).otherwise(0)).drop("__part")


def stratified_folds(
    df: DataFrame, ident: str, label: str, *, folds: int = 3, seed: int = 42, output: str = "fold"
) -> DataFrame:
    """Fold number per row, with every label spread evenly over the folds."""
    cuts = [lambda n, i=i: F.floor(n * F.lit(i) / F.lit(folds)) for i in range(1, folds)]
    return exact_cuts(df, ident, cuts, strata=label, seed=seed, output=output)
