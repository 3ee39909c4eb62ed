"""The wide join: many dimensions onto one spine, behind a row-count gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from ..session import hand_off
from .layout import Layout, store_bucketed
from .skew import HOT_ROWS, key_counts, skew_join


class FanOutError(ValueError):
    """A join would multiply rows of the spine."""


@dataclass(frozen=True)
class Dim:
    """A table to join: ``on`` maps spine column to its own key column.

    ``unique`` states that the keys are unique by construction (a roll-up by
    exactly these keys), which saves the check. ``skewed`` spreads spine rows of
    hot keys. ``null_safe`` lets null keys match null keys.
    """

    name: str
    df: DataFrame
    on: Mapping[str, str] | Sequence[str]
    drop: Sequence[str] = field(default_factory=tuple)
    unique: bool = False
    skewed: bool = False
    null_safe: bool = False

    def keyed(self) -> tuple[list[str], DataFrame]:
        on = dict(self.on) if isinstance(self.on, Mapping) else {k: k for k in self.on}
        table = self.df.drop(*self.drop)
        taken = set(on.values())
        rest = [c for c in table.columns if c not in taken]
        return list(on), table.select(*[F.col(d).alias(s) for s, d in on.items()], *rest)


def null_safe_left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which a null key matches a null key."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in on})
    match = F.lit(True)
    for k in on:
        match = match & F.col(k).eqNullSafe(F.col(f"__right_{k}"))
    return left.join(renamed, match, "left").drop(*[f"__right_{k}" for k in on])


def fans_out(
    spine: DataFrame, dim: DataFrame, on: Sequence[str], *, null_safe: bool = False
) -> bool:
    """Whether a left join would give more rows than the spine has.

    Looks for repeated dimension keys first (keys only, one aggregation) and
    searches the spine for them only if there are any.
    """
    keys = dim.select(*on) if null_safe else dim.select(*on).dropna()
    repeated = keys.groupBy(*on).count().where("count > 1").drop("count")
    if repeated.isEmpty():
        return False
    if not null_safe:
        return not repeated.join(spine.select(*on), list(on), "left_semi").isEmpty()
    met = null_safe_left_join(repeated, spine.select(*on).distinct().withColumn("__met", F.lit(1)), on)
    return not met.where("__met = 1").isEmpty()


def may_be_hot(spine: DataFrame) -> bool:
    """Whether a key can have more rows than one task takes: the spine has more."""
    return spine.limit(HOT_ROWS + 1).count() > HOT_ROWS


def _checked(out: DataFrame, dim: Dim, gate: bool) -> tuple[list[str], DataFrame]:
    on, table = dim.keyed()
    if gate and not dim.unique and fans_out(out, table, on, null_safe=dim.null_safe):
        raise FanOutError(f"{dim.name}: repeated keys {on} would multiply rows")
    return on, table


def wide_join(
    spine: DataFrame,
    dims: Sequence[Dim],
    *,
    gate: bool = True,
    layout: Layout | None = None,
) -> DataFrame:
    """Left-join every dimension; refuse one that would multiply rows.

    A spine of no more rows than one task takes has no hot keys, so ``skewed`` is looked into only above that.

    With a ``layout`` the dimensions whose keys include those of the layout come last, whatever their place in the
    list: the spine, with what was joined before, is stored in buckets once, each of these dimensions too, and
    no join of them shuffles either side. Such a dimension cannot bring a key for one that needs a shuffle. The session
    is told that joins by more columns than the layout's may stay in its buckets (``CO_PARTITION``).
    """
    if layout is not None:
        return _join_in_buckets(spine, dims, gate, layout)
    out = spine
    small = not any(dim.skewed for dim in dims) or not may_be_hot(spine)
    counted: dict[tuple[str, ...], DataFrame] = {}
    for dim in dims:
        on, table = _checked(out, dim, gate)
        if dim.null_safe:
            out = null_safe_left_join(out, table, on)
        elif dim.skewed and not small:
            # Joins behind the gate keep every spine row once, so the spine itself
            # can be counted where it has the keys; once for each set of keys.
            counts = None
            if set(on) <= set(spine.columns):
                counts = counted.setdefault(tuple(sorted(on)), hand_off(key_counts(spine, on), "key-counts"))
            out = skew_join(out, table, on, counts=counts)
        else:
            out = out.join(table, on, "left")
    return out


# By default Spark shuffles both sides of a join unless they are partitioned by all of its columns.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def _join_in_buckets(spine: DataFrame, dims: Sequence[Dim], gate: bool, layout: Layout) -> DataFrame:
    within = [dim for dim in dims if layout.covers(dim.keyed()[0]) and not dim.null_safe]
    moving = [dim for dim in dims if dim not in within]
    known = set(spine.columns)
    for dim in [*moving, *within]:
        missing = set(dim.keyed()[0]) - known
        if missing:
            raise ValueError(f"{dim.name}: no table before it brings {sorted(missing)}; those joined in buckets come last")
        known |= set(dim.keyed()[1].columns)
    spine.sparkSession.conf.set(CO_PARTITION, "false")
    out = store_bucketed(wide_join(spine, moving, gate=gate), layout, "spine")
    for dim in within:
        on, table = _checked(out, dim, gate)
        wrong = [k for k in layout.keys if out.schema[k].dataType != table.schema[k].dataType]
        if wrong:  # other types hash to other buckets
            raise TypeError(f"{dim.name}: {wrong} differ in type from those of the spine")
        out = out.join(store_bucketed(table, layout, dim.name), on, "left")
    return out


def row_trace(spine: DataFrame, dims: Sequence[Dim]) -> DataFrame:
    """Row count of the spine and after each join: ``step, name, rows``.

    One chain of joins, in which each row carries how many rows it stands for after every step. A
    table is first counted by its keys and by those of its columns that later joins use, so repeated
    keys multiply a number and not rows.
    """
    wanted = {k for dim in dims for k in dim.keyed()[0]}
    out = spine.select(*[c for c in spine.columns if c in wanted], F.lit(1).cast("long").alias("__rows_0"))
    for step, dim in enumerate(dims, 1):
        on, table = dim.keyed()
        carried = [c for c in table.columns if c in wanted and c not in on and c not in out.columns]
        table = table.groupBy(*on, *carried).agg(F.count(F.lit(1)).alias("__n"))
        first = F.lit(1)
        if carried:  # of several rows per key, one stands for the steps before
            first = F.when(F.row_number().over(Window.partitionBy(*on).orderBy(*carried)) == 1, 1).otherwise(0)
        table = table.withColumn("__first", first)
        out = null_safe_left_join(out, table, on) if dim.null_safe else out.join(table, on, "left")
        before = {f"__rows_{k}": F.col(f"__rows_{k}") * F.coalesce("__first", F.lit(1)) for k in range(step)}
        now = F.col(f"__rows_{step - 1}") * F.coalesce("__n", F.lit(1))
        out = out.withColumns({**before, f"__rows_{step}": now}).drop("__n", "__first")
    names = ["spine", *[dim.name for dim in dims]]
    total = [F.struct(F.lit(k).alias("step"), F.lit(n).alias("name"), F.coalesce(F.sum(f"__rows_{k}"), F.lit(0)).alias("rows")) for k, n in enumerate(names)]
    return out.agg(F.array(*total).alias("lines")).select(F.inline("lines"))


def row_count_gate(spine: DataFrame, result: DataFrame) -> DataFrame:
    """Return ``result`` unless it has more rows than ``spine``."""
    before, after = spine.count(), result.count()
    if after > before:
        raise FanOutError(f"{after} rows from {before}")
    return result
