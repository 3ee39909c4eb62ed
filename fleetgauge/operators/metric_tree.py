"""A tree of cells around vantage points, built level by level over the cluster.

A cell that holds too many rows is split around a few of its own rows: each row goes to the nearest. What
is known of a cell is its vantage point, the radius about it and the number of rows. By the triangle inequality these rule out
most pairs of cells far apart, from the top of the tree down, so the pairs of leaves are never all looked at
unless none can be ruled out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import hand_off
from .sampling import hash_order
from .skew import MOST_LISTED

# Vantage points of a cell that is split, and how many of its rows they are chosen among.
FAN = 16
CHOICE = 4
# Rows that a task compares with the vantage points of a cell at a time, where leaves are smaller.
PART_ROWS = 4_096
# Splits of splits; cells that are still too large then, such as copies of one row, are cut by hash.
MOST_LEVELS = 12
# Room for rounding in distances that bounds are made of.
SLACK = 1e-9
CELL = ["__class", "__cell"]


def _listed(table: DataFrame) -> DataFrame:
    """``table`` for a join by cell, broadcast if it has few rows."""
    return F.broadcast(table) if table.limit(MOST_LISTED + 1).count() <= MOST_LISTED else table


def _splitter(fan: int):
    # Everything a task needs is defined inside, so workers need no copy of this package.
    def apart(points: np.ndarray) -> list[int]:
        """Up to ``fan`` of the points, each as far as can be from those before it; no point twice."""
        chosen, gaps = [0], np.sqrt(((points - points[0]) ** 2).sum(axis=1))
        while len(chosen) < fan and gaps.max() > 0:
            chosen.append(int(gaps.argmax()))
            gaps = np.minimum(gaps, np.sqrt(((points - points[chosen[-1]]) ** 2).sum(axis=1)))
        return chosen

    def split(rows: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        columns = ["__class", "__id", "__x", "__cell", "__away"]
        if not len(rows):
            return pd.DataFrame({c: [] for c in columns}, dtype=object)  # empty numbers do not pass for arrays or text
        points = points.sort_values("__rank")
        p = np.stack(points["__p"].to_numpy()).astype("float64")
        chosen = apart(p)  # the same in every part of the cell
        p, names = p[chosen], ("/" + points["__rank"].astype(str)).to_numpy()[chosen]
        x = np.stack(rows["__x"].to_numpy()).astype("float64")
        step = max(1, (1 << 21) // p.size)  # 16 MB of differences at once
        gaps = np.concatenate([np.sqrt(((x[s : s + step, None, :] - p[None]) ** 2).sum(axis=2)) for s in range(0, len(x), step)])
        cell = rows["__cell"].to_numpy() + names[gaps.argmin(axis=1)]
        return pd.DataFrame(dict(zip(columns, (rows["__class"], rows["__id"], rows["__x"], cell, gaps.min(axis=1)), strict=True)))

    return split


@dataclass(frozen=True)
class Tree:
    """``rows``: __class, __id, __x, __cell (the leaf) and __away (from its vantage point).

    ``levels``: a table of the nodes of each level: __class, __cell, __p (vantage point), n, radius, leaf. Level 0 has one
    node per class, without a vantage point; a leaf stands in the level it was made in.
    """

    rows: DataFrame
    levels: list[DataFrame]

    @property
    def leaves(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [level.where("leaf") for level in self.levels])


def build(rows: DataFrame, cell_rows: int, *, part_rows: int | None = None, fan: int = FAN, seed: int = 42) -> Tree:
    """The tree of stored ``rows`` (__class, __id, __x), with at most ``cell_rows`` rows in a leaf.

    A level is one shuffle of the rows that are still in large cells, in groups of about ``part_rows`` of a cell, by default
    ``cell_rows``. Leaves keep more rows only where vantage points cannot part them, or after ``MOST_LEVELS``.
    """
    part_rows = cell_rows if part_rows is None else part_rows
    kind, id_kind = (rows.schema[c].dataType.simpleString() for c in ("__class", "__id"))
    schema = f"__class {kind}, __id {id_kind}, __x array<double>, __cell string, __away double"
    whole = rows.withColumns({"__cell": F.lit(""), "__away": F.lit(0.0)})
    top = rows.groupBy("__class").agg(F.count(F.lit(1)).alias("n")).select(
        "__class", F.lit("").alias("__cell"), F.lit(None).cast("array<double>").alias("__p"), "n", F.lit(float("inf")).alias("radius"),
        (F.col("n") <= cell_rows).alias("leaf"),
    )
    levels = [hand_off(top, "cells")]
    settled, moving = [], whole
    while True:
        last = levels[-1]
        settled.append(moving.join(_listed(last.where("leaf").select(*CELL)), CELL, "left_semi"))
        large = last.where("NOT leaf")
        if large.isEmpty():
            break
        salts = F.ceil(F.col("n") / F.lit(part_rows)).cast("int").alias("__salts")
        large = _listed(hand_off(large.select(*CELL, salts, F.col("n").alias("__of")), "large-cells"))
        moving = moving.join(large, CELL)
        first = W.partitionBy(*CELL).orderBy(hash_order("__id", seed + len(levels)), "__id")
        points = moving.withColumn("__rank", F.row_number().over(first)).where(F.col("__rank") <= CHOICE * fan)
        points = hand_off(points.select(*CELL, "__rank", F.col("__x").alias("__p"), "__salts"), "vantage-points")
        spread = moving.withColumn("__salt", F.pmod(F.xxhash64(F.lit(seed), "__id"), F.col("__salts")).cast("int"))
        told = points.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
        unit = [*CELL, "__salt"]
        split = spread.select("__class", "__id", "__x", "__cell", "__salt").groupBy(*unit).cogroup(told.groupBy(*unit)).applyInPandas(_splitter(fan), schema)
        moving = hand_off(split, "cell-rows")
        made = moving.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"), F.max("__away").alias("radius"))
        above = made.withColumn("__up", F.regexp_replace("__cell", "/[0-9]+$", ""))
        above = above.join(large.withColumnRenamed("__cell", "__up"), ["__class", "__up"])
        named = points.select("__class", F.concat("__cell", F.lit("/"), "__rank").alias("__cell"), "__p")
        whole_leaf = (F.col("n") <= cell_rows) | (F.col("n") == F.col("__of")) | F.lit(len(levels) >= MOST_LEVELS)
        levels.append(hand_off(above.join(named, CELL).select(*CELL, "__p", "n", "radius", whole_leaf.alias("leaf")), "cells"))
    return Tree(reduce(DataFrame.unionByName, settled), levels)


def coarser(tree: Tree, cell_rows: int) -> Tree:
    """The top of the tree, down to the first nodes of at most ``cell_rows`` rows, which become its leaves.

    Its rows keep the leaf they had as ``__leaf``.
    """
    small = F.col("leaf") | (F.col("n") <= cell_rows)
    levels = [hand_off(tree.levels[0].withColumn("leaf", small), "cells")]
    for level in tree.levels[1:]:
        above = levels[-1].where("NOT leaf").select("__class", F.col("__cell").alias("__up"))
        if above.isEmpty():
            break
        below = level.withColumn("__up", F.regexp_replace("__cell", "/[0-9]+$", "")).join(_listed(above), ["__class", "__up"], "left_semi")
        levels.append(hand_off(below.drop("__up").withColumn("leaf", small), "cells"))
    rows = tree.rows.withColumn("__leaf", F.col("__cell"))
    if len(levels) == 1:
        return Tree(rows.withColumns({"__cell": F.lit(""), "__away": F.lit(0.0)}), levels)
    top = reduce(DataFrame.unionByName, [x.where("leaf").select(*CELL, "__p") for x in levels])
    steps = F.split("__cell", "/")
    upward = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    leaves = tree.leaves.select("__class", F.col("__cell").alias("__leaf"), F.explode(upward).alias("__cell"))
    named = hand_off(leaves.join(_listed(top), CELL), "cells-of-leaves")
    moved = rows.drop("__cell", "__away").join(_listed(named), ["__class", "__leaf"])
    return Tree(moved.withColumn("__away", F.coalesce(distance("__x", "__p"), F.lit(0.0))).drop("__p"), levels)


def distance(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance of two arrays; null if one is."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def leaf_pairs(tree: Tree, reach: DataFrame, k: int) -> DataFrame:
    """Pairs of different leaves (__class, q, c) in which a row of ``c`` may be among the ``k`` nearest of one of ``q``.

    ``reach`` (__class, __cell, reach): within that distance each row of the leaf has k neighbours, infinite if that is not known.
    Also given: ``least``, the distance that a row of ``c`` must at least have from the vantage point of ``c`` to matter.

    From level to level, pairs of nodes become pairs of their children. A pair goes when its nodes are further apart than
    what is known to be enough: the reach of the leaves below, or that some node of more than k rows lies wholly within.
    """
    # Of each node, the largest reach of the leaves below it.
    steps = F.split("__cell", "/")
    upward = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    below = reach.select("__class", F.explode(upward).alias("__cell"), "reach").groupBy(*CELL).agg(F.max("reach").alias("reach"))
    below = hand_off(below, "reach")
    pairs = tree.levels[0].where("NOT leaf").select("__class", F.col("__cell").alias("q"), F.col("__cell").alias("c"))
    open_pairs, done = pairs, []
    for level in tree.levels[1:]:
        nodes = hand_off(level.join(below, CELL).withColumn("__up", F.regexp_replace("__cell", "/[0-9]+$", "")), "nodes")
        # A leaf made earlier stands for itself in pairs with the nodes of this level.
        older = reduce(DataFrame.unionByName, [x.where("leaf") for x in tree.levels[: tree.levels.index(level)]]).join(below, CELL)
        nodes = hand_off(nodes.unionByName(older.withColumn("__up", F.col("__cell"))), "nodes")

        def side(s, nodes=nodes):
            return nodes.select("__class", F.col("__up").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("__cell", "__p", "n", "radius", "reach", "leaf")])

        met = open_pairs.join(side("q"), ["__class", "q"]).join(side("c"), ["__class", "c"])
        met = met.withColumn("gap", distance("q___p", "c___p"))
        met = hand_off(met.drop("q___p", "c___p", "q", "c"), "met")
        within = F.min(F.when(F.col("c_n") > k, F.col("gap") + F.col("q_radius") + F.col("c_radius")))
        bound = met.groupBy("__class", "q___cell").agg(F.least(F.max("q_reach"), F.coalesce(within, F.lit(float("inf")))).alias("bound"))
        kept = met.join(bound.withColumn("bound", F.col("bound") * (1 + SLACK) + SLACK), ["__class", "q___cell"])
        kept = kept.withColumn("least", F.col("gap") - F.col("q_radius") - F.col("bound")).where(F.col("least") <= F.col("c_radius"))
        kept = hand_off(kept.select("__class", F.col("q___cell").alias("q"), F.col("c___cell").alias("c"), "q_leaf", "c_leaf", "least"), "cell-pairs")
        done.append(kept.where("q_leaf AND c_leaf AND q <> c").select("__class", "q", "c", "least"))
        open_pairs = kept.where("NOT (q_leaf AND c_leaf)").select("__class", "q", "c")
    if not done:
        return pairs.withColumn("least", F.lit(0.0)).limit(0)
    return reduce(DataFrame.unionByName, done)
