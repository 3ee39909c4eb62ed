"""Exact nearest neighbours within a class, and oversampling built on them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import hand_off
from .metric_tree import CELL, FAN, PART_ROWS, SLACK, build, coarser, distance, leaf_pairs
from .sampling import exact_cuts
from .skew import skew_join

# A block is what one task holds of each side, a tile the distances it works on at once. A Python worker needs about
# five blocks (both sides as they arrive and as matrices, and one copy) and three tiles: some 250 MB.
BLOCK_BYTES = 32 << 20
TILE_BYTES = 16 << 20
# Rows of a block at most, however narrow: a task measures their square if nothing can be ruled out.
BLOCK_ROWS = 16_384
# Rows of a leaf of the tree; a task rules out leaves of its block for queries taken so many together.
LEAF_ROWS = 256
QUERY_ROWS = 128
# Values a label may have.
MOST_CLASSES = 1_000


def _kernel(k: int):
    # Everything a task needs is defined inside, so workers need no copy of this package.
    def balls(x, starts):
        """Middle, radius and number of the rows that begin at each of ``starts``."""
        sizes = np.diff([*starts, len(x)])
        middle = np.add.reduceat(x, starts, axis=0) / sizes[:, None]
        away = np.sqrt(((x - np.repeat(middle, sizes, axis=0)) ** 2).sum(axis=1))
        return middle, np.maximum.reduceat(away, starts), sizes

    def measured(tile, block, q, c):
        step = max(1, TILE_BYTES // (8 * max(1, tile.shape[1])))
        parts = [np.sqrt(((block[c[s : s + step]] - tile[q[s : s + step]]) ** 2).sum(axis=1)) for s in range(0, len(q), step)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def rough(a, b):
        """Squared distances by a product of matrices, and how far off their rounding may be."""
        own, norms = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        return own[:, None] + norms[None, :] - 2.0 * (a @ b.T), 1e-9 * (1.0 + own[:, None] + norms.max())

    def numbered(ids, block_ids):
        """Both as whole numbers in the order of the ids, which compare faster than text; a number that is missing equals none."""
        codes, names = pd.factorize(np.concatenate([ids, block_ids]), sort=True)
        mine, theirs = codes[: len(ids)], codes[len(ids) :]
        return np.where(mine < 0, len(names) if ids.dtype == object else -1, mine), np.where(theirs < 0, len(names), theirs)

    def nearest(queries, mine, block, theirs):
        """The k nearest block rows of every query, itself left out: places of both, distance; ties go to the smaller id.

        A product of matrices finds who may be among the k nearest, with room for its rounding; only those are
        measured exactly.
        """
        rows = max(1, TILE_BYTES // (8 * len(block)))
        for start in range(0, len(queries), rows):
            tile = queries[start : start + rows]
            gaps, room = rough(tile, block)
            gaps[mine[start : start + rows, None] == theirs[None, :]] = np.inf
            kept = min(k, gaps.shape[1])
            limit = np.partition(gaps, kept - 1, axis=1)[:, kept - 1 : kept] + room
            q, c = np.nonzero((gaps <= limit) & np.isfinite(gaps))
            apart = measured(tile, block, q, c)
            order = np.lexsort((theirs[c], apart, q))
            q, c, apart = q[order], c[order], apart[order]
            first = np.arange(len(q)) - np.searchsorted(q, q) < k
            yield start + q[first], c[first], apart[first]

    def candidates(queries, mine, limits, block, theirs, cells, rows_of, needed):
        """Numbers of the cells in which a row may be among the k nearest of one of the queries.

        For each query no further than ``limits`` say, nor than the cells reach that hold ``needed`` rows: k besides the query; nor
        than the k-th row of the cells around the queries, if those are few.
        """
        middle, radius, sizes = cells
        gaps, room = rough(queries, middle)
        nearer, further = np.sqrt(np.maximum(gaps - room, 0.0)) - radius, np.sqrt(np.maximum(gaps + room, 0.0)) + radius
        order = np.argsort(further, axis=1)
        enough = np.cumsum(sizes[order], axis=1) >= needed
        within = np.take_along_axis(np.take_along_axis(further, order, axis=1), enough.argmax(axis=1)[:, None], axis=1)[:, 0]
        reach = np.minimum(limits, np.where(enough[:, -1], within, np.inf))
        slack = 1e-9 * (1.0 + further)
        # Nothing is ruled out where a distance is not a number.
        near = lambda: np.flatnonzero(~(nearer > reach[:, None] + slack).all(axis=0))
        kept, around = near(), rows_of(np.unique(gaps.argmin(axis=1)))
        if k <= len(around) <= sizes[kept].sum() // 2:
            gaps, room = rough(queries, block[around])
            gaps[mine[:, None] == theirs[None, around]] = np.inf
            within = np.sqrt(np.maximum(np.partition(gaps, k - 1, axis=1)[:, k - 1 : k] + room, 0.0))[:, 0]
            reach = np.minimum(reach, within)
            kept = near()
        return kept

    def search(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(block):
            queries, block = queries.sort_values("__leaf"), block.sort_values("__of__leaf")
            q = np.stack(queries["__x"].to_numpy()).astype("float64")
            b = np.stack(block["__of__x"].to_numpy()).astype("float64")
            q_ids, b_ids = queries["__id"].to_numpy(), block["__of__id"].to_numpy()
            limits, leaf = queries["__limit"].to_numpy(dtype="float64"), block["__of__leaf"].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
            cells = balls(b, starts)
            needed = k + block["__of__id"].value_counts(dropna=False).max()
            rows_of = lambda some: np.concatenate([np.arange(starts[i], starts[i] + cells[2][i]) for i in some])
            mine, theirs = numbered(q_ids, b_ids)
            for s in range(0, len(q), QUERY_ROWS):
                some = slice(s, s + QUERY_ROWS)
                kept = candidates(q[some], mine[some], limits[some], b, theirs, cells, rows_of, needed)
                if len(kept):
                    rows = rows_of(kept)
                    found += [(q_ids[some][i], b_ids[rows[c]], apart) for i, c, apart in nearest(q[some], mine[some], b[rows], theirs[rows])]
        if not found:
            return pd.DataFrame({"__id": [], "__nn": [], "distance": []}, dtype=object)  # empty numbers do not pass for text
        return pd.DataFrame({name: np.concatenate(part) for name, part in zip(("__id", "__nn", "distance"), zip(*found, strict=True), strict=True)})

    return search


def _asking(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each query with those pairs of its cell ``q`` whose cell ``c`` comes within its ``__limit``."""
    met = queries.withColumnRenamed("__cell", "q").join(pairs, ["__class", "q"])
    gap = distance("__x", "c_p") - F.col("c_radius")
    # Nothing is ruled out where the distance is not known, or not a number.
    return met.where(gap.isNull() | F.isnan(gap) | (gap <= F.col("__limit") * (1 + SLACK) + SLACK))


def _search(queries: DataFrame, candidates: DataFrame, pairs: DataFrame, k: int, seed: int) -> DataFrame:
    """__id, __nn, distance: the ``k`` best rows of each block of cell ``c`` for each query of cell ``q``.

    ``pairs``: __class, q, c, q_blocks, c_blocks, c_p and c_radius (vantage point of ``c`` and radius about it), least. Cells are cut into blocks by a hash of the identifier, so copies and
    crowded cells are cut as well; one task compares one block with one block, leaf by leaf.
    """
    id_kind = queries.schema["__id"].dataType.simpleString()
    part = F.xxhash64(F.lit(seed), F.col("__id"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    unit = ["__class", "q", "q_block", "c", "c_block"]
    asked = (
        _asking(queries, pairs)
        .withColumn("q_block", F.pmod(part, F.col("q_blocks")).cast("int"))
        .withColumn("c_block", every("c_blocks"))
        .select(*unit, "__id", "__x", "__leaf", "__limit")
    )
    blocks = (
        candidates.withColumnRenamed("__cell", "c").join(pairs, ["__class", "c"])
        .where(F.col("__away") >= F.col("least"))
        .withColumn("c_block", F.pmod(part, F.col("c_blocks")).cast("int"))
        .withColumn("q_block", every("q_blocks"))
        .select(*[F.col(c).alias(f"__of{c}") for c in (*unit, "__id", "__x", "__leaf")])
    )
    grouped = asked.groupBy(*unit).cogroup(blocks.groupBy(*[f"__of{c}" for c in unit]))
    return grouped.applyInPandas(_kernel(k), f"__id {id_kind}, __nn {id_kind}, distance double")


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = W.partitionBy("__id").orderBy("distance", "__nn")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def nearest_neighbours(
    df: DataFrame,
    ident: str,
    features: str,
    label: str,
    *,
    k: int = 5,
    block_rows: int | None = None,
    fan: int = FAN,
    seed: int = 42,
) -> DataFrame:
    """The ``k`` nearest rows of the same class: ``ident, label, rank, neighbour, distance``.

    Exact. Each class becomes a tree of cells of at most ``block_rows`` rows, by default ``LEAF_ROWS``. Tasks work on its
    largest cells of no more than ``BLOCK_ROWS`` rows and ``BLOCK_BYTES``, so their number does not grow with that of the leaves; within
    a task leaves are ruled out. The search begins in the own cell; how far its k-th row is then bounds which other cells can hold a nearer
    one; only those are searched, each for the rows it may be near enough to. A task passes on only ``k`` rows per query; the k best of those are the result. Rows without a
    class or without features take no part; identifiers must be distinct.
    """
    rows = df.select(
        F.col(label).alias("__class"),
        F.col(ident).alias("__id"),
        F.col(features).cast("array<double>").alias("__x"),
    ).where(F.col("__class").isNotNull() & F.col("__x").isNotNull())
    rows = hand_off(rows, "points")
    width = rows.agg(F.max(F.size("__x"))).first()[0] or 1
    task_rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))
    leaf_rows = min(LEAF_ROWS, task_rows) if block_rows is None else block_rows
    tree = build(rows, leaf_rows, part_rows=max(leaf_rows, min(PART_ROWS, task_rows)), fan=fan, seed=seed)
    units = coarser(tree, task_rows)
    placed = hand_off(units.rows, "placed") if len(tree.levels) > 1 else units.rows
    blocks = F.ceil(F.col("n") / F.lit(task_rows)).cast("int")
    cells = hand_off(units.leaves.select(*CELL, "__p", "radius", blocks.alias("blocks")), "leaves")
    own = cells.select(
        "__class", F.col("__cell").alias("q"), F.col("__cell").alias("c"), F.col("blocks").alias("q_blocks"), F.col("blocks").alias("c_blocks"),
        F.col("__p").alias("c_p"), F.col("radius").alias("c_radius"), F.lit(0.0).alias("least"),
    )
    found = _search(placed.withColumn("__limit", F.lit(float("inf"))), placed, own, k, seed)
    if len(units.levels) > 1:
        found = hand_off(_best(found, k).drop("rank"), "own-cell")
        known = found.groupBy("__id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("__limit"))
        asked = hand_off(placed.join(known, "__id", "left").fillna(float("inf"), ["__limit"]), "limits")
        reach = asked.groupBy(*CELL).agg(F.max("__limit").alias("reach"))
        pairs = leaf_pairs(units, reach, k)
        for side, more in (("q", []), ("c", [F.col("__p").alias("c_p"), F.col("radius").alias("c_radius")])):
            pairs = pairs.join(cells.select("__class", F.col("__cell").alias(side), F.col("blocks").alias(f"{side}_blocks"), *more), ["__class", side])
        found = found.unionByName(_search(asked, placed, hand_off(pairs, "leaf-pairs"), k, seed))
    return _best(found, k).select(F.col("__id").alias(ident), "rank", F.col("__nn").alias("neighbour"), "distance")


def _share(ident: str, copy: str, seed: int):
    """Number in [0, 1) from a hash, the same on every run and engine."""
    text = F.concat(F.lit(f"{seed}|"), F.col(ident).cast("string"), F.lit("|"), F.col(copy).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def smote(
    df: DataFrame,
    ident: str,
    features: str,
    label: str,
    *,
    k: int = 5,
    seed: int = 42,
    block_rows: int | None = None,
) -> DataFrame:
    """Oversample every class to the size of the largest: ``ident, label, features, synthetic``.

    Each row of a smaller class is the base of equally many new rows (one more
    for an exact share of them in hash order). A new row lies at a random place
    between its base and one of the base's ``k`` nearest neighbours. Identifiers
    become text; new rows are named after their base and copy number. A label of more than ``MOST_CLASSES``
    values is refused.
    """
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().limit(MOST_CLASSES + 1).collect()}
    if len(sizes) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} values: not a class")
    top = max(sizes.values(), default=0)
    small = {c: n for c, n in sizes.items() if c is not None and n < top}
    if any(n < 2 for n in small.values()):
        raise ValueError("a class with a single row has no neighbours")
    original = df.select(
        F.col(ident).cast("string").alias(ident),
        label,
        F.col(features).cast("array<double>").alias(features),
        F.lit(0).alias("synthetic"),
    )
    if not small:
        return original
    rows = df.where(F.col(label).isin(*small)).select(
        ident, label, F.col(features).cast("array<double>").alias(features)
    )
    rows = hand_off(rows, "minority")
    near = nearest_neighbours(rows, ident, features, label, k=k, block_rows=block_rows, seed=seed)
    # Copies are even over (base, rank) whatever row is a neighbour of many, so
    # the neighbour's values are fetched before copies are made.
    other = rows.select(F.col(ident).alias("neighbour"), F.col(features).alias("__y"))
    near = skew_join(hand_off(near, "neighbours"), other, ["neighbour"], "inner")
    near = hand_off(near.select(ident, "rank", "__y"), "neighbour-values")

    facts = df.sparkSession.createDataFrame(
        [(c, (top - n) // n, min(k, n - 1)) for c, n in small.items()],
        f"{label} {df.schema[label].dataType.simpleString()}, __each long, __near int",
    )
    placed = exact_cuts(
        rows, ident, [lambda n: F.pmod(F.lit(top) - n, n)], strata=label, seed=seed, output="__part"
    )
    bases = (
        placed.join(F.broadcast(facts), label)
        .withColumn("__copies", F.col("__each") + F.when(F.col("__part") == 0, 1).otherwise(0))
        .where("__copies > 0")
    )
    # Many copies of few rows are spread before they are made.
    step = F.lit(10_000)
    bases = bases.withColumn("__first", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"), step)))
    if max((top - n) // n for n in small.values()) > 10_000:
        bases = bases.repartition(ident, "__first")
    last = F.least(F.col("__copies"), F.col("__first") + step - 1)
    copies = (
        bases.withColumn("__copy", F.explode(F.sequence(F.col("__first"), last)))
        .withColumn("rank", (1 + F.floor(_share(ident, "__copy", seed) * F.col("__near"))).cast("int"))
        .withColumn("__u", _share(ident, "__copy", seed + 1))
        .select(ident, label, features, "__copy", "rank", "__u")
    )
    between = F.zip_with(features, "__y", lambda x, y: x + F.col("__u") * (y - x))
    new = (
        copies.join(near, [ident, "rank"])
        .select(
            F.concat(F.col(ident).cast("string"), F.lit("#"), F.col("__copy").cast("string")).alias(ident),
            label,
            between.alias(features),
            F.lit(1).alias("synthetic"),
        )
    )
    return original.unionByName(new)
