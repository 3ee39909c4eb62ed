"""Exact top-k inner-product search by distributed histogram selection."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import hand_off

BLOCK_ROWS = 1024  # a block has as many rows at least, if there are as many
BLOCK_VALUES = 2**22  # and about as many values at most
PAIRS = 100  # of blocks; more if blocks would grow too large, fewer if too small
MOST_TASKS = 4096  # that pairs are dealt to
STRIP = 512, 4096  # queries and rows scored at a time
BINS = 512
DENSE = 32  # scores counted per query and strip from which on it pays to look which bins matter


def quantise(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, vec): every component x as ``floor(scale * x)``.

    Rows whose id or vector is null, or whose vector is empty or holds a null or
    non-finite component, take no part. An id may stand in several rows.
    """
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & (F.size(vec_col) > 0) & finite).select(
        F.col(id_col).alias("id"),
        F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vec"),
    )


def top_k(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """The ``k`` highest integer inner products of every query with all other rows.

    ``vectors`` is (id, vec) as ``quantise`` gives it, ``is_query`` a condition on
    ``id``. Returns (query_id, rank, id, score); equal scores go by the smaller id,
    and a query with fewer than k other rows of its length gets all of them.
    Vectors of unequal length have no inner product and do not meet. Rows that share an id, or are equal, are rows of their own: each
    is a candidate for all others, and each that is a query has its own result.

    Rows and queries are dealt to blocks, and each pair of a query block with a row block is
    a group of its own. Each pass scores every pair and counts the scores of each query in
    ``BINS`` bins of the interval that holds its k-th score; the counts of all groups
    together pick the bin for the next pass, until the k-th score is known exactly.
    A group leaves out bins below the one with its own k-th score: that of all rows is not lower.
    The last pass keeps higher scores and the smallest ids at the k-th score. No
    task sees more than two blocks and one histogram for each query of a strip, and
    however many rows tie, a group passes on at most k rows a query. Nothing is broadcast
    but what grows with the number of queries alone.

    Vectors so long that a score might pass 2**62 are refused.
    """
    # The number of a row is stored with it: it must be the same in every pass.
    vectors = hand_off(vectors.select("id", "vec").withColumn("row", F.monotonically_increasing_id()), "vectors")
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    sizes = vectors.agg(
        F.count("*").alias("n"),
        F.sum(F.when(is_query, 1)).alias("q"),
        F.sum(F.size("vec") + 8).alias("values"),
        F.sum(F.when(is_query, F.size("vec") + 8)).alias("q_values"),
        F.max(norm).alias("norm"),
    ).first()
    bound = int((sizes["norm"] or 0) * 1.000001) + 1
    if bound > 2**62:
        raise ValueError("inner products may pass the range of 64-bit integers")
    n_blocks, n_query_blocks = _block_counts(*(sizes[c] or 0 for c in ("n", "q", "values", "q_values")))
    n_pairs = n_blocks * n_query_blocks
    # No component is larger than the root of the largest product of a vector with itself.
    kind = "smallint" if bound < 2**30 else "int" if bound < 2**62 else "bigint"
    vectors = vectors.withColumn("vec", F.col("vec").cast(f"array<{kind}>"))

    def dealt(rows, count, first, last, step, *cols):
        """Every row once for each pair of blocks that its own is part of."""
        block = F.pmod(F.xxhash64("row"), F.lit(count))
        pairs = F.sequence(first(block), last(block), F.lit(step).cast("long"))
        each = rows.select(F.size("vec").alias("dim"), F.explode(pairs).alias("pair"), "row", "id", "vec", *cols)
        return each.repartition(min(n_pairs, MOST_TASKS), "dim", "pair").groupBy("dim", "pair")

    rows = dealt(vectors, n_blocks, lambda b: b, lambda b: b + (n_pairs - n_blocks), n_blocks)
    state = vectors.where(is_query).select(
        "row", "id", "vec", F.lit(-bound).cast("long").alias("lo"), F.lit(0).cast("long").alias("above")
    )
    span = 2 * bound + 1

    def paired(state, function, schema):
        queries = dealt(state, n_query_blocks, lambda b: b * n_blocks, lambda b: b * n_blocks + (n_blocks - 1), 1, "lo", "above")
        return queries.cogroup(rows).applyInArrow(function, schema)

    while span > 1:
        width = -(-span // BINS)
        counts = paired(state, _histograms(bound, span, width, k), "query bigint, bin int, n long")
        counts = counts.groupBy("query", "bin").agg(F.sum("n").alias("n"))
        higher = F.sum("n").over(Window.partitionBy("query").orderBy(F.desc("bin")))
        found = (
            counts.withColumn("upto", higher)
            .join(state.select(F.col("row").alias("query"), "above"), "query")
            .where((F.col("above") + F.col("upto") >= k) & (F.col("above") + F.col("upto") - F.col("n") < k))
            .select(F.col("query").alias("row"), "bin", (F.col("upto") - F.col("n")).alias("more"))
        )
        # A query with fewer than k other rows keeps the lowest bin: every score is then at or above it.
        state = hand_off(
            state.join(found, "row", "left").select(
                "row",
                "id",
                "vec",
                (F.col("lo") + F.coalesce("bin", F.lit(0)) * F.lit(width).cast("long")).alias("lo"),
                (F.col("above") + F.coalesce("more", F.lit(0))).alias("above"),
            ),
            "topk-state",
        )
        span = width
    hits = paired(state, _survivors(bound, k), "query long, query_id long, id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def _block_counts(n, q, values, q_values):
    """Into how many blocks rows and queries are dealt: for ``PAIRS`` pairs of which the fewest rows of both are copied, within the bounds of a block."""
    ideal = math.sqrt(PAIRS * n / q) if q else 1
    counts = []
    for found, wanted, held in ((n, ideal, values), (q, PAIRS / ideal, q_values)):
        counts.append(max(1, min(round(wanted), found // BLOCK_ROWS), math.ceil(held / BLOCK_VALUES)))
    return counts


def _strips(q, c, bound):
    """Strips of the queries of a pair of blocks: the place of the first, how many they are, and strips of their scores, each with the place
    of its first row; a row's score with itself is below all others."""
    q_vec, c_vec = _matrix(q, "vec"), _matrix(c, "vec")
    _, q_own, c_own = np.intersect1d(q["row"].to_numpy(), c["row"].to_numpy(), assume_unique=True, return_indices=True)
    if bound < 2**23:
        kind, lowest = np.float32, -np.inf  # products and sums are exact
    else:
        limit = float(np.abs(q_vec, dtype=np.float64).max()) * float(np.abs(c_vec, dtype=np.float64).max()) * q_vec.shape[1]
        kind, lowest = np.float64 if limit < 2**53 else object, np.iinfo(np.int64).min  # so they are here

    def scored(i, of):
        j, wide = 0, STRIP[1] // 32  # few rows at first: what they tell about the k-th score rules most of the others out
        while j < len(c_vec):
            scores = of @ c_vec[j : j + wide].T.astype(kind)
            if kind is not np.float32:
                scores = scores.astype(np.int64)
            own = (q_own >= i) & (q_own < i + len(of)) & (c_own >= j) & (c_own < j + wide)
            scores[q_own[own] - i, c_own[own] - j] = lowest
            yield j, scores
            j, wide = j + wide, min(2 * wide, STRIP[1])

    for i in range(0, len(q_vec), STRIP[0]):
        of = q_vec[i : i + STRIP[0]].astype(kind)
        yield i, len(of), scored(i, of)


def _at_least(scores, least):
    """Places and values of the scores that are ``least`` of their query or more."""
    at = np.flatnonzero(scores >= least.astype(scores.dtype)[:, None])
    return *np.divmod(at, scores.shape[1]), scores.ravel()[at].astype(np.int64)


def _matrix(table, name):
    return table[name].combine_chunks().flatten().to_numpy().reshape(len(table), -1)


def _histograms(bound, span, width, k):
    def run(q, c):
        rows, bins, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        if len(q) and len(c):
            q_rows, q_lo, q_above = (q[x].to_numpy() for x in ("row", "lo", "above"))
            for i, size, strips in _strips(q, c, bound):
                lo, need = q_lo[i : i + size], k - q_above[i : i + size]
                counts, lowest = np.zeros((size, BINS), np.int64), np.zeros(size, np.int64)
                for _, scores in strips:
                    row, _, score = _at_least(scores, lo + lowest * width)
                    offset = score - lo[row]
                    row, place = row[offset < span], offset[offset < span] // width
                    np.add.at(counts.reshape(-1), row * BINS + place, 1)
                    if len(row) > size * DENSE:
                        upto = counts[:, ::-1].cumsum(axis=1)
                        lowest = np.maximum((upto >= need[:, None]).sum(axis=1) - 1, 0)
                at = np.flatnonzero(counts)
                (row, place), found = np.divmod(at, BINS), counts.reshape(-1)[at]
                higher = np.append(found[::-1].cumsum()[::-1], 0)  # that many of this and later queries
                at = higher[1:] - higher[np.searchsorted(row, row, "right")] < need[row]
                rows.append(q_rows[i + row[at]])
                bins.append(place[at].astype(np.int32))
                n.append(found[at])
        return pa.table([pa.array(np.concatenate(x)) for x in (rows, bins, n)], names=["query", "bin", "n"])

    return run


def _survivors(bound, k):
    def best(row, found, score):
        order = np.lexsort((found, -score, row))
        row = row[order]
        return order[np.arange(len(row)) - np.searchsorted(row, row) < k]  # the place within the query, best first

    def run(q, c):
        kept = [(np.zeros(0, np.int64),) * 3]
        if len(q) and len(c):
            lo, c_ids = q["lo"].to_numpy(), c["id"].to_numpy()
            for i, size, strips in _strips(q, c, bound):
                for j, scores in strips:
                    row, col, score = _at_least(scores, lo[i : i + size])
                    found = c_ids[j + col]
                    order = best(row, found, score)
                    kept.append((i + row[order], found[order], score[order]))
        row, found, score = (np.concatenate(x) for x in zip(*kept, strict=True))
        order = best(row, found, score)
        row, q_ids = row[order], q["id"].to_numpy()
        return pa.table(
            [pa.array(x) for x in (q["row"].to_numpy()[row], q_ids[row], found[order], score[order])],
            names=["query", "query_id", "id", "score"],
        )

    return run
