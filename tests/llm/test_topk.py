import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec string, lo long"


def brute(rows, k):
    """Scores of every query row with every other row, straight from the definition."""
    found = []
    for vec_id, vec in rows:
        if vec_id is not None and vec and not any(x is None or not np.isfinite(x) for x in vec):
            found.append((vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in vec]))
    out = []
    for n, (a, x) in enumerate(found):
        if a % 50 == 0:
            others = [r for m, r in enumerate(found) if m != n and len(r[1]) == len(x)]
            scored = sorted((-sum(i * j for i, j in zip(x, y, strict=True)), b) for b, y in others)
            out += [(a, m + 1, b, -s) for m, (s, b) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 0, "x", "y", 3) for i, v in rows], SCHEMA)
    got = topk.top_k(topk.quantise(df, "vec_id", "embedding"), F.col("id") % 50 == 0, k)
    return sorted(tuple(r) for r in got.collect())


def test_equals_brute_force_with_ties_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8).round(1)]) for i in range(0, 260)]
    rows += [(i, [0.5] * 8) for i in range(300, 420)]  # one very common vector
    rows += [(None, [0.1] * 8), (500, None), (550, [None] + [0.1] * 7), (600, [float("nan")] * 8), (650, [float("inf")] * 8), (700, [])]
    rows += [(0, [0.9] * 8), (50, rows[50][1]), (750, [0.2] * 3), (751, [0.7] * 3)]
    assert search(spark, rows) == brute(rows, 5)


def test_large_components_stay_exact(spark):
    rows = [(i, [3.0e4 * i + 1, -2.0e4 + i]) for i in range(0, 101)]
    assert search(spark, rows, 3) == brute(rows, 3)


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(None, None)], [(50, [1.0]), (51, [2.0])]])
def test_small_tables(spark, rows):
    assert search(spark, rows) == brute(rows, 5)


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 2]) for i in range(0, 300)]
    assert search(spark, rows) == brute(rows, 5)


def test_rows_of_one_id_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (7, [0.5, 0.5]), (7, [0.9, 0.9])]
    got = search(spark, rows, 3)
    assert got == brute(rows, 3) and len(got) == 9 and {r[2] for r in got} == {0, 7}


def test_scores_beyond_the_range_are_refused(spark):
    with pytest.raises(ValueError):
        search(spark, [(0, [1e8, 1e8]), (1, [1e8, 2.0])])


@pytest.mark.parametrize("scale", [1, 40, 40_000])  # products in single precision, in double, and beyond
def test_several_blocks_of_queries_and_strips(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "STRIP", (8, 32))
    monkeypatch.setattr(topk, "DENSE", 2)
    rng = np.random.default_rng(5)
    rows = [(i * (50 if i % 3 else 1), [float(x) * scale for x in rng.integers(-9, 10, 4) / 8]) for i in range(0, 240)]
    assert topk._block_counts(240, 160, 240 * 12, 160 * 12) == [12, 8]
    assert search(spark, rows) == brute(rows, 5)


def test_blocks_are_bounded_by_their_values():
    assert topk._block_counts(0, 0, 0, 0) == [1, 1]
    n, q, dim = 10_000_000, 200_000, 1000
    assert topk._block_counts(n, q, n * dim, q * dim) == [-(-n * dim // topk.BLOCK_VALUES), -(-q * dim // topk.BLOCK_VALUES)]


def test_no_vectors_are_broadcast(spark, monkeypatch, capsys):
    """Copies of the query blocks, one for each block of rows, would grow with the square of the table."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    plans, store = [], topk.hand_off

    def noted(df, label):
        plans.append(df)
        return store(df, label)

    monkeypatch.setattr(topk, "hand_off", noted)
    df = spark.createDataFrame([(i, [i % 7 / 8, i % 5 / 8], 0, "x", "y", 3) for i in range(400)], SCHEMA)
    plans.append(topk.top_k(topk.quantise(df, "vec_id", "embedding"), F.col("id") % 50 == 0))
    assert len(plans) > 2
    for plan in plans:
        plan.explain("formatted")
    sent = re.findall(r"BroadcastExchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert not {re.sub(r"#.*", "", x) for cols in sent for x in cols.split(", ")} - {"row", "query", "bin", "more", "above"}
