import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import sampling


def test_label_noise_is_exact_and_repeatable(spark):
    df = spark.range(30).withColumn("y", (F.col("id") >= 25).cast("int"))

    def flipped():
        out = sampling.flip_labels(df, "id", "y", ratio=0.1).where("y = 1 and id < 25")
        return sorted(r.id for r in out.collect())

    first = flipped()
    assert len(first) == 2 and flipped() == first


@pytest.mark.parametrize("n, share", [(7, 0.2), (1000, 0.2), (5, 0.0), (5, 1.0), (0, 0.2)])
def test_split_is_exact(spark, n, share):
    out = sampling.hash_split(spark.range(n), "id", share)
    assert out.count() == n
    assert out.where("is_test = 1").count() == -(-int(n * share * 10) // 10)


def test_folds_are_stratified(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    sizes = sampling.stratified_folds(df, "id", "y").groupBy("y", "fold").count().collect()
    by = {(r.y, r.fold): r["count"] for r in sizes}
    assert sorted(by) == [(y, f) for y in (0, 1) for f in (0, 1, 2)]
    assert {by[0, f] for f in range(3)} == {300} and {by[1, f] for f in range(3)} <= {33, 34}


def test_cut_equals_a_global_ranking(spark, table):
    orders = table("orders").select("o_orderkey", "o_orderstatus")
    got = sampling.exact_cuts(orders, "o_orderkey", [lambda n: F.floor(n / 7), lambda n: F.floor(n / 2)], strata="o_orderstatus", seed=3)
    pdf = got.withColumn("h", sampling.hash_order("o_orderkey", 3)).toPandas()
    for _, g in pdf.groupby("o_orderstatus"):
        g = g.sort_values(["h", "o_orderkey"]).reset_index(drop=True)
        n = len(g)
        want = [int(i >= n // 7) + int(i >= n // 2) for i in range(n)]
        assert g.part.tolist() == want
