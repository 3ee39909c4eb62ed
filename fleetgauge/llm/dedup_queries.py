"""Deduplication over the test tables. The tests compare both with brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import order_minhash, substring_dedup
from .registry import query, table


@query()
def op1_suffix_array_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text", least=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op2_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
