"""Language identification over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import langid
from .registry import query, table


@query()
def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    network = langid.fit(docs.where(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    rows = langid.predict(docs, "text", network, ["doc_id"])
    return rows.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", F.round("score", 6).alias("score"))
