"""Archives and token files over the test tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..session import work_folder
from . import warc
from .registry import query, table


def new_folder(spark, label: str) -> str:
    return os.path.join(work_folder(spark), f"{label}-{uuid.uuid4().hex}")


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
    k AS (SELECT payload_digest, max(page_id) AS kept FROM h WHERE payload_bytes >= 1000 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, h.payload_digest, CASE WHEN kept IS DISTINCT FROM page_id AND kept IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN kept IS DISTINCT FROM page_id THEN kept END AS refers_to, NULL::VARCHAR AS problem
    FROM h LEFT JOIN k ON k.payload_digest = h.payload_digest
    """
)
def op8_warc(spark, sf_dir):
    """Responses are read with payloads and hashed anew; of revisits only headers are read."""
    warc.register(spark)
    folder = new_folder(spark, "warc")
    records = warc.to_records(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    records.write.format("warc").mode("append").save(folder)
    stored = spark.read.format("warc").load(folder).where("record_type = 'response'")
    again = spark.read.format("warc").option("payload", "false").load(folder).where("record_type = 'revisit'")
    page = lambda c: F.regexp_extract(c, "([0-9-]+)>$", 1)
    digest = F.substring("payload_digest", 6, 40)
    fresh = F.sha1(F.col("payload").cast("binary"))
    wrong = F.when(fresh != digest, "digest").when(F.octet_length("payload") != F.col("payload_length"), "length")
    rows = stored.select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), fresh.alias("payload_digest"),
        "record_type", "refers_to", wrong.alias("problem"),
    ).unionByName(
        again.select("record_id", F.col("payload_length").alias("payload_bytes"), digest.alias("payload_digest"),
                     "record_type", "refers_to", F.lit(None).cast("string").alias("problem"))
    )
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    return rows.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "problem")
