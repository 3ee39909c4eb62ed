"""Fill-in-middle texts over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fill_in_middle
from .registry import query, table


@query(
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
    h AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
                 ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
    c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM h),
    f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
                 array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM f
    """
)
def op12_fill_in_middle(spark, sf_dir):
    rows = fill_in_middle.rearrange(table(spark, sf_dir, "documents"), "doc_id", "text", ["doc_id"])
    restored = fill_in_middle.restore("output", "form")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))
