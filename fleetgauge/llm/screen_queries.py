"""Secret scans and benchmark decontamination over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, secret_ledger
from .registry import query, table
from .storage_queries import new_folder


def _sql_spans() -> str:
    """Spans of every rule: pieces between matches and the matches, added up."""
    out = []
    for k, r in enumerate(secret_ledger.RULES):
        p = r.pattern.replace("'", "''")
        out.append(f"""SELECT doc_id, row, {k} AS k, '{r.kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
            's': list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0)::BIGINT,
            'n': length(m[i]), 't': length(t[i])}})) AS x
          FROM (SELECT doc_id, row, regexp_extract_all(text, '{p}', 0) AS m, regexp_split_to_array(text, '{p}') AS g,
                       regexp_extract_all(text, '{p}', {r.group}) AS t FROM d) WHERE len(m) > 0""")
    least = " ".join(f"WHEN {k} THEN {r.least}" for k, r in enumerate(secret_ledger.RULES))
    return f"SELECT doc_id, row, k, kind, x.s AS s, x.s + x.n AS e FROM ({' UNION ALL '.join(out)}) WHERE x.t >= CASE k {least} END"


@query(
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents),
    f AS ({_sql_spans()}),
    g AS (SELECT row, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
                 string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base,
                 string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM f GROUP BY row)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (row)
    """
)
def op9_secret_ledger(spark, sf_dir):
    """Two increments into one ledger: the base rules on half of the documents, then all rules on all, where only unseen pairs are scanned."""
    docs, folder = table(spark, sf_dir, "documents"), new_folder(spark, "secrets")
    secret_ledger.scan(docs.where(F.col("doc_id") % 2 == 0), "doc_id", "text", folder, secret_ledger.BASE_RULES)
    found = secret_ledger.scan(docs, "doc_id", "text", folder)
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = [r.kind for r in secret_ledger.BASE_RULES]
    return found.select(
        F.col("path").alias("doc_id"), n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(secret_ledger.listing("spans", base), 256).alias("base_sha256"), secret_ledger.listing("spans").alias("spans"),
    )


@query()
def op10_template_decontamination(spark, sf_dir):
    """One row per document and benchmark item found in it; clean documents give none."""
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_matched", "n_windows", "changed")
