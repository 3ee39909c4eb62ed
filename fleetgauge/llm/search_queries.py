"""Exact search and URL filters over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import topk, urls
from .registry import query, table

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query(
    """
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS vec
               FROM embeddings
               WHERE vec_id IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec::DOUBLE[], c.vec::DOUBLE[]) AS BIGINT) AS score
          FROM v q JOIN v c ON q.r <> c.r AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0)
    SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                          vec_id, score FROM s) WHERE rank <= 5
    """
)
def op3_top_k(spark, sf_dir):
    vectors = topk.quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, F.col("id") % 50 == 0, k=5).withColumnRenamed("id", "vec_id")


def _level(name: str, of: str) -> str:
    return f"""{name} AS (SELECT *, (1 - held) / held AS strength FROM (SELECT *, least(greatest(coalesce(
        CASE WHEN n > 0 AND free > 0 THEN ((xx / 1e6 - x * x / n) / (rate * (1 - rate)) - g + 1) / free END, 0.5), 0.001), 0.5) AS held
      FROM (SELECT *, (x + 1) / (n + 2) AS rate, n - nn / n - (g - 1) AS free
        FROM (SELECT count(*) AS g, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(x), 0)::DOUBLE AS x, sum(n::DOUBLE * n) AS nn,
                     sum(floor(x::DOUBLE * x * 1e6::DOUBLE / n + 0.5::DOUBLE)) AS xx FROM {of} WHERE n > 0))))"""


@query(
    rf"""
    WITH marks AS (SELECT doc_id AS id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels
                   WHERE doc_id IS NOT NULL GROUP BY doc_id),
    rows AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    counted AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS x FROM rows LEFT JOIN marks ON id = page_id GROUP BY host),
    bare AS (SELECT *, regexp_replace(host, '^.*@|\.?(:[0-9]*)?$', '', 'g') AS bare FROM counted),
    split AS (SELECT *, CASE WHEN regexp_matches(bare, '{urls.ADDRESS}') THEN [bare] ELSE string_split(bare, '.') END AS parts FROM bare),
    named AS (SELECT *, array_to_string(parts[greatest(len(parts) - 1, 1):], '.') AS two,
                     array_to_string(parts[greatest(len(parts) - 2, 1):], '.') AS three FROM split),
    hosts AS (SELECT host, n, x, CASE WHEN two IN ({", ".join(f"'{s}'" for s in urls.TWO_LABEL_SUFFIXES)}) THEN three ELSE two END AS domain,
                     CASE WHEN two IN ({", ".join(f"'{s}'" for s in urls.TWO_LABEL_SUFFIXES)}) THEN two ELSE parts[len(parts)] END AS suffix FROM named),
    domains AS (SELECT domain, suffix, sum(n) AS n, sum(x) AS x FROM hosts GROUP BY domain, suffix),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM domains GROUP BY suffix),
    {_level("ks", "suffixes")}, {_level("kd", "domains")}, {_level("kh", "hosts")},
    s AS (SELECT suffix, (f.x + strength * rate) / (f.n + strength) AS prior FROM suffixes f, ks),
    d AS (SELECT domain, f.suffix, (f.x + strength * prior) / (f.n + strength) AS prior FROM domains f JOIN s USING (suffix), kd),
    h AS (SELECT host, f.n, f.x, (f.x + strength * prior) / (f.n + strength) AS m, f.n + strength + 1 AS weight
          FROM hosts f JOIN d USING (domain, suffix), kh),
    ruled AS (SELECT page_id, host, path, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM rows)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
               WHEN m - 1.645 * sqrt(m * (1 - m) / weight) > 0.3 THEN 'block' ELSE 'allow' END AS verdict,
           CAST(n AS BIGINT) AS n_labelled, CAST(x AS BIGINT) AS n_bad, round(m, 4) AS bad_rate
    FROM ruled JOIN h USING (host)
    """
)
def op4_host_reputation(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)
    outcomes = labels.select(F.col("doc_id").alias("id"), bad.alias("bad"))
    return urls.judge_urls(table(spark, sf_dir, "pages"), outcomes, URL_RULES)
