"""Host reputation by empirical Bayes, and explicit URL rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Some suffixes of two labels under which names are registered; callers bring their own list. Others have one label.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.jp", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "gov.uk", "org.uk"]


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


ADDRESS = r"^(\[.*|[0-9]{1,3}(\.[0-9]{1,3}){3})$"


def domain_and_suffix(host: str | Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """The registered domain and its suffix, without user, port and a last dot; a host without a dot, and an address, is both.

    ``suffixes`` are those of two labels.
    """
    name = F.regexp_replace(host, r"^.*@|\.?(:[0-9]*)?$", "")
    labels = F.split(name, r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    three = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".")
    wide, address = two.isin(list(suffixes)), name.rlike(ADDRESS)
    domain = F.when(address, name).when(wide, three).otherwise(two)
    return domain, F.when(address, name).when(wide, two).otherwise(F.element_at(labels, -1))


def rule_of(host: str, path: str, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest of ``(host, path, action)`` that fits, else nulls.

    A rule fits its host and all subdomains where the path starts with its path.
    """
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for at, start, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((F.col(host) == at) | F.col(host).endswith("." + at)) & F.col(path).startswith(start)
        rule, action = F.when(fits, at + start).otherwise(rule), F.when(fits, what).otherwise(action)
    return rule, action


def _strength(groups: DataFrame) -> DataFrame:
    """Pooled rate and prior strength of beta-binomial groups (x bad of n), by moments.

    The intraclass correlation compares the spread between groups with what chance
    gives; it is held between 0.001 and 0.5, so the prior weighs 1 to 999 outcomes, and 1 where the spread cannot be told.
    Terms are rounded to whole millionths, so sums do not depend on their order.
    """
    seen = groups.where("n > 0")
    s = seen.agg(
        F.count("*").alias("g"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"),
        F.coalesce(F.sum("x"), F.lit(0)).cast("double").alias("x"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        F.sum(F.floor(F.col("x").cast("double") * F.col("x") * 1e6 / F.col("n") + 0.5).cast("double")).alias("xx"),
    )
    p = F.expr("(x + 1) / (n + 2)")
    between = F.expr("xx / 1e6 - x * x / n")
    free = F.expr("n - nn / n - (g - 1)")
    corr = F.when((F.col("n") > 0) & (free > 0), (between / (p * (1 - p)) - F.col("g") + 1) / free)
    held = F.least(F.greatest(F.coalesce(corr, F.lit(0.5)), F.lit(0.001)), F.lit(0.5))
    return s.select(p.alias("rate"), ((1 - held) / held).alias("strength"))


def host_reputation(
    pages: DataFrame, url_col: str, id_col: str, outcomes: DataFrame, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES
) -> DataFrame:
    """Posterior of each host's rate of bad pages: (host, n_labelled, n_bad, bad_rate, bad_sd).

    ``outcomes`` is (id, bad): 0 or 1 for pages with a label; null ids or outcomes are
    left out, and an id with several outcomes is bad if any is. Rates shrink from
    host to registered domain to suffix to the overall rate: at each level the
    posterior mean of the level above is the prior mean, and how many outcomes the
    prior weighs comes from the spread between the groups of that level. A host
    without labels takes its domain's rate. Urls without a host count as host ''.

    Page rows meet outcomes by id and are then counted per host with map-side
    combine, so a host with a third of all pages costs one row per task.
    """
    marks = outcomes.where("id IS NOT NULL AND bad IS NOT NULL").groupBy("id").agg(F.max("bad").alias("bad"))
    seen = pages.select(F.col(id_col).alias("id"), host_of(url_col).alias("host")).join(marks, "id", "left")
    hosts = seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("x"))
    domain, suffix = domain_and_suffix("host", suffixes)
    hosts = hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "x")
    total = [F.sum("n").alias("n"), F.sum("x").alias("x")]
    domains = hosts.groupBy("domain", "suffix").agg(*total)
    tops = domains.groupBy("suffix").agg(*total)
    k_suffix, k_domain, k_host = ((_strength(x).alias(a)) for x, a in ((tops, "ks"), (domains, "kd"), (hosts, "kh")))
    mean_s = F.expr("(x + ks.strength * ks.rate) / (n + ks.strength)")
    mean_d = F.expr("(x + kd.strength * prior) / (n + kd.strength)")
    one_row = F.lit(1)  # each strength is a single row
    tops = tops.withColumn("one", one_row).join(F.broadcast(k_suffix.withColumn("one", one_row).alias("ks")), "one")
    tops = tops.select("suffix", mean_s.alias("prior"))
    domains = domains.join(tops, "suffix").withColumn("one", one_row)
    domains = domains.join(F.broadcast(k_domain.withColumn("one", one_row).alias("kd")), "one").select("domain", "suffix", mean_d.alias("prior"))
    hosts = hosts.join(domains, ["domain", "suffix"]).withColumn("one", one_row)
    hosts = hosts.join(F.broadcast(k_host.withColumn("one", one_row).alias("kh")), "one")
    rate = F.expr("(x + kh.strength * prior) / (n + kh.strength)")
    return hosts.select("host", F.col("n").alias("n_labelled"), F.col("x").alias("n_bad"), rate.alias("bad_rate"), (F.col("n") + F.col("kh.strength") + 1).alias("weight")).select(
        "host", "n_labelled", "n_bad", "bad_rate", F.sqrt(F.expr("bad_rate * (1 - bad_rate) / weight")).alias("bad_sd")
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    max_bad: float = 0.3,
    z: float = 1.645,
    suffixes: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict and the host's posterior.

    A rule that fits decides. Otherwise a page is blocked where its host's rate of bad
    pages exceeds ``max_bad`` with the confidence of ``z`` standard deviations of
    the posterior, and allowed where it does not. Null and malformed urls have empty
    host and path; repeated rows are judged each; other columns are not looked at.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    known = host_reputation(pages, url_col, id_col, outcomes, suffixes)
    rule, action = rule_of("host", "path", rules)
    sure = F.col("bad_rate") - z * F.col("bad_sd") > max_bad
    return rows.join(known, "host", "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(action, F.when(sure, "block").otherwise("allow")).alias("verdict"),
        "n_labelled",
        "n_bad",
        F.round("bad_rate", 4).alias("bad_rate"),
    )
