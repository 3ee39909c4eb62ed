"""Incremental secret scans over a ledger of blobs, with DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its matches, leftmost and non-overlapping, of which ``least`` characters of ``group`` are needed."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}/{self.version}"


# Fixed values. A run of a class of at least n characters is the same as the run, kept where it is that long.
BASE_RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
]
ADDED_RULES = [
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
RULES = BASE_RULES + ADDED_RULES
PIECES = "array<struct<rule:string,n:int,gap:int,match:int,kept:boolean>>"


def with_blob(versions: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """(path, text, blob): the blob of a content is its SHA-256; a null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return versions.select(F.col(path_col).alias("path"), text.alias("text"), F.sha2(text, 256).alias("blob"))


def _pieces(rule: Rule) -> Column:
    """For each match: the length of the text before it since the last one, and its own."""
    gaps = F.split("text", rule.pattern, -1)
    matches = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    joined = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"), tested.alias("tested"))
    pieces = F.transform(
        joined,
        lambda x, i: F.struct(
            F.lit(rule.id).alias("rule"), i.alias("n"), F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("match"),
            (F.length(x["tested"]) >= rule.least).alias("kept"),
        ),
    )
    due = F.col("due").isNull() | F.array_contains("due", rule.id)
    return F.when(due & F.col("text").rlike(rule.pattern), pieces).otherwise(F.array().cast(PIECES))


def read_ledger(spark, folder: str) -> DataFrame | None:
    """(blob, rules, spans) of all increments so far; None before the first."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan(versions: DataFrame, path_col: str, text_col: str, folder: str, rules: list[Rule] = RULES) -> DataFrame:
    """Scan what the ledger in ``folder`` has not seen, add it, and return the findings of all given versions.

    Each row of ``versions`` is one version of the content at a path. Only (blob, rule
    version) pairs that are not in the ledger are scanned, and each blob once, however many versions
    share it. Returns (path, blob, spans): one row per given row, spans as an array of
    (start, end, kind) in code points, end exclusive, by start and then rule order; empty where nothing was found.

    Null paths and repeated rows are kept; a null text is empty. A text's matches meet only
    with that text: they are placed by a window per blob and rule, so a text with very many
    matches needs no quadratic work.
    """
    spark = versions.sparkSession
    rows = with_blob(versions, path_col, text_col)
    keyed = rows.select("path", "blob")
    one = keyed.groupBy("blob").agg(F.min("path").alias("path"))
    ledger = read_ledger(spark, folder)
    wanted = [r.id for r in rules]
    if ledger is None:
        due = one.withColumn("due", F.lit(None).cast("array<string>"))
    else:
        seen = ledger.select("blob", F.explode("rules").alias("rule"))
        pairs = one.withColumn("rule", F.explode(F.array(*map(F.lit, wanted)))).join(seen, ["blob", "rule"], "left_anti")
        due = pairs.groupBy("blob").agg(F.first("path").alias("path"), F.collect_set("rule").alias("due"))
    unseen = rows.alias("r").join(
        due.alias("d"), (F.col("r.blob") == F.col("d.blob")) & F.col("r.path").eqNullSafe(F.col("d.path"))
    ).select("r.blob", "r.text", "d.due")
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.id), F.lit(i))])
    found = unseen.select("blob", "due", F.concat(*map(_pieces, rules)).alias("pieces"))
    # Rows that repeat both path and text carry the same blob; the group below keeps one of each piece.
    match = found.select("blob", F.explode("pieces").alias("m")).select("blob", "m.*").distinct()
    upto = F.sum(F.col("gap").cast("long") + F.col("match")).over(Window.partitionBy("blob", "rule").orderBy("n"))
    placed = match.withColumn("end", upto).where("kept").select(
        "blob", F.struct((F.col("end") - F.col("match")).alias("start"), order["rule"].alias("at"), "end", "rule").alias("s")
    )
    spans = placed.groupBy("blob").agg(F.array_sort(F.collect_list("s")).alias("s"))
    spans = spans.select(
        "blob", F.transform("s", lambda s: F.struct(s["start"], s["end"], F.split_part(s["rule"], F.lit("/"), F.lit(1)).alias("kind"), s["rule"].alias("rule"))).alias("spans")
    )
    scanned = F.coalesce("due", F.array(*map(F.lit, wanted)))
    due.select("blob", scanned.alias("rules")).join(spans, "blob", "left").write.mode("append").parquet(folder)

    # Spans may come from several increments; a blob is joined to all of its versions.
    all_spans = (
        spark.read.parquet(folder).where("spans IS NOT NULL").select("blob", F.explode("spans").alias("s"))
        .where(F.col("s.rule").isin(wanted)).select("blob", F.struct("s.start", order["s.rule"].alias("at"), "s.end", "s.kind").alias("s"))
        .groupBy("blob").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    )
    listed = F.transform(F.coalesce("spans", F.array()), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return keyed.join(all_spans, "blob", "left").select("path", "blob", listed.alias("spans"))


def listing(spans: Column | str, kinds: list[str] | None = None) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: str, spans: str, mark: str = "[secret]") -> Column:
    """The text with every maximal run of covered characters replaced by ``mark``; an empty list leaves it as it is."""
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done, s):
        gap = F.substring(F.col(text), (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        inside = s["start"] < done["at"]
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(inside, done["out"]).otherwise(F.concat(done["out"], gap, F.lit(mark))).alias("out"),
        )

    rest = lambda d: F.concat(d["out"], F.substring(F.col(text), (d["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(F.col(spans), state, step, rest)).otherwise(F.col(text))
