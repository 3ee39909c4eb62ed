import hashlib
import re

from pyspark.sql import functions as F

from fleetgauge.llm import secret_ledger
from fleetgauge.llm.secret_ledger import Rule, listing, redact, scan

RULES = [
    ("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32), ("pem", secret_ledger.ADDED_RULES[0].pattern, 0, 0), ("jwt", secret_ledger.ADDED_RULES[1].pattern, 0, 0),
]
TEXTS = [
    None, "", "é" * 50, 'Password: "abcdefgh" token=short secret = 12345678', "token=secret:abcdefgh1 token=secret=abcdefgh", "AKIAAKIA12345678 AKIA1234567890AB AKIAé",
    "éé " + "0123456789abcdef" * 2 + " 0123456789abcdef0123456789abcde api_key='" + "f" * 40 + "'", "API_KEY:" + "a" * 40, "PASSWD='x.y-z/1+2=3' passwd=1234567",
    "-----BEGIN RSA PRIVATE KEY----- eyJhbGciOi12.eyJzdWIiOi12.abcdefgh12", "token =\tabcdefghij", ("secret=abcdefgh12 " * 3000), "😀 token:abcdefgh😀",
]


def spans_of(text):
    text, found = text or "", []
    for k, (kind, pattern, group, least) in enumerate(RULES):
        found += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "b", 0) for i, t in rows], "doc_id long, text string, blob string, spans int")


def test_equals_brute_force(spark, tmp_path):
    rows = [*enumerate(TEXTS), (None, TEXTS[3]), (3, TEXTS[3]), (3, TEXTS[5]), (99, TEXTS[3])]
    got = scan(frame(spark, rows), "doc_id", "text", str(tmp_path / "ledger")).collect()
    want = sorted((str(i), hashlib.sha256((t or "").encode()).hexdigest(), spans_of(t)) for i, t in rows)
    assert sorted((str(r.path), r.blob, [tuple(s) for s in r.spans]) for r in got) == want


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    first = [(k, f"token={'ab12' * k}") for k in range(3, 8)]
    scan(frame(spark, first), "doc_id", "text", folder, secret_ledger.BASE_RULES).collect()
    assert spark.read.parquet(folder).count() == 5
    # Old blobs at new paths and one new blob: one more row in the ledger.
    more = [(10 + k, t) for k, t in first] + [(50, "secret=abcdefgh"), (51, "secret=abcdefgh")]
    got = scan(frame(spark, more), "doc_id", "text", folder, secret_ledger.BASE_RULES).collect()
    assert spark.read.parquet(folder).count() == 6
    assert {r.path: [tuple(s) for s in r.spans] for r in got} == {i: spans_of(t) for i, t in more}
    # A new rule version is scanned for on every blob, and old findings of other rules stay.
    rules = [*secret_ledger.BASE_RULES, Rule("pair", "ab12ab", version=2)]
    got = scan(frame(spark, first), "doc_id", "text", folder, rules).collect()
    added = spark.read.parquet(folder).where(F.array_contains("rules", "pair/2"))
    assert added.count() == 5 and {tuple(r.rules) for r in added.collect()} == {("pair/2",)}
    assert all({s.kind for s in r.spans} >= {"assign", "pair"} for r in got if r.path > 3)


def test_empty_table(spark, tmp_path):
    assert scan(frame(spark, []), "doc_id", "text", str(tmp_path / "ledger")).collect() == []


def test_listing_and_redaction(spark):
    rows = [("é token=abcdefgh! x", [(2, 16, "assign")]), ("abcdef", [(0, 3, "a"), (1, 2, "b"), (2, 5, "c")]), ("same", []), ("", [])]
    df = spark.createDataFrame(rows, "text string, spans array<struct<start:long,end:long,kind:string>>")
    got = df.select(redact("text", "spans"), listing("spans"), listing("spans", ["b"])).collect()
    assert [tuple(r) for r in got] == [("é [secret]! x", "assign:2:16", ""), ("[secret]f", "a:0:3,b:1:2,c:2:5", "b:1:2"), ("same", "", ""), ("", "", "")]
