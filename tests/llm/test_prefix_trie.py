import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import conversation_queries, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """The contract, word for word: {conv: [(role, text)]}."""
    own = {}
    digest = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    clean = [(c, t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c is not None]
    for c, _, _, r, x in sorted(clean, key=lambda q: (q[0], q[1], q[2], digest(q[3], q[4]))):
        own.setdefault(c, []).append((r, x))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(sequences):
    nodes = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    found = []
    for p, convs in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        kids = lambda q: sum(len(x) == len(q) + 1 and x[: len(q)] == q for x in nodes)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(sequences[c]) == len(p)))
        found.append(
            (min(convs), len(p), min(nodes[p[:-1]]) if p else None, len(convs), kids(p), sum(kids(q) == 0 for q in under),
             sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in under if q), hashlib.sha256(ends.encode()).hexdigest())
        )
    return found


def same(rows, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def query_of(spark, monkeypatch, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(conversation_queries, "table", lambda *_: df)
    return conversation_queries.op11_prefix_trie(spark, "").collect()


def test_odd_conversations(spark, monkeypatch):
    rnd = random.Random(5)
    rows = []
    for c in [*range(0, 60), *range(-11, 0), 10**12, 995]:
        for t in range(rnd.choice([1, 1, 2, 3, 8, 12, 20])):
            rows.append((c, rnd.choice([t, t, t, None, 3]), rnd.choice(["user", "user", None]), rnd.choice(["a", "b", "é", "", None])))
    rows += rows[:30]  # repeated rows
    rows += [(None, 1, "user", "no conversation"), (200, None, None, None), (71, 0, "user", "x" * 200_000)]
    same(query_of(spark, monkeypatch, rows), brute(rebuilt(rows)))


def test_one_long_conversation_and_many_copies(spark, monkeypatch):
    """Sequences of up to 300 turns, one of them over several sorted parts; 400 copies that end at one node."""
    rnd = random.Random(6)
    long = [("user", rnd.choice("ab")) for _ in range(300)]
    rows = [(5000, t, *x) for t, x in enumerate(long)]
    rows += [(5005 + 5 * k, t, *x) for k in range(4) for t, x in enumerate(long[: 37 * k + 60] + [("user", "c")] * k)]
    rows += [(10_000 + 5 * k, t, "user", "hello") for k in range(400) for t in range(2)]
    monkeypatch.setattr(prefix_trie, "PART_BYTES", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same(query_of(spark, monkeypatch, rows), brute(rebuilt(rows)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_few_and_no_rows(spark, monkeypatch):
    assert query_of(spark, monkeypatch, []) == []
    assert query_of(spark, monkeypatch, [(None, 0, "user", "x")]) == []
    c = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)  # turnless: its base is absent
    rows = [(c, 0, "user", "x")]
    same(query_of(spark, monkeypatch, rows), brute(rebuilt(rows)))
    assert brute(rebuilt(rows))[0][1] == 0 and len(brute(rebuilt(rows))) == 1
    more = [(c, 0, "user", "x", 1, "y"), (0, 0, "user", "x", 2, "z")]
    same(query_of(spark, monkeypatch, more, SCHEMA + ", conv long, token string"), brute(rebuilt([r[:4] for r in more])))


@pytest.mark.parametrize("lengths", [[1, 2, 3, 4, 5, 6, 7, 8, 9], [16, 17, 31, 32, 33], [1], [64, 64, 63]])
def test_names_are_one_for_each_prefix(spark, lengths):
    rnd = random.Random(8)
    seqs = {c: [rnd.choice("ab" if c % 2 else "aaaaaab") for _ in range(n)] for c, n in enumerate(lengths * 3)}
    rows = [(c, len(s), p + 1, s[p], 1) for c, s in seqs.items() for p in range(len(s))]
    turns = spark.createDataFrame(rows, "conv long, n long, pos long, token string, n_bytes long").withColumn("token", F.encode("token", "utf-8"))
    got = prefix_trie.name_prefixes(turns, max(lengths)).collect()
    assert len(got) == len(rows)
    of = {(): bytes(prefix_trie.ROOT)} | {tuple(seqs[r.conv][: r.depth]): bytes(r.name) for r in got}
    assert len(set(of.values())) == len(of)
    for r in got:
        assert bytes(r.name) == of[tuple(seqs[r.conv][: r.depth])] and bytes(r.path[-1]) == of[tuple(seqs[r.conv][: r.depth - 1])]
        cuts, d = [], r.depth - 1
        while d:
            cuts.append(d)
            d &= d - 1
        assert [bytes(p) for p in r.path] == [of[tuple(seqs[r.conv][:d])] for d in [0, *cuts[::-1]]]
