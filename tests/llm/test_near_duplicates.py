import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np

from fleetgauge.llm import order_minhash
from fleetgauge.llm.catalogue import QUERIES
from fleetgauge.llm.components import components


def test_components_of_chains_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(1, 2), (2, 3), (3, 1), (1, 1), (2, 1), (5, 5)]
    got = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 141)} | {k: 7 for k in [7, *range(200, 260)]} | {1: 1, 2: 1, 3: 1}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_alignment_equals_dynamic_programming():
    rnd = random.Random(2)
    for _ in range(400):
        a = [rnd.randint(0, 12) for _ in range(rnd.randint(1, 40))]
        b = list(a)
        for _ in range(rnd.randint(0, 6)):
            k = rnd.randrange(len(b) + 1)
            b[k : k + rnd.randint(0, 1)] = [rnd.randint(0, 30)] * rnd.randint(0, 2)
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *np.maximum.accumulate([max(row[j + 1], row[j] + (x == y)) for j, y in enumerate(b)]).tolist()] if b else [0]
        sim = row[-1] / (len(a) + len(b) - row[-1])
        got = order_minhash.aligned_similarity(np.array(a, np.uint32), np.array(b, np.uint32))
        assert got == (sim if sim >= 0.8 else 0.0), (a, b)


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []


def classes(docs):
    """Connected documents by brute force over all pairs that share a shingle."""
    sets = {d: set(shingles(t)) for d, t in docs}
    parent, where, common = {d: d for d in sets}, defaultdict(list), defaultdict(int)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    for members in where.values():
        for a, b in combinations(members, 2):
            common[a, b] += 1
    for (a, b), n in common.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= 0.8:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {d: root(d) for d in sets}


def test_query_equals_brute_force(spark, table):
    docs = [(r.doc_id, r.text) for r in table("documents").collect()]
    got = {r.doc_id: r.class_id for r in QUERIES["op2_order_minhash"](spark, "/root/testdata/sf0.01").collect()}
    assert got == classes(docs)


def near(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, class_id int, key string")
    return order_minhash.near_duplicates(df).collect()


def test_group_in_which_members_stray_from_the_centre(spark):
    rnd = random.Random(4)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(240)]
    docs = [(0, " ".join(base))]
    for k in range(1, 150):
        words = list(docs[rnd.randrange(len(docs))][1].split()) if k % 3 else list(base)
        for _ in range(rnd.choice([1, 2, 4, 6])):
            words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 10**6)}"
        docs.append((k, " ".join(words)))
    docs += [(200 + k, " ".join(f"z{rnd.randint(0, 10**6)}" for _ in range(50)) + " " + " ".join(base[:60])) for k in range(60)]
    got = {r.id: r.class_id for r in near(spark, docs)}
    want = classes(docs)
    # Brute force counts sets; alignment also asks for order, which these texts keep.
    assert got == want


def test_short_texts_with_one_word_more(spark):
    eight = "one two three four five six seven eight"
    got = {r.id: r.class_id for r in near(spark, [(1, eight), (2, eight + " nine"), (3, "zero " + eight), (4, "one two three"), (5, "one two three four")])}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_short_texts_equal_brute_force(spark):
    rnd, docs = random.Random(12), []
    for k in range(500):
        words = [f"w{rnd.randint(0, 10**6)}" for _ in range(rnd.randint(8, 75))]
        docs.append((4 * k, " ".join(words)))
        for j in range(1, 4):
            near_by = list(words)
            for _ in range(rnd.randint(0, (len(words) - 4) // 10)):  # at either end a word changes one shingle
                near_by = [*near_by, f"x{rnd.randint(0, 10**6)}"] if rnd.random() < 0.5 else near_by[1:]
            if len(words) > 30:
                near_by[rnd.randrange(len(words) // 3, len(words) // 2)] = f"y{rnd.randint(0, 10**6)}"
            docs.append((4 * k + j, " ".join(near_by if len(words) > 13 or j > 1 else [*words, "more"])))
    assert {r.id: r.class_id for r in near(spark, docs)} == classes(docs)


def test_exact_keys_meet_every_pair():
    rnd = random.Random(13)
    for _ in range(4000):
        least = rnd.choice([0.8, 0.8, 0.5, 0.3])
        a = np.array([rnd.randint(0, rnd.choice([5, 500])) for _ in range(rnd.randint(1, 49))], np.uint64)
        b = [x for x in a.tolist() if rnd.random() > (1 - least) / 2] + [rnd.randint(600, 900) for _ in range(rnd.randint(0, 1 + len(a) // 10))]
        if b and aligned_exactly(a.tolist(), b) >= least:
            assert set(order_minhash.candidate_keys(a, least).tolist()) & set(order_minhash.candidate_keys(np.array(b, np.uint64), least).tolist())


def aligned_exactly(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0, *np.maximum.accumulate([max(row[j + 1], row[j] + (x == y)) for j, y in enumerate(b)]).tolist()]
    return row[-1] / (len(a) + len(b) - row[-1])


def test_pair_with_one_key_in_common_beside_a_centre(spark):
    """Two texts share one key only, in a bucket whose centre is like neither of them."""
    rnd = random.Random(14)
    word = lambda: f"w{rnd.randint(0, 10**9)}"
    shingle = order_minhash.Shingler()
    keys = lambda words: order_minhash.candidate_keys(shingle(" ".join(words)))
    both = []
    while len(both) != 1:  # 64 of 80 shingles are common
        base = [word() for _ in range(76)]
        of_base = keys(base)
        for _ in range(200):
            other = [*base[8:], *[word() for _ in range(8)]]
            both = np.flatnonzero(of_base == keys(other))
            if len(both) == 1:
                break
    key, five = both[0], order_minhash._labelled(shingle(" ".join(base)))
    picks = np.sort(np.argsort(five * order_minhash._factors[key])[: order_minhash.PICKS])
    while True:  # the centre holds the five shingles of that key, and words of its own
        centre = [w for at in picks for w in (*base[at : at + 5], *[word() for _ in range(9)])]
        if keys(centre)[key] == of_base[key]:
            break
    docs = [(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(centre)), (4, " ".join([*centre, "more"]))]
    got = {r.id: r.class_id for r in near(spark, docs)}
    assert got == classes(docs) == {1: 1, 2: 1, 3: 3, 4: 3}


def test_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(4, text), (9, text.upper() + "!"), (9, text), (None, text), (5, None), (6, ""), (7, "!!"), (8, "two words"), (3, "Two  words"), (11, "two other"), (12, "w " * 60_000), (13, "w " * 60_000)]
    got = near(spark, rows)
    by = {r.id: r.class_id for r in got}
    assert len(got) == len(rows)
    assert by == {4: 4, 9: 4, None: 4, 5: 5, 6: 6, 7: 7, 8: 3, 3: 3, 11: 11, 12: 12, 13: 12}
    assert near(spark, []) == []
