import random
import re
import time
from collections import defaultdict

from fleetgauge.llm import decontaminate
from fleetgauge.llm.catalogue import QUERIES

ITEM = "Anna buys 12 apples for 3 dollars each and walks 5 km to the market. How many dollars does Anna spend on the apples before lunch?"
CHANGED = "Peter buys 40 apples for 7 euros each and walks 9 miles to the market. How many euros does Peter spend on the apples before lunch?"
MIXED = "Peter buys 40 apples for 7 euros each and walks 9 miles to the market. How many cents does Maria spend on the apples before lunch?"


def found(spark, docs, items=((1, ITEM),)):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], "doc_id long, text string, words string, at int")
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, hash string")
    return {(r.id, r.item): r for r in decontaminate.find(docs, bench).collect()}


def test_verbatim_and_changed_parameters(spark):
    around = "some words that have nothing to do with it "
    docs = [
        (1, around + ITEM + around), (2, CHANGED), (3, ITEM.lower()), (4, ITEM.upper()), (5, around * 20), (6, None), (7, ""), (8, "12 3 5"), (None, ITEM),
        (9, around * 4000 + ITEM), (1, around + ITEM + around), (10, " ".join(ITEM.split()[:14])), (11, "Anna buys 12 apples"),
    ]
    got = found(spark, docs)
    assert {k[0] for k in got} == {1, 2, 3, 4, 9, 10, None}
    assert got[1, 1].n_matched == got[2, 1].n_matched == got[2, 1].n_windows and got[1, 1].changed == 0 < got[2, 1].changed


def test_slots_must_be_consistent(spark):
    assert (1, 1) in found(spark, [(1, CHANGED)]) and (1, 1) not in found(spark, [(1, MIXED)])


def test_one_odd_slot_leaves_the_other_windows(spark):
    """Verbatim windows count beside an edited word, changed ones if they keep to the usual value."""
    edited = ITEM.replace("does Anna", "does Maria")
    item = " ".join(f"{v} Anna w{k} x{k} y{k} z{k} u{k} v{k}" for k, v in enumerate(["so", "then", "and", "but", "yet"]))
    changed = item.replace("Anna", "Peter")
    got = found(spark, [(1, edited), (2, changed), (3, changed[::-1].replace("reteP", "airaM", 1)[::-1]), (None, edited)], [(1, ITEM), (2, item)])
    assert set(got) == {(1, 1), (None, 1), (2, 2), (3, 2)}
    assert got[1, 1].n_matched == got[None, 1].n_matched == 12 and got[1, 1].changed == 0
    assert got[2, 2].n_matched == got[2, 2].n_windows == 33 and got[3, 2].n_matched == 25 + 1 and got[3, 2].changed == 1


def test_empty_and_odd_benchmarks(spark):
    assert found(spark, [(1, ITEM)], []) == {}
    assert found(spark, [], [(1, ITEM)]) == {}
    assert set(found(spark, [(1, ITEM)], [(None, ITEM), (2, None), (3, "too short"), (4, ITEM), (4, ITEM), (5, ITEM)])) == {(1, 4), (1, 5)}


def test_words_and_templates(spark):
    df = spark.createDataFrame([("In 2019 Bob paid $3.50 for 2kg, i.e. 1,000 g at Öko.",)], "t string").select(decontaminate.words("t").alias("w"))
    assert df.first().w == ["In", "2019", "Bob", "paid", "3.50", "for", "2", "kg", "i", "e", "1,000", "g", "at", "Öko"]
    typed = df.select(decontaminate.template("w").alias("t")).first().t
    assert typed == ["<name>", "<num>", "<name>", "paid", "<num>", "for", "<num>", "<unit>", "i", "e", "<num>", "<unit>", "at", "<name>"]


def test_large_benchmark_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert set(found(spark, [(1, ITEM), (2, "clean words only " * 30)])) == {(1, 1)}


def test_query_finds_every_passage(spark, table):
    """Brute force: items whose every run of eight words stands in the document."""

    def runs(text):
        words = re.findall(r"\w+", text.lower())
        return {tuple(words[k : k + 8]) for k in range(len(words) - 7)}

    where = defaultdict(set)
    for r in table("benchmark").collect():
        for run in runs(r.text):
            where[run].add(r.item_id)
    want = {(d.doc_id, i) for d in table("documents").collect() for run in runs(d.text) for i in where.get(run, ())}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_template_decontamination"](spark, "/root/testdata/sf0.01").collect()}
    assert got == want and want


def by_hand(doc, item, n=8):
    """(n_matched, n_windows, changed) of one alignment-wise comparison in plain Python, for texts of plain words and numbers in lower case."""
    d, i = doc.split(), item.split()
    kind = lambda w: "<num>" if w[0].isdigit() else w
    places = [p for p in range(len(i) - n + 1) if any(not w[0].isdigit() for w in i[p : p + n])]
    matched, best = set(), (0, 0)
    for shift in range(-len(i), len(d)):
        hit = [p for p in places if 0 <= p + shift <= len(d) - n and list(map(kind, d[p + shift : p + shift + n])) == list(map(kind, i[p : p + n]))]
        slots = {p: [(i[q], d[q + shift], q) for q in range(p, p + n) if i[q][0].isdigit()] for p in hit}
        uses = {s for p in hit for s in slots[p]}
        times = defaultdict(lambda: defaultdict(int))
        for a, b, _ in uses:
            times[a][b] += 1
        usual = {a: [b for b in of if of[b] == max(of.values())] for a, of in times.items()}
        sound = [p for p in hit if all(a == b for a, b, _ in slots[p]) or all(usual[a] == [b] for a, b, _ in slots[p])]
        matched |= set(sound)
        changed = len({a for p in sound for a, b, _ in slots[p] if a != b})
        best = max(best, (len(sound), -changed))
    return len(matched), len(places), -best[1]


def test_equals_plain_python(spark):
    rnd = random.Random(2)
    docs, items = [], []
    for k in range(25):
        item = [rnd.choice(["alpha", "beta", "gamma", "delta", str(rnd.randint(1, 4)), str(rnd.randint(1, 4))]) for _ in range(rnd.randint(9, 30))]
        items.append((k, " ".join(item)))
        copy = [str(rnd.randint(1, 4)) if w[0].isdigit() and rnd.random() < 0.3 else w for w in item]
        a, b = sorted((rnd.randint(0, len(copy)), rnd.randint(0, len(copy))))
        docs.append((100 + k, " ".join(["pad"] * rnd.randint(0, 9) + copy[: rnd.choice([b, len(copy)])] + ["end"] + copy[a:])))
    got = {k: (r.n_matched, r.n_windows, r.changed) for k, r in found(spark, docs, items).items()}
    want = {}
    for d, text in docs:
        for i, item in items:
            n, of, changed = by_hand(text, item)
            if n and n >= max(1, -(-of // 5)):
                want[d, i] = (n, of, changed)
    assert want and {k: v for k, v in got.items() if v[0] >= max(1, -(-v[1] // 5))} == want


def test_placeholders_alone_say_nothing(spark):
    numbers = lambda k, n: " ".join(str(k + 7 * j) for j in range(n))
    cities, names = "Paris London Rome Madrid Berlin Vienna Prague Oslo Dublin Athens", "Anna Peter Maria Paul Laura Simon Julia Felix Clara Jonas"
    assert found(spark, [(1, numbers(5, 30)), (2, cities)], [(1, numbers(100, 10)), (2, names), (3, names)]) == {}


def test_a_changed_value_counts_once(spark):
    item = "the 7 cats saw the 7 dogs and 9"
    assert found(spark, [(1, item.replace("7", "8"))], [(1, item)])[1, 1].changed == 1


def test_long_quotes_of_long_items_and_short_items(spark):
    rnd = random.Random(5)
    item = " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(126))
    words = item.split()
    docs = [(1, "x " + " ".join(words[50:70]) + " y"), (2, " ".join(words[3:16])), (3, " ".join(words[3:15])), (4, "What is 5 plus 7?"), (5, "what is 5 plus 7 please"), (6, "What is 2 plus 9"), (7, "12")]
    got = found(spark, docs, [(1, item), (2, "What is 5 plus 7?"), (3, "12"), (4, "What is 5 plus 5")])
    assert set(got) == {(1, 1), (2, 1), (4, 2), (6, 2)} and (got[4, 2].changed, got[6, 2].changed) == (0, 2)


def test_tables_of_numbers_take_seconds(spark):
    rnd = random.Random(6)
    heading = "these are the yearly sums of all the small shops in town"
    table_of = lambda: heading + " " + " ".join(str(rnd.randint(1, 40)) for _ in range(400))
    start = time.time()
    got = found(spark, [(k, table_of()) for k in range(20)], [(k, table_of()) for k in range(20)])
    assert time.time() - start < 60 and len(got) == 400 and min(r.n_matched for r in got.values()) >= 5
