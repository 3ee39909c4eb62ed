import math

import numpy as np
import pytest

from fleetgauge.llm import langid
from fleetgauge.llm.catalogue import QUERIES


def test_gradients_through_time():
    net = langid.Network(["a", "b", "c"], hidden=3)
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 5, (7, 4)).astype(np.uint8), rng.integers(0, 3, 4)
    _, grads = net.gradients(x, y)
    for name, w in net.weights.items():
        for at in [tuple(int(rng.integers(0, min(s, 5))) for s in w.shape) for _ in range(3)]:
            kept, ends = w[at], []
            for e in (1e-3, -1e-3):
                w[at] = kept + e
                ends.append(net.gradients(x, y)[0])
            w[at] = kept
            assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(grads[name][at], rel=2e-2, abs=1e-6)


def test_windows_count_every_byte_once():
    texts = [b"", b"a", b"b" * 63, b"c" * 64, b"d" * 65, bytes(range(100)) * 3]
    x, owner, fresh = langid.windows_of(texts)
    for k, text in enumerate(texts):
        seen = b"".join(bytes(x[i][fresh[i, 0] : fresh[i, 1]]) for i in np.flatnonzero(owner == k))
        assert seen == text


@pytest.fixture(scope="module")
def predicted(spark):
    return {r.doc_id: r for r in QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()}


def test_held_out_accuracy(predicted, table):
    import zlib

    rows = table("documents").select("doc_id", "lang").collect()
    assert {r.doc_id for r in rows} == set(predicted)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert {r.doc_id for r in held} == {d for d, p in predicted.items() if p.held_out}
    assert np.mean([predicted[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= p.score <= 1 for p in predicted.values())


def test_odd_rows(spark, table):
    fit_on = table("documents", "0.001").where(~langid.held_out("doc_id"))
    network = langid.fit(fit_on, "doc_id", "text", "lang", per_language=8)
    rows = [(1, None, "en"), (2, "", None), (3, "12 !? 34", "x"), (4, "the ting of and " * 40_000, "y"), (None, "a", "z"), (5, "the ting", "y"), (5, "the ting", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = langid.predict(df, "text", network, ["doc_id", "text", "score"], "lang_pred", "p").collect()
    by = {r.doc_id: (r.lang_pred, r.p) for r in got}
    assert len(got) == 7 and [by[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by[4][0] == "en" and by[None][0] in network.languages and all(r.score is not None or r.text == "" for r in got)
    assert langid.predict(df.limit(0), "text", network, ["doc_id"]).collect() == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert langid.fit(df, "doc_id", "text", "lang") is None
    assert {r.lang_pred for r in langid.predict(df, "text", None, ["doc_id"]).collect()} == {"und"}
    one = spark.createDataFrame([(1, "some text " * 9, "en")], df.schema)
    assert [r.lang_pred for r in langid.predict(one, "text", langid.fit(one, "doc_id", "text", "lang"), ["doc_id"]).collect()] == ["en"]


def step_by_step(network, text):
    """Mean probabilities over all bytes, one window, byte and unit after the other in plain Python."""
    h, k = network.hidden, len(network.languages)
    w = {name: v.astype(float).tolist() for name, v in network.weights.items()}
    squash = lambda v: 1 / (1 + math.exp(-v))

    def states(side, window):
        state, out = [0.0] * h, {}
        places = range(len(window)) if side == "f" else range(len(window) - 1, -1, -1)
        for t in places:
            x = [row[window[t]] for row in w["table" + side]]
            g = [sum(a * b for a, b in zip(row, state, strict=True)) for row in w["state" + side]]
            reset, update = ([squash(x[u * h + i] + g[u * h + i]) for i in range(h)] for u in (0, 1))
            cand = [math.tanh(x[2 * h + i] + reset[i] * g[2 * h + i]) for i in range(h)]
            state = [cand[i] + update[i] * (state[i] - cand[i]) for i in range(h)]
            out[t] = state
        return out

    total = [0.0] * k
    for start in range(0, len(text), langid.STEPS):
        begin = start if start + langid.STEPS <= len(text) else max(0, len(text) - langid.STEPS)
        window = text[begin : begin + langid.STEPS].ljust(langid.STEPS)
        f, b = states("f", window), states("b", window)
        for t in range(start - begin, min(langid.STEPS, len(text) - begin)):
            logits = [w["bias"][j][0] + sum(w["outf"][j][i] * f[t][i] + w["outb"][j][i] * b[t][i] for i in range(h)) for j in range(k)]
            parts = [math.exp(v - max(logits)) for v in logits]
            total = [a + p / sum(parts) for a, p in zip(total, parts, strict=True)]
    return [a / max(1, len(text)) for a in total]


def test_probabilities_step_by_step():
    network = langid.Network(["de", "en", "fr"], hidden=5, seed=3)
    texts = [b"", b"short", b"x" * 64, "Straße und Öl, ".encode() * 9, bytes(range(256))]
    got = network.documents(texts)
    for text, row in zip(texts, got, strict=True):
        assert row.tolist() == pytest.approx(step_by_step(network, text), abs=1e-5)


def test_rows_that_repeat_an_id(spark):
    """Two languages of one id, thousands of rows each, and one language among many that has few rows."""
    same = spark.range(6000).selectExpr("1L AS id", "concat(repeat('the ting of and this ', 40), id % 50) AS text", "'en' AS lang")
    same = same.unionByName(spark.range(6000).selectExpr("1L AS id", "concat(repeat('der die das und nicht ', 40), id % 50) AS text", "'de' AS lang"))
    few = spark.range(3).selectExpr("id + 10 AS id", "concat(repeat('que la mentre les éç ', 40), id) AS text", "'fr' AS lang")
    network = langid.fit(same.unionByName(few), "id", "text", "lang", per_language=40)
    assert network.languages == ["de", "en", "fr"]
    told = langid.predict(same.limit(3), "text", network, ["id"]).collect()
    assert {r.lang_pred for r in told} <= set(network.languages)  # none is und
