import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from fleetgauge.llm import boundary_set, fill_in_middle as fim


def sets():
    rnd = np.random.default_rng(4)
    yield np.array([], np.int64)
    yield np.array([0])
    yield np.arange(200_000)
    yield np.sort(rnd.choice(300_000, 90_000, replace=False))  # bitmaps
    yield np.sort(rnd.choice(3_000_000, 900, replace=False))  # arrays
    yield np.concatenate([np.arange(5, 900), np.arange(65_530, 65_540), [200_000], np.arange(262_000, 262_400)])


def test_containers_select_and_rank():
    kinds = set()
    for values in sets():
        made = boundary_set.BoundarySet(values)
        kinds |= {type(c) for c in made.containers}
        assert len(made) == len(values)
        for k in np.linspace(0, len(values) - 1, 300).astype(int) if len(values) else []:
            assert made.select(int(k)) == values[k]
        for v in [0, 1, 63, 64, 65_535, 65_536, 131_071, 10**7, *values[::997].tolist(), *(values[::1009] + 1).tolist()]:
            assert made.rank(int(v)) == np.searchsorted(values, v)
        with pytest.raises(IndexError):
            made.select(len(values))
    assert kinds == set(boundary_set.KINDS)


def plain_python(text, key, percent=100):
    """The contract, word for word."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    x = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[i : i + 8], 16) for i in (0, 8, 16, 24))
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return n, form, len(p), len(m), out


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab\n\r\x85 é🤖<PSM>"), max_size=40), st.integers(-5, 10**12))
def test_transform_equals_contract(text, key):
    assert fim.transform(text, str(key), fim.Settings()) == plain_python(text, key)
    assert fim.transform(text, str(key), fim.Settings(percent=40)) == plain_python(text, key, 40)


def test_frames(spark):
    odd = ["", None, "\n", "\n\n\n", "no end", "a<P>b", "<", ">\n<S\n", "é\n🤖" * 500, "line\n" * 100_000, "x" * 300_000, "P>\n<M\n>", "same\ntext", "same\ntext"]
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(odd)] + [(None, "null id\nline\n", "x", None, None), (3, "again\nid", None, "", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, `a.b` string, __id int")
    got = fim.rearrange(df, "doc_id", "text", ["doc_id", "text", "a.b"])
    assert got.columns == ["doc_id", "text", "a.b", *fim.ADDED]
    got = got.withColumn("restored", fim.restore("output", "form")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_python(r.text or "", "" if r.doc_id is None else r.doc_id)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want
        assert r.restored == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.rearrange(df.limit(0), "doc_id", "text", ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        fim.rearrange(df, "doc_id", "text", ["doc_id", "output"])


def test_other_marks_and_settings(spark):
    own = fim.Settings(seed="s", percent=60, spm_percent=0, prefix="[pre]", suffix="[suf]", middle="[mid]")
    df = spark.range(200).selectExpr("id", "repeat('line of text\n', int(id % 7)) AS text")
    got = fim.rearrange(df, "id", "text", ["id", "text"], own).withColumn("back", fim.restore("output", "form", own)).collect()
    assert {r.form for r in got} == {"plain", "psm"}
    assert all(r.back == r.text for r in got)
    for bad in ({"prefix": ""}, {"prefix": "<S>"}, {"suffix": "<P><"}, {"middle": "x<P>x"}, {"middle": "aba"}):
        with pytest.raises(ValueError):
            fim.Settings(**bad)
