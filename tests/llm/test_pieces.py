import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from fleetgauge.llm import piece_bpe, piece_model
from fleetgauge.llm.catalogue import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "aabbeeiinntthhoossrr    's\t\n.,!?é1²中文本の日ΣİßЯǺ\x1c\x85\xa0　​▁😀🇩ﬁª퟿\x00"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    return piece_bpe._coder(PATH)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(7)
    made = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    made += ["".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    made += [" " * n for n in range(1, 70)] + ["x" + " " * n + "y" for n in (5, 33, 400)]
    letters = "".join(rnd.choice("etaoinshrdlu") for _ in range(3000))
    return [*made, "", "a" * 4000, "ab" * 2000, "thth" * 900, "<s>x</s><unk><0x41>", "word " * 3000, letters, "▁▁a ▁", "\n\n\n", "0123456789" * 30]


def ids_of(library, text):
    return library.encode(text or "", add_bos=True, add_eos=True)


def test_rounds_equal_library(library, coder, texts):
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        for text, packed in zip(part, coder.encode(part), strict=True):
            ids = np.frombuffer(packed, "<u4")
            assert ids.tolist() == ids_of(library, text), text[:60]
            assert coder.decode(ids) == library.decode(ids.tolist())


def test_few_rounds_small_slices_and_caches(library, texts, monkeypatch):
    monkeypatch.setattr(piece_bpe, "ROUNDS", 3)
    monkeypatch.setattr(piece_bpe, "SLICE", 50)
    monkeypatch.setattr(piece_bpe, "CACHE_WORDS", 20)
    coder = piece_bpe.PieceCoder(PATH)
    some = texts[::9] + texts[-10:]
    assert [np.frombuffer(p, "<u4").tolist() for p in coder.encode(some)] == [ids_of(library, t) for t in some]
    assert len(coder.young) + len(coder.old) < 2000


def test_any_ids_decode_as_in_the_library(library, coder):
    rnd = random.Random(3)
    for _ in range(2000):
        low = rnd.choice([3, 259, 2000, 32000])
        ids = [rnd.randrange(low) if rnd.random() < 0.7 else rnd.randrange(32000) for _ in range(rnd.randint(0, 8))]
        assert coder.decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_small_tables_equal_merging_one_by_one():
    """Ties, pieces better than their parts, and pieces of characters that are no pieces themselves."""
    rnd = random.Random(1)
    for _ in range(150):
        made = {rnd.choice("abc") for _ in range(3)} | {"".join(rnd.choice("abc") for _ in range(rnd.randint(2, 5))) for _ in range(12)}
        pieces = sorted(made)
        scores = np.array([rnd.randint(-6, 0) for _ in pieces], np.float32)
        table = piece_bpe.MergeTable(pieces, scores, np.ones(len(pieces), bool))
        words = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 25))) for _ in range(20)]
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        lengths = np.array([len(w) for w in words])
        starts = np.cumsum(lengths) - lengths
        symbols, word = table.merge(table.symbols[points], starts)
        name = lambda s: pieces[s] if s < len(pieces) else chr(s - len(pieces))
        for n, w in enumerate(words):
            parts = list(w)
            while True:
                best = [(-scores[pieces.index(a + b)], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in made]
                if not best:
                    break
                i = min(best)[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert [name(s) for s in symbols[word == n].tolist()] == parts
            assert [name(s) for s in table.merge_singly(table.symbols[[ord(c) for c in w]].tolist())] == parts


def test_query_equals_library(spark, table, library):
    want = {}
    for r in table("documents", "0.001").collect():
        ids = ids_of(library, r.text)
        text = library.decode(ids)
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op13_piece_rounds"](spark, "/root/testdata/sf0.001").collect()} == want


def test_frames(spark, library):
    rows = [(1, None, "x"), (None, "", "y"), (2, "hello hello", "z"), (2, "hello hello", "z"), (3, "</s> 日本", None), (4, "long " * 300_000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    coded = piece_bpe.encode(df, "text", PATH, ["doc_id", "text", "a.b"])
    got = piece_bpe.decode(coded, "ids", PATH, ["doc_id", "ids", "text"]).collect()
    both = piece_bpe.encode(df, "text", PATH, ["doc_id"], decoded="decoded").collect()
    assert sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in got) == sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in both)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted((str(i), ids_of(library, t)) for i, t, _ in rows)
    bare = piece_bpe.encode(df.where("doc_id = 1"), "text", PATH, [], ends=False).first()
    assert bytes(bare.ids) == b""
    assert piece_bpe.encode(df.limit(0), "text", PATH, ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        piece_bpe.encode(coded, "text", PATH, ["ids"])


def test_models_with_other_rules_are_refused(tmp_path):
    """The normaliser's message is replaced by one that removes spaces (field 4 = 1)."""
    data = open(PATH, "rb").read()
    for own, said in ((b"\x1a\x04\x18\x01\x20\x01", "removal of spaces"), (b"\x1a\x06\x12\x02xx\x20\x00", "a character map"), (b"\x12\x02\x18\x01", "not byte-pair")):
        path = tmp_path / "other.model"
        path.write_bytes(data + own)
        with pytest.raises(ValueError, match=said):
            piece_model.read_model(str(path))
