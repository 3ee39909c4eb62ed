import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from fleetgauge.llm import bpe, token_files
from fleetgauge.llm.catalogue import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ALPHABET = "aabbeeiinntthhoossrr  '’s'll\t\n.,!?</w>é1²Ⅷ中文ΣİßЯǺ\x1c\x85\xa0​😀🇩éﬁª"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(9)
    made = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    return [*made, "", "a" * 4000, "ab" * 2000, "thth" * 900, "<|endoftext|>x<|startoftext|>don't", "word " * 3000]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_automaton_equals_library(library, texts):
    encoder = bpe.Encoder(PATH)
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), "<i4").tolist()
        assert ids == ids_of(library, text), text[:60]
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_small_automaton_accepts_one_sequence_per_string():
    """Every split of a string into tokens is tried: only the one that merging gives is a path."""
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "b"), ("aa", "ab")]
    names = ["a", "b", *[x + y for x, y in merges]]
    vocab = {t: i for i, t in enumerate(names)}
    machine = bpe.Automaton(vocab, merges)

    def merged(word):
        parts = list(word)
        while True:
            ranks = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in merges]
            if not ranks:
                return parts
            i = min(ranks)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def splits(word):
        if not word:
            yield []
        for t in names:
            if word.startswith(t):
                yield from ([t, *rest] for rest in splits(word[len(t) :]))

    for n in range(1, 8):
        for k in range(2**n):
            word = "".join("ab"[k >> i & 1] for i in range(n))
            good = [s for s in splits(word) if all(machine.step(vocab[x], vocab[y]) for x, y in zip(s, s[1:], strict=False))]
            assert good == [merged(word)], word
            assert [names[i] for i in machine.path(word, "")] == merged(word)


def test_generations_of_the_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    encoder = bpe.Encoder(PATH)
    text = "one two three four five one two three four five six one"
    assert np.frombuffer(encoder.encode(text), "<i4").tolist() == ids_of(library, text)


def test_query_equals_library(spark, table, library):
    want = {}
    for r in table("documents", "0.001").collect():
        ids = ids_of(library, r.text)
        text = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op7_bpe_automaton"](spark, SF).collect()} == want


def test_encode_and_decode_frames(spark, library):
    rows = [(1, None, "x"), (None, "", "y"), (2, "hello hello", "z"), (2, "hello hello", "z"), (3, "<|endoftext|>", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded_text string")
    coded = bpe.encode(df, "text", PATH, ["doc_id", "text", "decoded_text"])
    got = bpe.decode(coded, "ids", PATH, ["doc_id", "ids", "text"]).collect()
    both = bpe.encode(df, "text", PATH, ["doc_id"], decoded="decoded").collect()
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in got) == sorted((str(r.doc_id), list(r.ids), r.decoded) for r in both)
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in got) == sorted(
        (str(i), ids_of(library, t), library.decode(ids_of(library, t), skip_special_tokens=False)) for i, t, _ in rows
    )
    assert bpe.encode(df.limit(0), "text", PATH, ["doc_id"]).collect() == []


def test_library_encoder_equals_library(library, texts):
    encode = token_files.LibraryEncoder(PATH)
    for start in range(0, len(texts), 400):
        part = texts[start : start + 400]
        assert [np.frombuffer(p, "<u4").tolist() for p in encode(part)] == [ids_of(library, t) for t in part]


def files(spark, tmp_path, rows, name="ids"):
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string, row int")
    folder = str(tmp_path / name)
    token_files.write(docs, "doc_id", "text", PATH, folder, 2)
    return folder


def test_file_query_equals_library(spark, table, library):
    want, start = {}, 0
    for r in table("documents", "0.001").orderBy("doc_id").collect():
        ids = np.array([*ids_of(library, r.text), 2], "<u4")
        want[r.doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op6_token_files"](spark, SF).collect()} == want


def test_files_of_odd_rows(spark, tmp_path, library):
    rows = [(5, "b", "", 1), (None, "null id", "", 1), (5, "b", "", 1), (5, None, "", 1), (-3, "", "", 1), (9, "long " * 5000, "", 1)]
    got = token_files.read(spark, files(spark, tmp_path, rows)).collect()
    want = sorted(((i is not None, i or 0), [*ids_of(library, t), 2]) for i, t, _, _ in rows)
    have = sorted(((r.key is not None, r.key or 0), np.frombuffer(r.ids, "<u4").tolist()) for r in got)
    assert have == want
    ends = sorted((r.start, r.start + len(r.ids) // 4) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert [r.key for r in sorted(got, key=lambda r: r.start)] == [None, -3, 5, 5, 5, 9]
    assert token_files.read(spark, files(spark, tmp_path, [], "none")).collect() == []


def test_only_wanted_frames_are_inflated(tmp_path, monkeypatch):
    import pyarrow.fs as pafs

    monkeypatch.setattr(token_files, "FRAME_IDS", 100)
    fs, name = pafs.LocalFileSystem(), str(tmp_path / "f.zst")
    writer = token_files.FrameWriter(fs.open_output_stream(name, compression=None))
    packed = {k: np.arange(k, k + 60, dtype="<u4").tobytes() for k in range(40)}
    for k, p in packed.items():
        writer.add(k, p)
    writer.close()
    with fs.open_input_file(name) as f:
        reader = token_files.FrameReader(f)
        assert [(k, p) for k, _, p in reader.documents({7, 31})] == [(7, packed[7]), (31, packed[31])]
        assert reader.inflated == 2 and len(reader.table) == 21
    import zstandard

    with open(name, "rb") as f:  # any reader of the format sees the same bytes
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == b"".join(packed.values())
    raw = bytearray(open(name, "rb").read())
    raw[60] ^= 255
    open(name, "wb").write(raw)
    with fs.open_input_file(name) as f, pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.FrameReader(f).documents())


@pytest.mark.parametrize("change", [{"normalizer": None}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}])
def test_other_rules_are_obeyed_or_refused(tmp_path, texts, change):
    """The same vocabulary with other rules: the files hold the library's ids, the automaton says what it does not do."""
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({**spec, **change}, f)
    with pytest.raises(ValueError, match=next(iter(change))):
        bpe.Encoder(path)
    own = tokenizers.Tokenizer.from_file(path)
    some = ["Hello World ABC", *texts[:300]]
    assert [np.frombuffer(p, "<u4").tolist() for p in token_files.LibraryEncoder(path)(some)] == [ids_of(own, t) for t in some]


def test_other_vocabulary_files():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with pytest.raises(ValueError, match="pre_tokenizer"):
        bpe.Encoder(path)
    own = tokenizers.Tokenizer.from_file(path)
    assert np.frombuffer(token_files.LibraryEncoder(path)(["Hello World  ABC"])[0], "<u4").tolist() == ids_of(own, "Hello World  ABC")
