"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

The automaton reads tokens. It starts with one state and an arc for each base
symbol. Every merge (u, v) -> w, in order of rank, applies one gadget: the state
reached by u is split off without its arc v, and each state that could read u and
then v gets an arc w into the state that v led to. What is left in the end
accepts, for each string, exactly one token sequence: the one that merging by
rank gives. All arcs of a label lead to one state, so a state is named by the
token last read, and ``Automaton`` keeps of every split only what it changed:
which arc went at which time, and from which state a new token's state was copied.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from .worker import per_worker

CACHE_WORDS = 200_000  # of each of two generations
KNOWN_ARCS = 300_000
START = -1  # the state before any token


def _ranges(kind: str, top: int) -> str:
    """A character class of the code points up to ``top`` whose general category starts with ``kind``."""
    out, first = [], None
    for c in range(top + 2):
        inside = c <= top and unicodedata.category(chr(c))[0] == kind
        if inside and first is None:
            first = c
        elif not inside and first is not None:
            out.append(f"\\U{first:08x}-\\U{c - 1:08x}")
            first = None
    return "".join(out)


LATIN = 0x17F
beyond_latin = re.compile(f"[^\\0-{chr(LATIN)}]").search


def word_pattern(top: int = sys.maxunicode) -> re.Pattern:
    """Contractions, runs of letters, single numerals, runs of anything else but white space, up to code point ``top``."""
    letters, numbers = _ranges("L", top), _ranges("N", top)
    space = r"\t-\r \x85\xa0  -     　"
    return re.compile(f"[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d|[{numbers}]|[^{space}{letters}{numbers}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        self.born = dict.fromkeys(vocab.values(), 0)
        self.parts: dict[int, tuple[int, int]] = {}
        self.cut: dict[tuple[int, int], int] = {}
        self.dead: set[int] = set()
        self.known: dict[int, bool] = {}  # by state and label in one number
        for time, (left, right) in enumerate(merges, 1):
            self._gadget(vocab[left], vocab[right], vocab[left + right], time)
        self.usable = {t: i for t, i in vocab.items() if i not in self.dead}
        # All beginnings of tokens: the id of a token, or -1 for a mere beginning.
        self.begins = dict.fromkeys((t[:k] for t in self.usable for k in range(1, len(t))), -1) | self.usable

    def _gadget(self, u: int, v: int, w: int, time: int) -> None:
        if w in self.parts:
            raise ValueError("two merges give the same token")
        self.parts[w], self.born[w] = (u, v), time
        if u in self.dead or v in self.dead or not self.arc(u, v, time - 1):
            self.dead.add(w)  # u is never followed by v, so there is nothing to split
        self.cut[u, v] = time

    def arc(self, state: int, label: int, time: int) -> bool:
        """Whether the state after token ``state`` has an arc ``label``, after the merges up to ``time``."""
        while True:
            if label in self.dead:
                return False
            if self.cut.get((state, label), time + 1) <= time:
                return False
            s, t = self.born[state], self.born[label]
            if s == t == 0:
                return True
            if t > s:  # the arc was added to the states that could read its left part
                label, time = self.parts[label][0], t
            elif t == s:  # a token after itself: the copied state got the arc in the same gadget
                (label, state), time = self.parts[state], s - 1
            else:  # the state is a copy of the one its right part led to
                state, time = self.parts[state][1], s - 1

    def step(self, state: int, label: int) -> bool:
        if state == START:
            return True
        key = state << 32 | label
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= KNOWN_ARCS:
                self.known.clear()
            found = self.known[key] = self.arc(state, label, len(self.parts) + len(self.born))
        return found

    def arcs(self, word: str, end: str, at: int, state: int) -> list[tuple[int, int]]:
        """(end, token) of the arcs that fit at a place, the longest last."""
        n, find, known, fit, stop = len(word), self.begins.get, self.known, [], at + 1
        while stop < n and (token := find(word[at:stop])) is not None:
            if token >= 0 and (state == START or known.get(state << 32 | token) or self.step(state, token)):
                fit.append((stop, token))
            stop += 1
        if stop == n and (token := self.usable.get(word[at:] + end)) is not None and self.step(state, token):
            fit.append((n, token))
        return fit

    def path(self, word: str, end: str) -> list[int]:
        """The token sequence that spells ``word`` and its end mark: the one path from the start to the end.

        Of several arcs that fit, the longest is tried first; a (place, state) from
        which the end was not reached is not entered again.
        """
        n, at, state, out, other = len(word), 0, START, [], []
        closed: set[tuple[int, int]] = set()
        while at < n:
            fit = self.arcs(word, end, at, state)
            while not fit or (closed and fit[-1] in closed):
                if fit:
                    fit.pop()
                    continue
                if not out:
                    raise ValueError("a symbol is not in the vocabulary")
                closed.add((at, out.pop()))  # nothing fits here: back to the arcs left at the place before
                at, fit = other.pop()
            at_before = at
            at, state = fit.pop()
            out.append(state)
            other.append((at_before, fit))
        return out


# The rules of a vocabulary file that ``Encoder`` follows.
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
}
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}


def other_rules(spec: dict) -> list[str]:
    """What in a vocabulary file differs from the rules that are built in here; nothing if they are its own."""
    found = [name for name, rule in RULES.items() if spec.get(name) != rule]
    found += [f"model.{name}" for name, value in MODEL.items() if spec["model"].get(name, value) != value]
    flags = ("single_word", "lstrip", "rstrip", "normalized")
    return found + [f"added token {t['content']}" for t in spec["added_tokens"] if any(t.get(f) for f in flags)]


def _by_id(spec: dict) -> np.ndarray:
    labels = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return np.array([labels.get(i, "") for i in range(max(labels) + 1)], dtype=object)


def read_labels(path: str) -> np.ndarray:
    """The label of each id of a vocabulary file."""
    with open(path, encoding="utf-8") as f:
        return _by_id(json.load(f))


class Encoder:
    """Texts to ids and back for a vocabulary file of byte-level words with an end mark.

    The text is split at the special tokens, composed (NFC), put in lower case
    character by character and split into words; each word goes through the automaton. A file with other rules is
    refused with a ValueError.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if other_rules(spec):
            raise ValueError(f"{path}: not supported: " + ", ".join(other_rules(spec)))
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = _by_id(spec)
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.latin = word_pattern(LATIN).findall
        self.any: re.Pattern | None = None
        self.bytes = str.maketrans({chr(b): c for b, c in enumerate(byte_symbols())})
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The normalised words of a text. Letters up to U+017F need no composing, and a smaller pattern."""
        if text.isascii() or not beyond_latin(text):
            return self.latin(text.lower()) if "\u0130" not in text else self._words(text)
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if self.any is None:
            self.any = word_pattern()
        return self.any.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def word(self, word: str) -> bytes:
        """Packed ids of one word; words met lately are kept."""
        found = self.old.get(word)
        if found is None:
            ids = self.automaton.path(word.encode().decode("latin-1").translate(self.bytes), self.end)
            found = array("i", ids).tobytes()
        if len(word) <= 64:
            if len(self.young) >= CACHE_WORDS:
                self.young, self.old = {}, self.young
            self.young[word] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids as packed 32-bit integers."""
        packed = []
        for piece in self.split.split(text or "") if self.split else [text or ""]:
            if piece in self.special:
                packed.append(array("i", [self.special[piece]]).tobytes())
                continue
            get = self.young.get
            for word in self.words(piece):
                ids = get(word)
                if ids is None:
                    ids = self.word(word)
                    get = self.young.get
                packed.append(ids)
        return b"".join(packed)

    def decode(self, ids) -> str:
        """The labels of the arcs, joined as a tokenizer without a decoder joins them."""
        return " ".join(self.labels[ids].tolist())


def _int_lists(packed: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


ROWS = 512


def encode(df: DataFrame, text_col: str, tokenizer: str, keep: list[str], decoded: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``ids``: the token ids of every whole text; a null text has none.

    ``tokenizer`` is the path of a vocabulary file on each executor. Rows stay where
    they are: there is no shuffle, and repeated rows are encoded each. ``keep`` may hold the text and
    columns of any name but ``ids``. With ``decoded`` the text decoded from the ids is added under that
    name, by the same worker, as ``decode`` gives it.
    """
    where = keep.index(text_col) if text_col in keep else len(keep)

    def run(batches):
        encoder = per_worker(("automaton", tokenizer), lambda: Encoder(tokenizer))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                packed = [encoder.encode(t.as_py()) for t in part.column(where)]
                out, names = [*part.columns[: len(keep)], _int_lists(packed)], [*keep, "ids"]
                if decoded:
                    out.append(pa.array([encoder.decode(np.frombuffer(p, "<i4")) for p in packed], pa.string()))
                    names.append(decoded)
                yield pa.RecordBatch.from_arrays(out, names=names)

    rows = df.select(*keep) if where < len(keep) else df.select(*keep, text_col)
    schema = df.select(*keep).schema.add("ids", ArrayType(IntegerType()))
    return rows.mapInArrow(run, schema.add(decoded, "string") if decoded else schema)


def decode(df: DataFrame, ids_col: str, tokenizer: str, keep: list[str], out: str = "decoded") -> DataFrame:
    """The columns ``keep`` and the text of each id list: arc labels joined by a space; null ids give an empty text."""
    where = keep.index(ids_col) if ids_col in keep else len(keep)

    def run(batches):
        names = per_worker(("labels", tokenizer), lambda: read_labels(tokenizer))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = [" ".join(names[ids.values.to_numpy()].tolist()) if ids.is_valid else "" for ids in part.column(where)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, out])

    rows = df.select(*keep) if where < len(keep) else df.select(*keep, ids_col)
    schema = df.select(*keep).schema.add(out, "string")
    return rows.mapInArrow(run, schema)
