"""SentencePiece encoding by vectorised merge rounds, and decoding.

The words that a batch of texts has and the worker has not met yet are laid out as one flat array of symbols.
A round finds, for each word, the smallest rank among its adjacent pairs, merges in all words at once the pairs
that have it, from the left, and closes the gaps. Words in which no pair is left leave the array.

Merging one pair at a time, always the best and of equal ones the leftmost, defines the result. All places of one
rank in a word may be merged in one round where no merged symbol forms a pair as good as itself; of any other
rank a round merges the leftmost place only.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .piece_model import BYTE, CONTROL, NORMAL, SPACE, UNKNOWN, read_model
from .worker import per_worker

NONE = np.iinfo(np.int32).max  # the rank of a pair that is no piece
ROUNDS = 256  # after these the words that are left, very long ones, go on merge by merge
CACHE_WORDS = 200_000  # of each of two generations
CACHED_LENGTH = 64
SLICE = 1 << 20  # characters of a text that are split into words at once


class MergeTable:
    """Which adjacent symbols make which piece, and at which rank.

    A symbol is the id of a piece, or the number of pieces plus the code point of a character that is none.
    """

    def __init__(self, pieces: list[str], scores: np.ndarray, normal: np.ndarray):
        n = len(pieces)
        self.pieces = n
        ids = {p: i for i, p in enumerate(pieces) if normal[i]}
        levels = {s: k for k, s in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        rank = np.full(n, -1, np.int64)
        for i in ids.values():
            rank[i] = levels[scores[i]]
        symbol = lambda s: ids.get(s, n + ord(s) if len(s) == 1 else None)
        pairs, beside = {}, set()
        for p, i in ids.items():
            beside.update(zip(p, p[1:], strict=False))
            for k in range(1, len(p)):
                left, right = symbol(p[:k]), symbol(p[k:])
                if left is not None and right is not None:
                    pairs[left, right] = i
        self.base = n + 0x110000
        keys = np.array([a * self.base + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.made = np.append(np.array(list(pairs.values()), np.int64)[order], 0)
        self.rank = np.append(rank[self.made[:-1]], NONE)
        # Ranks of which all places may go at once: of one piece, that forms no pair of the same or a better rank.
        self.at_once = np.bincount(rank[rank >= 0], minlength=len(levels)) == 1
        for side in (self.keys[:-1] // self.base, self.keys[:-1] % self.base):
            piece = side < n
            worse = self.rank[:-1][piece] <= rank[side[piece]]
            self.at_once[rank[side[piece]][worse]] = False
        self.symbols = np.arange(n, self.base, dtype=np.int64)  # by code point
        for p, i in ids.items():
            if len(p) == 1:
                self.symbols[ord(p)] = i
        self.beside = np.array(sorted(ord(a) << 21 | ord(b) for a, b in beside) or [-1], np.int64)
        self.joined = sorted({c for pair in beside for c in pair})

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of each pair; ``NONE`` and 0 if it makes no piece."""
        key = left * self.base + right
        at = np.searchsorted(self.keys, key)
        at[self.keys[at] != key] = len(self.keys) - 1
        return self.rank[at], self.made[at]

    def words_of(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """More starts: no piece holds the two characters beside them, so no merge reaches across."""
        key = points[:-1].astype(np.int64) << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        return np.union1d(starts, np.flatnonzero(self.beside[at] != key) + 1)

    def merge(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, number of the word of each) when nothing can be merged any more; words begin at ``starts``."""
        word = np.zeros(len(symbols), np.int64)
        word[starts[1:]] = 1
        word = np.cumsum(word)
        rank, made = self._pairs(symbols, word, np.arange(len(symbols)))
        ready = []
        for _ in range(ROUNDS):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(word))) if len(word) else rank
            done = best == NONE
            if done.any():
                ready.append((symbols[done], word[done]))
                symbols, word, rank, made, best = (x[~done] for x in (symbols, word, rank, made, best))
            if not len(word):
                break
            at = np.flatnonzero(rank == best)
            n = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, n, 0))
            leftmost = np.diff(word[at], prepend=-1) != 0
            at = at[((n - run) % 2 == 0) & (leftmost | self.at_once[rank[at]])]  # of overlapping places the first, third, ...
            symbols[at] = made[at]
            stay = np.ones(len(word), bool)
            stay[at + 1] = False
            at -= np.arange(len(at))
            symbols, word, rank, made = (x[stay] for x in (symbols, word, rank, made))
            near = np.union1d(at, at[at > 0] - 1)
            rank[near], made[near] = self._pairs(symbols, word, near)
        for k in np.unique(word):
            left = self.merge_singly(symbols[word == k].tolist())
            ready.append((np.array(left, np.int64), np.full(len(left), k)))
        symbols, word = (np.concatenate([r[k] for r in ready]) if ready else np.zeros(0, np.int64) for k in (0, 1))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _pairs(self, symbols, word, at):
        """(rank, piece) of the pairs that begin at the places ``at``; the last symbol of a word begins none."""
        after = np.minimum(at + 1, len(word) - 1)
        rank, made = self.look_up(symbols[at], symbols[after])
        rank[(word[at] != word[after]) | (at == after)] = NONE
        return rank, made

    def merge_singly(self, symbols: list[int]) -> list[int]:
        """The same result with a queue of pairs, for words of very many rounds."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = dict(zip(self.keys[:-1].tolist(), zip(self.rank[:-1].tolist(), self.made[:-1].tolist(), strict=True), strict=True))
        queue = []

        def offer(i):
            if i >= 0 and after[i] < n and (found := pairs.get(symbols[i] * self.base + symbols[after[i]])):
                heapq.heappush(queue, (found[0], i, symbols[i], symbols[after[i]], found[1]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            if symbols[i] != left or after[i] >= n or symbols[after[i]] != right:
                continue
            gone = after[i]
            symbols[i], symbols[gone], after[i] = made, -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return [s for s in symbols if s >= 0]


class PieceCoder:
    """Texts to ids and back as a model file says."""

    def __init__(self, path: str):
        model = read_model(path)
        self.model = model
        self.table = MergeTable(model.pieces, model.scores, model.kinds == NORMAL)
        self.byte_ids = np.zeros(256, np.int64)
        self.byte_ids[[int(p[3:5], 16) for p, k in zip(model.pieces, model.kinds, strict=True) if k == BYTE]] = np.flatnonzero(model.kinds == BYTE)
        self.prefix = SPACE if model.dummy_prefix else ""
        split = all(SPACE not in p.lstrip(SPACE) for p, k in zip(model.pieces, model.kinds, strict=True) if k == NORMAL)
        if not split:
            raise ValueError("pieces that hold a space after another character are not supported")
        # No piece reaches across a space mark after another character, nor over a character that only stands alone.
        joined = "".join(map(re.escape, (c for c in self.table.joined if c != SPACE))) or SPACE
        self.words = re.compile(f"{SPACE}*[{joined}]+|{SPACE}+|[^{SPACE}{joined}]+").findall
        self.gap = re.compile(f"[^{SPACE}](?={SPACE})").search
        self.labels = np.array([self._label(i) for i in range(len(model.pieces))], dtype=object)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _label(self, i: int) -> bytes:
        piece, kind = self.model.pieces[i], self.model.kinds[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return (self.model.unknown_text if kind == UNKNOWN else piece.replace(SPACE, " ")).encode()

    def slices(self, text: str):
        """The marked text in parts that begin at words."""
        text = self.prefix + text.replace(" ", SPACE) if text else ""
        at = 0
        while at < len(text):
            cut = self.gap(text, at + SLICE) if len(text) - at > SLICE else None
            end = cut.end() if cut else len(text)
            yield text[at:end]
            at = end

    def code(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        starts = np.cumsum(lengths) - lengths
        parts = self.table.words_of(points, starts)
        symbols, part = self.table.merge(self.table.symbols[points], parts)
        word = np.searchsorted(starts, parts[part], "right") - 1
        alone = np.flatnonzero(symbols >= self.table.pieces)
        if len(alone):  # characters that are no piece: their bytes
            coded = [chr(s).encode() for s in (symbols[alone] - self.table.pieces).tolist()]
            times = np.ones(len(symbols), np.int64)
            times[alone] = [len(c) for c in coded]
            flat = np.repeat(np.isin(np.arange(len(symbols)), alone), times)
            symbols, word = np.repeat(symbols, times), np.repeat(word, times)
            symbols[flat] = self.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
        ends = 4 * np.searchsorted(word, np.arange(len(words)), "right")
        packed, at, out = symbols.astype("<u4").tobytes(), 0, []
        for end in ends.tolist():
            out.append(packed[at:end])
            at = end
        return out

    def _know(self, words: set[str]) -> None:
        new = words - self.young.keys()
        if len(self.young) + len(new) > CACHE_WORDS:
            self.young, self.old, new = {}, self.young, words
        found = {w: self.old[w] for w in new if w in self.old}
        self.young |= found
        new = [w for w in new if w not in found]
        if new:
            self.young.update(zip(new, self.code(new), strict=True))

    def encode(self, texts: list[str | None], ends: bool = True) -> list[bytes]:
        """Ids as packed little-endian 32-bit integers, between the begin and end ids if ``ends``."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0

        def settle():
            self._know(set().union(*(w for _, w in held)))
            known = self.young
            for n, words in held:
                out[n].append(b"".join(map(known.__getitem__, words)))
            for w in {w for _, words in held for w in words if len(w) > CACHED_LENGTH}:
                del known[w]
            held.clear()

        for n, text in enumerate(texts):
            for part in self.slices(text or ""):
                held.append((n, self.words(part)))
                size += len(part)
                if size > SLICE:
                    settle()
                    size = 0
        if held:
            settle()
        mark = (lambda i: np.array([i], "<u4").tobytes() if ends else b"")
        first, last = mark(self.model.begin), mark(self.model.end)
        return [b"".join([first, *parts, last]) for parts in out]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: control pieces are nothing, bytes that are no character U+FFFD each."""
        shown = ids[self.model.kinds[ids] != CONTROL]
        joined = b"".join(self.labels[shown].tolist())
        kinds = self.model.kinds
        if self.prefix and len(shown) and kinds[shown[0]] == NORMAL and joined.startswith(b" "):
            joined = joined[1:]
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return joined.decode(errors="each_byte")


def _each_byte(error):
    return "�", error.start + 1


def _coder(path: str) -> PieceCoder:
    import codecs

    codecs.register_error("each_byte", _each_byte)
    return per_worker(("pieces", path), lambda: PieceCoder(path))


ROWS = 256


def _mapped(df: DataFrame, col: str, keep: list[str], added: list[StructField], make) -> DataFrame:
    """``keep`` and the columns that ``make`` gives for slices of ``col``."""
    names = [f.name for f in added]
    clash = {c.lower() for c in keep} & set(names)
    if clash:
        raise ValueError(f"columns {sorted(clash)} would stand twice")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                new = make(part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *new], names=[*keep, *names])

    kept = [F.col(f"`{c}`") for c in keep]
    plain = [c.alias(f"kept_{n}") for n, c in enumerate(kept)]  # Spark reads dots in the names of a function's input as fields
    rows = df.select(*plain, F.col(f"`{col}`").alias("value"))
    return rows.mapInArrow(run, StructType([*df.select(*kept).schema.fields, *added]))


def encode(df: DataFrame, text_col: str, model: str, keep: list[str], ends: bool = True, decoded: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``ids``: the packed little-endian 32-bit ids of every whole text.

    ``model`` is the path of a model file on each executor; one with rules that this module does not have
    is refused. A null or empty text has the begin and end ids only (nothing without ``ends``). Rows stay where they
    are, without a shuffle, and repeated rows are encoded each; other columns take no part, but ``keep`` must not
    hold ``ids``. With ``decoded``, the text decoded from the ids is added under that name by the same worker.
    """

    def make(texts):
        coder = _coder(model)
        packed = coder.encode(texts, ends)
        texts = [coder.decode(np.frombuffer(p, "<u4")) for p in packed] if decoded else []
        return [pa.array(packed, pa.binary()), *([pa.array(texts, pa.string())] if decoded else [])]

    added = [StructField("ids", BinaryType()), *([StructField(decoded, StringType())] if decoded else [])]
    return _mapped(df, text_col, keep, added, make)


def decode(df: DataFrame, ids_col: str, model: str, keep: list[str], out: str = "decoded") -> DataFrame:
    """The columns ``keep`` and the text of packed ids; null ids give an empty text."""

    def make(packed):
        coder = _coder(model)
        return [pa.array([coder.decode(np.frombuffer(p or b"", "<u4")) for p in packed], pa.string())]

    return _mapped(df, ids_col, keep, [StructField(out, StringType())], make)
