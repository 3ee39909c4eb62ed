"""The parts of a SentencePiece model file that encoding needs, read from its stored messages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Fixed values of the file format: field numbers of its messages, kinds of model and of piece.
PIECE, TRAINER, NORMALIZER, DENORMALIZER = 1, 2, 3, 5
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
MODEL_KIND, SPACE_AS_SUFFIX, BYTE_FALLBACK = 3, 24, 35
UNKNOWN_SURFACE, BEGIN_PIECE, END_PIECE = 44, 46, 47
CHARS_MAP, DUMMY_PREFIX, EXTRA_SPACE, ESCAPE_SPACE = 2, 3, 4, 5
BPE = 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one message; numbers as they are, everything else as bytes."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _number(data, at)
        else:
            if kind == 2:
                size, at = _number(data, at)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError("not a model file")
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass(frozen=True)
class PieceModel:
    pieces: list[str]
    scores: np.ndarray  # float32
    kinds: np.ndarray
    begin: int
    end: int
    dummy_prefix: bool
    unknown_text: str


def read_model(path: str) -> PieceModel:
    """A BPE model with byte fallback and plain texts; raises ValueError on what the encoder does not do."""
    with open(path, "rb") as f:
        data = f.read()
    pieces, scores, kinds = [], [], []
    parts: dict[int, dict] = {TRAINER: {}, NORMALIZER: {}, DENORMALIZER: {}}
    for field, value in _fields(data):
        if field == PIECE:
            piece = dict(_fields(value))
            pieces.append(piece[PIECE_TEXT].decode())
            scores.append(np.frombuffer(piece.get(PIECE_SCORE, bytes(4)), "<f4")[0])
            kinds.append(piece.get(PIECE_KIND, NORMAL))
        elif field in parts:
            parts[field] = dict(_fields(value))
    trainer, normalizer = parts[TRAINER], parts[NORMALIZER]
    refused = {
        "not byte-pair encoding": trainer.get(MODEL_KIND, 1) != BPE,
        "no byte fallback": not trainer.get(BYTE_FALLBACK, 0) or kinds.count(BYTE) != 256,
        "spaces as suffixes": bool(trainer.get(SPACE_AS_SUFFIX, 0)),
        "a character map": bool(normalizer.get(CHARS_MAP, b"")) or bool(parts[DENORMALIZER].get(CHARS_MAP, b"")),
        "removal of spaces": bool(normalizer.get(EXTRA_SPACE, 1)),
        "spaces left as they are": not normalizer.get(ESCAPE_SPACE, 1),
        "unused or user-defined pieces": USER in kinds or UNUSED in kinds,
    }
    if any(refused.values()):
        raise ValueError(f"{path}: not supported: " + ", ".join(k for k, v in refused.items() if v))
    named = {p: i for i, p in enumerate(pieces)}
    return PieceModel(
        pieces,
        np.array(scores, np.float32),
        np.array(kinds),
        named[trainer.get(BEGIN_PIECE, b"<s>").decode()],
        named[trainer.get(END_PIECE, b"</s>").decode()],
        bool(normalizer.get(DUMMY_PREFIX, 1)),
        trainer.get(UNKNOWN_SURFACE, " ⁇ ".encode()).decode(),
    )
