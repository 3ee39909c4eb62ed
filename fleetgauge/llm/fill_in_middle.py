"""Fill-in-middle transformation: texts cut at two unit boundaries, their middle moved to the end.

The boundaries of a text's units lie in a ``BoundarySet``; both cuts are one select each. The cuts,
and whether and how a text is rearranged, follow from a hash of the seed and the id alone, so a
retried task and another cluster give the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .boundary_set import BoundarySet

ROWS = 256


@dataclass(frozen=True)
class Settings:
    """``percent`` of the texts are rearranged, ``spm_percent`` of those with the suffix first.

    The marks must not contain each other, nor may the end of one be the start of another:
    then each stands once in a rearranged text, and the text can be put together again.
    """

    seed: str = "7"
    percent: int = 100
    spm_percent: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.marks
        for a in marks:
            for b in marks:
                if not a or (a is not b and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError("the marks must be told apart wherever they stand")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def line_ends(text: str) -> np.ndarray:
    """Offsets in code points at which a line ends: after each line feed, and at the end of the text."""
    if text.isascii():
        points = np.frombuffer(text.encode("ascii"), np.uint8)
    else:
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.flatnonzero(points == 10) + 1
    return ends if not len(points) or (len(ends) and ends[-1] == len(points)) else np.append(ends, len(points))


def transform(text: str, key: str, settings: Settings) -> tuple[int, str, int | None, int | None, str]:
    """(n units, form, code points of the prefix, of the middle, output) of one text; ``key`` is the id as text."""
    units = BoundarySet(line_ends(text))
    n = len(units)
    digest = hashlib.sha256(f"{settings.seed}:{key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in settings.marks) or h[2] % 100 >= settings.percent:
        return n, "plain", None, None, text
    cuts = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (units.select(k - 1) if k else 0 for k in cuts)
    before, between, after = text[:a], text[a:b], text[b:]
    p, s, m = settings.marks
    if h[3] % 100 < settings.spm_percent:
        return n, "spm", a, b - a, f"{s}{after}{p}{before}{m}{between}"
    return n, "psm", a, b - a, f"{p}{before}{s}{after}{m}{between}"


ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def rearrange(df: DataFrame, id_col: str, text_col: str, keep: Sequence[str], settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """The columns ``keep`` and n, form, prefix_chars, middle_chars and output of every whole text.

    Rows stay where they are: no shuffle, no state, and a task holds a few hundred texts. A null text counts as
    empty; a null id is hashed as empty text; rows that repeat are rearranged each, alike. Other columns,
    whatever their names, take no part; ``keep`` must not hold one of the added names.
    """
    clash = {c.lower() for c in keep} & set(ADDED)
    if clash:
        raise ValueError(f"columns {sorted(clash)} would stand twice")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts, ids = part.column(len(keep)), part.column(len(keep) + 1)
                made = [transform(t.as_py() or "", i.as_py() or "", settings) for t, i in zip(texts, ids, strict=True)]
                columns = zip(*made, strict=True)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                new = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *new], names=[*keep, *ADDED])

    kept = [F.col(f"`{c}`") for c in keep]
    plain = [c.alias(f"kept_{n}") for n, c in enumerate(kept)]  # Spark reads dots in the names of a function's input as fields
    rows = df.select(*plain, F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{id_col}`").cast("string").alias("id"))
    kinds = (LongType(), StringType(), LongType(), LongType(), StringType())
    added = [StructField(c, k) for c, k in zip(ADDED, kinds, strict=True)]
    return rows.mapInArrow(run, StructType([*df.select(*kept).schema.fields, *added]))


def restore(output: Column | str, form: Column | str, settings: Settings = Settings()) -> Column:  # noqa: B008
    """The text that a rearranged one was made of, by its marks alone."""
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    before = lambda c, mark: F.substring_index(c, mark, 1)
    after = lambda c, mark: F.substring_index(c, mark, -1)
    p, s, m = settings.marks
    tail = after(out, m)
    psm = F.concat(after(before(out, s), p), tail, before(after(out, s), m))
    spm = F.concat(before(after(out, p), m), tail, before(after(out, s), p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(out)
