"""Near-duplicate classes by Order MinHash, verified by banded alignment."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import hand_off
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 32
PICKS = 5  # minima of a sketch, kept in text order
FEW = 50  # shingles; two texts of which one has fewer are met by exact keys
CACHE_WORDS = 150_000
BATCH_BYTES = 4 << 20

_word = re.compile(r"\w+").findall
_mix = np.uint64(0x9E3779B97F4A7C15)
_factors = np.random.default_rng(20_24).integers(1, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Hashes of runs of ``n`` words; a text of fewer words has one run of all its words."""

    def __init__(self, n: int = SHINGLE):
        self.n, self.cache = n, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = _word((text or "").lower())
        if not words:
            return np.zeros(0, np.uint64)
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(h))
        out = h[: len(h) - n + 1].copy()
        for k in range(1, n):
            out = (out ^ (out >> np.uint64(31))) * _mix + h[k : len(h) - n + 1 + k]
        out = (out ^ (out >> np.uint64(29))) * _mix
        return out ^ (out >> np.uint64(32))


def _labelled(shingles: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence number, so repeats within a text are different elements."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    occurrence = np.empty(len(ranked), np.uint64)
    occurrence[order] = np.arange(len(ranked)) - np.repeat(first, np.diff(np.append(first, len(ranked))))
    labelled = (shingles + occurrence * np.uint64(0xC2B2AE3D27D4EB4F)) * _mix
    return labelled ^ (labelled >> np.uint64(31))


def candidate_keys(shingles: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """Keys of which two texts that reach ``least`` share one: always if one has fewer than ``FEW`` shingles, else as sketches do."""
    few = exact_keys(shingles, least) if len(shingles) * least < FEW else np.zeros(0, np.uint64)
    return np.concatenate([few, sketch(shingles)]) if len(shingles) >= FEW else few


def exact_keys(shingles: np.ndarray, least: float) -> np.ndarray:
    """Pairs of shingles from the start of the text's shingles in hash order.

    Of n shingles a text that reaches ``least`` shares n * ``least`` at least. The second of the shared ones
    in hash order has all others of them behind it, so it is among the first n - n * ``least`` + 2 of both texts. Where one shared
    shingle is enough, single shingles are keys too.
    """
    ranked = np.sort(_labelled(shingles))
    need = max(1, int(np.ceil(len(ranked) * least - 1e-9)))
    first, second = np.triu_indices(min(len(ranked), len(ranked) - need + 2), 1)
    keys = (ranked[first] ^ (ranked[second] >> np.uint64(29))) * _mix + ranked[second]
    keys ^= keys >> np.uint64(32)
    return np.concatenate([keys, ranked * _mix]) if need == 1 else keys


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One key per sketch: the ``PICKS`` smallest labelled shingles under its order, hashed in text order."""
    labelled = _labelled(shingles)
    take = min(PICKS, len(labelled))
    step = SKETCHES if len(labelled) < 50_000 else 1
    keys = np.empty(SKETCHES, np.uint64)
    for start in range(0, SKETCHES, step):
        values = labelled[None, :] * _factors[start : start + step, None]
        at = np.argpartition(values, take - 1, axis=1)[:, :take] if take < len(labelled) else np.tile(np.arange(take), (len(values), 1))
        at.sort(axis=1)
        key = np.arange(start + 1, start + 1 + len(values)).astype(np.uint64) * _mix
        for column in labelled[at].T:
            key = (key ^ column) * _mix
            key ^= key >> np.uint64(29)
        keys[start : start + step] = key
    return keys


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned shingles over all shingles of both texts, or 0 where it cannot reach ``least``.

    The longest common subsequence is taken within a band of the alignment matrix. To reach
    ``least`` at most n (1 - least) / (1 + least) of the n shingles of both texts may stay unaligned, which bounds how far an
    alignment can stray from the diagonal: the band loses nothing. Rows are bit sets.
    """
    n, m = len(a), len(b)
    if min(n, m) < least * max(n, m) or not n or not m:
        return 0.0
    both = min(n, m)
    differ = np.flatnonzero(a[:both] != b[:both])
    head = int(differ[0]) if len(differ) else both
    differ = np.flatnonzero(a[n - both + head :][::-1] != b[m - both + head :][::-1])
    tail = int(differ[0]) if len(differ) else both - head
    band = int((n + m) * (1 - least) / (1 + least)) + 1
    x, y = a[head : n - tail].tolist(), b[head : m - tail].tolist()
    common = head + tail
    if x and y:
        if len(x) + len(y) > 2 * band:  # more unaligned than allowed, unless some of the middle aligns
            shared = set(x) & set(y)
            if sum(v not in shared for v in chain(x, y)) > band:
                return 0.0
        places: dict[int, int] = {}
        for k, v in enumerate(y):
            places[v] = places.get(v, 0) | 1 << k
        full = (1 << len(y)) - 1
        width = (1 << (2 * band + 1)) - 1
        row = full
        for i, v in enumerate(x):
            hit = places.get(v, 0)
            if hit:
                low = i - band
                hit &= (width << low) if low > 0 else (width >> -low)
                part = row & hit
                row = ((row + part) | (row - part)) & full
        common += len(y) - row.bit_count()
    found = common / (n + m - common)
    return found if found >= least else 0.0


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many shingles both have, with multiplicity: no alignment is longer."""
    (x, n), (y, m) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def _sketches(least):
    def run(batches):
        shingle = Shingler()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start in range(0, batch.num_rows, 1024):
                same, keys, kept = [], [], []
                for k in range(start, min(start + 1024, batch.num_rows)):
                    h = shingle(texts[k].as_py())
                    kept.append(ids[k].as_py())
                    same.append(xxhash.xxh3_128_hexdigest(h.tobytes()) if len(h) else None)
                    keys.append(candidate_keys(h, least).view(np.int64) if len(h) else np.zeros(0, np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(keys), pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(same, pa.string()), lists], names=["id", "same", "keys"])

    return run


def _sequences(batches):
    shingle = Shingler()
    for batch in batches:
        held, size = [], 0
        for k in range(batch.num_rows):
            held.append((batch.column(0)[k].as_py(), shingle(batch.column(1)[k].as_py()).astype(np.uint32).tobytes()))
            size += len(held[-1][1])
            if size > BATCH_BYTES:
                yield _two(held)
                held, size = [], 0
        yield _two(held)


def _counted(batches):
    """(shingle, id, times) of each sequence."""
    for batch in batches:
        for k in range(batch.num_rows):
            shingle, times = np.unique(np.frombuffer(batch.column(1)[k].as_buffer(), np.int32), return_counts=True)
            ids = np.full(len(shingle), batch.column(0)[k].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(ids), pa.array(times.astype(np.int64))], names=["shingle", "id", "times"])


def _alignable(sequences: DataFrame) -> DataFrame:
    """(id, n, free): the shingles of a text, and how many of them any other of these texts has.

    No alignment with another of them can be longer than ``free``.
    """
    alone = (
        sequences.mapInArrow(_counted, "shingle int, id long, times long").groupBy("shingle")
        .agg(F.count("*").alias("texts"), F.min("id").alias("id"), F.min("times").alias("times")).where("texts = 1")
        .groupBy("id").agg(F.sum("times").alias("alone"))
    )
    sizes = sequences.groupBy("id").agg(F.min(F.octet_length("seq") / 4).alias("n"), F.max(F.octet_length("seq") / 4).alias("most"), F.count("*").alias("rows"))
    free = F.when(F.col("rows") == 1, F.col("most") - F.coalesce("alone", F.lit(0))).otherwise(F.col("most"))
    return sizes.join(alone, "id", "left").select("id", "n", free.alias("free"))


def _two(held):
    return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.binary())], names=["id", "seq"])


def _verified(least):
    def run(batches):
        for batch in batches:
            score, shared = [], []
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint32) for c in (2, 3))
                shared.append(_overlap(x, y))
                enough = shared[-1] >= least * (len(x) + len(y) - shared[-1])
                score.append(aligned_similarity(x, y, least) if enough else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array(shared, pa.int64())], names=["a", "b", "similarity", "overlap"]
            )

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(id, class_id, copy_of): one row per given row; the class of a document is its smallest id.

    Two texts are linked where the shingles of five words that align in order are at least ``least`` of all
    their shingles; classes are the connected texts. Texts with the same words are copies (``copy_of`` is the smallest id
    of the same words) and stand for one text. Each text of ``FEW`` shingles
    or more gives ``SKETCHES`` keys; a pair of them at 0.8 shares none with a probability below 1e-5. A pair of which one text has fewer always
    shares one of the keys in ``exact_keys``.

    Texts with a common key are not paired with each other. Shingles that no other text in a bucket
    has bound the alignment of a text with any other, and pairs that cannot reach ``least`` by these bounds are ruled out without a loss.
    First each text is aligned with one centre of its bucket, the member with the smallest share of shingles of its own, so a bucket of any
    size gives one pair per row, and the links found are joined to components. Then only members
    outside the largest component of a bucket are aligned with members of other components, if they can reach ``least``: two texts
    share at most what the one with less of it shares with the centre, and of the rest only what is not their own.

    Null texts and texts without a word are in no bucket: each keeps its own id as class. Rows with a null id get a
    class only as copies or where linked by a copy. Rows that share an id share a class. No other column is looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketches = hand_off(rows.mapInArrow(_sketches(least), "id long, same string, keys array<long>"), "sketches")
    texts = (
        sketches.where("same IS NOT NULL").groupBy("same").agg(F.min("id").alias("copy_of"), F.first("keys").alias("keys")).where("copy_of IS NOT NULL")
    )
    texts = hand_off(texts, "texts")
    members = texts.select(F.col("copy_of").alias("id"), F.explode("keys").alias("key"))
    # A stored aggregate leaves the join with plain shuffles on both sides, whose hot keys Spark can split.
    several = hand_off(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "keys")
    shared = hand_off(members.join(several, "key"), "buckets")
    involved = shared.select("id").distinct()
    sequences = hand_off(rows.join(involved, "id", "left_semi").mapInArrow(_sequences, "id long, seq binary").distinct(), "sequences")
    able = _alignable(sequences).where(F.col("free") >= least * F.col("n"))
    live = hand_off(shared.join(able, "id"), "able")

    def verify(pairs: DataFrame) -> DataFrame:
        left, right = sequences.withColumnsRenamed({"id": "a", "seq": "seq_a"}), sequences.withColumnsRenamed({"id": "b", "seq": "seq_b"})
        met = pairs.join(left, "a").join(right, "b").select("a", "b", "seq_a", "seq_b")
        return met.mapInArrow(_verified(least), "a long, b long, similarity double, overlap long")

    centre = live.groupBy("key").agg(F.max(F.struct(F.col("free") / F.col("n"), -F.col("id"))).alias("c"))
    live = live.join(centre.select("key", (-F.col("c.col2")).alias("centre")), "key")
    stars = live.where("centre <> id").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    stars = hand_off(verify(stars).groupBy("a", "b").agg(F.max("similarity").alias("similarity"), F.max("overlap").alias("overlap")), "stars")
    links = stars.where("similarity > 0").select("a", "b")
    labels = components(links)

    placed = live.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    sizes = placed.groupBy("key", "label").agg(F.count("*").alias("n"))
    top = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    overlap = stars.select(F.col("a").alias("centre"), F.col("b").alias("id"), "overlap")
    open_rows = placed.join(top.select("key", F.col("top.label").alias("main")), "key").join(overlap, ["centre", "id"], "left")
    open_rows = open_rows.join(texts.select(F.col("copy_of").alias("id"), "keys"), "id")
    open_rows = hand_off(open_rows.select("key", "id", "label", "main", "n", "free", F.coalesce("overlap", "n").alias("near"), "keys"), "open")
    outside = open_rows.where("label <> main").select("key", *[F.col(c).alias(f"{c}_a") for c in ("id", "label", "n", "free", "near", "keys")])
    most = F.least("near", "near_a") + F.least(F.col("free") - F.col("near"), F.col("free_a") - F.col("near_a"))
    can = most >= least * (F.col("n") + F.col("n_a") - most)
    common = F.array_intersect("keys", "keys_a")
    once = F.array_min(common) == F.col("key")  # of all buckets of a pair, one passes it on
    met = outside.join(open_rows, "key").where((F.col("label") != F.col("label_a")) & can & once)
    again = met.select(F.least("id_a", "id").alias("a"), F.greatest("id_a", "id").alias("b")).distinct()
    more = hand_off(verify(again).where("similarity > 0").select("a", "b"), "more-links")
    labels = components(links.unionByName(more))

    named = texts.select("same", "copy_of").join(labels.select(F.col("id").alias("copy_of"), "label"), "copy_of", "left")
    named = named.select("same", "copy_of", F.coalesce("label", "copy_of").alias("class_id"))
    # A document with several rows takes the class of each of its texts through the shared id.
    return sketches.select("id", "same").join(named, "same", "left").select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("copy_of", "id").alias("copy_of"))
