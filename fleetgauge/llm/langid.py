"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import hand_off

STEPS = 64  # bytes of a window
HIDDEN = 12
FIT_DOCS = 96  # labelled documents per language that a fit takes at most
FIT_PIECES, PIECE_CHARS = 16, 384  # of each: pieces spread over the whole text, and their length
WINDOWS = 2048
UNKNOWN = "und"
MOST_BROADCAST = 100_000  # ids and hashes of sampled documents that are sent to every executor


class Network:
    """Two recurrent passes over a window, forward and backward, and a softmax over languages at every byte.

    Each pass holds (table, recurrent, out): what a byte adds to the two gates and the candidate,
    what the state adds, and what the state gives to each language. Arrays are laid out
    (units, windows), so every gate is a run of whole rows.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        k = len(languages)
        self.weights = {}
        for side in "fb":
            self.weights["table" + side] = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
            self.weights["state" + side] = rng.normal(0, hidden**-0.5, (3 * hidden, hidden)).astype(np.float32)
            self.weights["out" + side] = rng.normal(0, hidden**-0.5, (k, hidden)).astype(np.float32)
        self.weights["bias"] = np.zeros((k, 1), np.float32)

    @classmethod
    def of(cls, languages: list[str], hidden: int, weights: dict) -> Network:
        network = cls(languages, hidden)
        network.weights = weights
        return network

    def _pass(self, side: str, x: np.ndarray, logits: np.ndarray, keep: list | None = None) -> None:
        """Adds what one direction gives to ``logits`` (steps, languages, windows); x is (steps, windows)."""
        h, n = self.hidden, x.shape[1]
        table, rec, out = (self.weights[w + side] for w in ("table", "state", "out"))
        state = np.zeros((h, n), np.float32)
        for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            gx = np.take(table, x[t], axis=1)
            gh = rec @ state
            gates = gx[: 2 * h]
            gates += gh[: 2 * h]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5  # reset, then update
            old = state
            part = gh[2 * h :]
            cand = part * gates[:h]
            cand += gx[2 * h :]
            np.tanh(cand, out=cand)
            state = old - cand
            state *= gates[h:]
            state += cand
            logits[t] += out @ state
            if keep is not None:
                keep.append((t, old, gates, part, cand, state))

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (steps, languages, windows) of the label of every byte of x (steps, windows)."""
        logits = np.broadcast_to(self.weights["bias"], (len(x), len(self.languages), x.shape[1])).copy()
        self._pass("f", x, logits)
        self._pass("b", x, logits)
        return _softmax(logits)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy of labels y (one per window, at every byte), and its gradients through time."""
        h, (steps, n) = self.hidden, x.shape
        logits = np.broadcast_to(self.weights["bias"], (steps, len(self.languages), n)).copy()
        kept = {"f": [], "b": []}
        for side in "fb":
            self._pass(side, x, logits, kept[side])
        delta = _softmax(logits)
        loss = -float(np.log(np.maximum(delta[:, y, np.arange(n)], 1e-12)).mean())
        delta[:, y, np.arange(n)] -= 1
        delta /= steps * n
        grads = {k: np.zeros_like(w) for k, w in self.weights.items()}
        grads["bias"] = delta.sum((0, 2))[:, None]
        for side in "fb":
            rec, out = self.weights["state" + side], self.weights["out" + side]
            later = np.zeros((h, n), np.float32)
            for t, old, gates, part, cand, state in reversed(kept[side]):
                grads["out" + side] += delta[t] @ state.T
                ds = out.T @ delta[t] + later
                reset, update = gates[:h], gates[h:]
                d_cand = ds * (1 - update) * (1 - cand * cand)
                d_update = ds * (old - cand) * update * (1 - update)
                d_reset = d_cand * part * reset * (1 - reset)
                d_x = np.concatenate([d_reset, d_update, d_cand])
                d_h = np.concatenate([d_reset, d_update, d_cand * reset])
                later = rec.T @ d_h + ds * update
                grads["state" + side] += d_h @ old.T
                hot = np.zeros((256, n), np.float32)
                hot[x[t], np.arange(n)] = 1
                grads["table" + side] += d_x @ hot.T
        return loss, grads

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 256, rate: float = 0.015, seed: int = 11) -> list[float]:
        """Adam over shuffled batches; x is (windows, steps). Returns the mean loss of each epoch."""
        rng, losses, step = np.random.default_rng(seed), [], 0
        first = {k: np.zeros_like(w) for k, w in self.weights.items()}
        second = {k: np.zeros_like(w) for k, w in self.weights.items()}
        total = epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order, seen = rng.permutation(len(x)), []
            for start in range(0, len(x), batch):
                rows = order[start : start + batch]
                loss, grads = self.gradients(np.ascontiguousarray(x[rows].T), y[rows])
                seen.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                now = rate * (1 - step / (total + 1))
                for k, g in grads.items():
                    g = g * min(1.0, 1.0 / max(norm, 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.weights[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            losses.append(float(np.mean(seen)))
        return losses

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probability of each language over all bytes of each text (documents, languages); no bytes give zeros."""
        out = np.zeros((len(texts), len(self.languages)))
        x, owner, fresh = windows_of(texts)
        for start in range(0, len(x), WINDOWS):
            part = slice(start, start + WINDOWS)
            probs = self.positions(np.ascontiguousarray(x[part].T))
            counted = np.arange(STEPS)[:, None, None] >= fresh[part, 0]
            counted &= np.arange(STEPS)[:, None, None] < fresh[part, 1]
            np.add.at(out, owner[part], (probs * counted).sum(0).T)
        size = np.array([max(1, len(t)) for t in texts])
        return out / size[:, None]


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, owner, fresh): every byte of every text in windows of ``STEPS``.

    The last window of a text ends at its end and may overlap the one before; a short text is filled with
    spaces. ``fresh`` is the range of places in a window that count, so every byte counts once.
    """
    starts, owner, fresh, at = [], [], [], 0
    for k, text in enumerate(texts):
        n = len(text)
        full = n // STEPS
        starts.append(at + STEPS * np.arange(full))
        fresh.append(np.repeat([[0, STEPS]], full, 0))
        if rest := n % STEPS:
            starts.append(np.array([at + max(0, n - STEPS)]))
            fresh.append(np.array([[STEPS - rest, STEPS] if full else [0, rest]]))
        owner.append(np.full(full + bool(rest), k))
        at += max(n, STEPS)
    joined = np.frombuffer(b"".join(t if len(t) >= STEPS else t.ljust(STEPS) for t in texts), np.uint8)
    if not starts:
        return np.zeros((0, STEPS), np.uint8), np.zeros(0, int), np.zeros((0, 2), int)
    starts = np.concatenate(starts).astype(int)
    return joined[starts[:, None] + np.arange(STEPS)], np.concatenate(owner), np.concatenate(fresh)


def fit(
    labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = FIT_DOCS, pieces: int = FIT_PIECES, piece_chars: int = PIECE_CHARS
) -> Network | None:
    """Train on at most ``per_language`` documents of each language, chosen by the hash of id and text.

    Of each document up to ``pieces`` pieces of ``piece_chars`` characters, spread over the whole text, are taken: these three numbers bound the
    sample. Rows that repeat id, text and language count once; rows with a null text or language are left out, and
    without any row there is no network. One task trains on the sample and the driver gets the weights.
    """
    usable = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    named = usable.select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("place"), F.xxhash64(text_col).alias("whole")
    ).distinct()
    # Texts whose hash lies in a share of its range that holds some times the wanted number; only these are ranked.
    sizes = named.groupBy("lang").agg(F.count("*").alias("n"))
    inside = (F.col("place").bitwiseAND((1 << 31) - 1) / 2.0**31) * F.col("n") <= 8 * per_language
    order = Window.partitionBy("lang").orderBy("place", "id", "whole")
    chosen = named.join(sizes, "lang").where(inside).withColumn("at", F.row_number().over(order)).where(F.col("at") <= per_language)
    chosen = hand_off(chosen.select("id", "lang", "whole", "at"), "language-sample")
    n_chosen = chosen.count()
    if not n_chosen:
        return None
    n = F.length("text")
    step = F.greatest(F.lit(piece_chars), F.ceil(n / pieces)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substring("text", i * step + 1, F.lit(piece_chars)))
    texts = usable.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).alias("t")
    small = (F.broadcast(chosen) if n_chosen <= MOST_BROADCAST else chosen).alias("c")
    same = F.col("t.id").eqNullSafe(F.col("c.id")) & (F.xxhash64("t.text") == F.col("c.whole")) & (F.col("t.lang") == F.col("c.lang"))
    sample = texts.join(small, same).select("t.lang", "c.at", cut.alias("pieces")).dropDuplicates(["lang", "at"])
    found = sample.repartition(1).mapInArrow(_trained, "network binary").collect()
    return Network.of(*pickle.loads(found[0][0])) if found else None


def _trained(batches):
    """One network for all rows of the sample."""
    rows = sorted((r["lang"], r["at"], r["pieces"]) for batch in batches for r in batch.to_pylist())
    if not rows:
        return
    languages = sorted({r[0] for r in rows})
    texts = [[p.encode() for p in pieces if len(p) >= STEPS // 2] for _, _, pieces in rows]
    labels = [languages.index(r[0]) for r, t in zip(rows, texts, strict=True) for _ in t]
    x, owner, _ = windows_of([p for t in texts for p in t])
    y = np.array(labels, int)[owner] if labels else np.zeros(0, int)
    network = Network(languages)
    # Languages with fewer windows are repeated, so each weighs the same.
    counts = np.bincount(y, minlength=len(languages))
    rows_of = [np.resize(np.flatnonzero(y == k), counts.max()) for k in range(len(languages)) if counts[k]]
    if rows_of and len(languages) > 1:
        picked = np.concatenate(rows_of)
        network.fit(x[picked], y[picked])
    state = (network.languages, network.hidden, network.weights)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], names=["network"])


BATCH_BYTES = 4 << 20


def predict(docs: DataFrame, text_col: str, network: Network | None, keep: list[str], lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """The columns ``keep``, the predicted language and its mean probability over all bytes of the whole text.

    A null text and one without a letter are ``und`` with score 0, as is everything without a network.
    Ties go to the first language in alphabetical order. Rows stay where they are. ``keep`` may hold the
    text and columns of any name but ``lang`` and ``score``.
    """
    where = keep.index(text_col) if text_col in keep else len(keep)

    def run(batches):
        for batch in batches:
            texts = batch.column(where)
            start = 0
            while start < batch.num_rows:
                stop, size, part = start, 0, []
                while stop < batch.num_rows and (not part or size < BATCH_BYTES):
                    text = texts[stop].as_py() or ""
                    part.append(text.encode() if network is not None and any(map(str.isalpha, text)) else b"")
                    size += len(part[-1])
                    stop += 1
                names, scores = [UNKNOWN] * len(part), [0.0] * len(part)
                if size:
                    probs = network.documents(part)
                    for k, row in enumerate(probs):
                        if part[k]:
                            best = int(row.argmax())
                            names[k], scores[k] = network.languages[best], min(1.0, float(row[best]))
                kept = [c.slice(start, stop - start) for c in batch.columns[: len(keep)]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, lang, score])
                start = stop

    rows = docs.select(*keep) if where < len(keep) else docs.select(*keep, text_col)
    schema = docs.select(*keep).schema.add(lang, "string").add(score, "double")
    return rows.mapInArrow(run, schema)


def held_out(id_col: str) -> Column:
    """Rows kept from training: the CRC-32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
