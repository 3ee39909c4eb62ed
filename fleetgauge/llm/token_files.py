"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is a run of frames, each holding the ids of whole documents as little-endian
unsigned 32-bit integers, then a skippable frame with the document index
(document key, frame, offset and length of each document), and last the seek table
of the seekable zstandard format: packed size, unpacked size and the low 32 bits of XXH64
of every frame. A reader takes the table from the file's end, the index next, and then inflates
only frames that hold a wanted document. Any zstandard tool can still unpack the file.

A folder has one file or more per range of document ids, and a table ``files`` with
each file's place in the order and the number of ids before it.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import LATIN, beyond_latin, other_rules, word_pattern
from .worker import per_worker

# Fixed values of the seekable format.
SKIPPABLE, SEEK_FRAME, SEEK_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80

FRAME_IDS = 1 << 18
FILE_IDS = 1 << 25
CACHE_WORDS = 400_000  # of each of two generations
ROWS = 512


class LibraryEncoder:
    """Packed ids as the tokenizers library gives them, asking it for each word only once.

    Texts within U+017F are split as the vocabulary's own pre-tokenizer does and the library encodes the
    words not met before; any other text, and one that holds a special token, goes to the library whole. So does every text if
    the file's rules are not those that ``bpe`` knows.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            self.whole = bool(other_rules(json.load(f)))
        self.words = word_pattern(LATIN).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        end = self.tokenizer.model.end_of_word_suffix
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if end and t.endswith(end)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Encode many words in one call, as a text of words between spaces; a token with the end mark closes each."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.closes[ids]) + 1
        if len(stops) == len(words):
            whole, starts = ids.tobytes(), [0, *stops[:-1].tolist()]
            for word, start, stop in zip(words, starts, stops.tolist(), strict=True):
                self.young[word] = whole[4 * start : 4 * stop]
        else:
            for word, enc in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
                self.young[word] = array("I", enc.ids).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.whole:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        plain = [not beyond_latin(t) and "İ" not in t and not any(s in t for s in self.special) for t in texts]
        split = [self.words(t.lower()) if p else None for t, p in zip(texts, plain, strict=True)]
        if len(self.young) > CACHE_WORDS:
            self.young, self.old = {}, self.young
        get = self.young.get
        found = [list(map(get, words)) if words is not None else [] for words in split]
        missing = {w for words, ids in zip(split, found, strict=True) if None in ids for w, i in zip(words, ids, strict=True) if i is None}
        fresh = [w for w in missing if w not in self.old]
        for word in missing.difference(fresh):
            self.young[word] = self.old[word]
        for start in range(0, len(fresh), 1000):
            self._learn(fresh[start : start + 1000])
        return [
            np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if words is None
            else b"".join(map(get, words) if None in ids else ids)
            for t, words, ids in zip(texts, split, found, strict=True)
        ]


def open_folder(path: str):
    fs, folder = pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)
    return fs, folder.rstrip("/")


class FrameWriter:
    """Writes one file; frames close at a document's end once they hold ``FRAME_IDS``."""

    def __init__(self, out):
        self.out, self.table, self.docs, self.held, self.size, self.n_ids = out, [], [], [], 0, 0
        self.pack = zstandard.ZstdCompressor(level=3)

    def add(self, key: int | None, packed: bytes) -> None:
        self.docs.append((key, len(self.table), self.size, len(packed) // 4))
        self.held.append(packed)
        self.size += len(packed)
        self.n_ids += len(packed) // 4
        if self.size >= 4 * FRAME_IDS:
            self._frame()

    def _frame(self) -> None:
        if self.size:
            raw = b"".join(self.held)
            frame = self.pack.compress(raw)
            self.out.write(frame)
            self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def close(self) -> None:
        self._frame()
        index = self.pack.compress(json.dumps(self.docs).encode())
        self.out.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        self.table.append((len(index) + 8, 0, 0))
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(entries) + 9) + entries)
        self.out.write(struct.pack("<IBI", len(self.table), CHECKSUMS, SEEK_MAGIC))
        self.out.close()


class FrameReader:
    """Documents of one file; ``inflated`` counts the frames that were unpacked."""

    def __init__(self, f):
        self.f, self.inflated = f, 0
        size = f.size()
        f.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        f.seek(size - 9 - 12 * n)
        entries = f.read(12 * n)
        self.table, at = [], 0
        for k in range(n):
            packed, raw, check = struct.unpack_from("<III", entries, 12 * k)
            self.table.append((at, packed, raw, check))
            at += packed
        at, packed, _, _ = self.table[-1]
        f.seek(at + 8)
        self.docs = json.loads(zstandard.ZstdDecompressor().decompress(f.read(packed - 8)))

    def frame(self, k: int) -> bytes:
        at, packed, size, check = self.table[k]
        self.f.seek(at)
        raw = zstandard.ZstdDecompressor().decompress(self.f.read(packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"checksum of frame {k}")
        self.inflated += 1
        return raw

    def documents(self, wanted=None):
        """(key, ids before it in the file, packed ids), in order, of all or only the wanted keys."""
        before, held, raw = 0, -1, b""
        for key, k, at, n in self.docs:
            if wanted is None or key in wanted:
                if n and k != held:
                    held, raw = k, self.frame(k)
                yield key, before, raw[at : at + 4 * n] if n else b""
            before += n


def write(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, folder: str, end_id: int | None = None) -> DataFrame:
    """Encode whole texts into files under ``folder`` in ascending id order; returns the table of files.

    A null text is empty and a null id comes first. Rows of one id are ordered by their
    text's hash; each is a document. ``end_id`` is appended to every document. Rows
    are dealt by ranges of (id, hash, row number), so one id in many rows is no hot spot. A task writes files under
    fresh names and returns them; files of lost or repeated attempts are in no table.
    """
    spark = docs.sparkSession
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches):
        encode, writer, found = per_worker(("library", tokenizer), lambda: LibraryEncoder(tokenizer)), None, []
        fs, path = open_folder(folder)
        part = TaskContext.get().partitionId()
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS):
                    rows = batch.slice(start, ROWS)
                    texts = [t or "" for t in rows.column(1).to_pylist()]
                    for key, packed in zip(rows.column(0).to_pylist(), encode(texts), strict=True):
                        if writer is None:
                            fs.create_dir(path, recursive=True)
                            name = f"ids-{uuid.uuid4().hex}.zst"
                            writer = FrameWriter(fs.open_output_stream(f"{path}/{name}", compression=None))
                        writer.add(key, packed + end)
                        if writer.n_ids >= FILE_IDS:
                            writer.close()
                            found.append((part, len(found), name, writer.n_ids, len(writer.docs)))
                            writer = None
        finally:
            if writer is not None:
                writer.close()
                found.append((part, len(found), name, writer.n_ids, len(writer.docs)))
        columns = list(zip(*found, strict=True)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["part", "seq", "name", "n_ids", "n_docs"])

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key, text = F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text")
    rows = docs.select(key, text, F.xxhash64(text_col).alias("hash"), F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(parts, "key", "hash", "row").sortWithinPartitions("key", "hash", "row")
    files = rows.select("key", "text").mapInArrow(run, "part int, seq int, name string, n_ids long, n_docs long")
    files.write.parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


def read(spark: SparkSession, folder: str, wanted: list[int] | None = None) -> DataFrame:
    """(key, start, ids) of all documents, or of the ids ``wanted``; ``ids`` is the packed binary.

    ``start`` counts the ids of all documents before. One task reads one file at a time.
    The list of files has one row per ``FILE_IDS`` ids, so its running sum is a small single window.
    """
    files = spark.read.parquet(f"{folder}/files")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    keys = None if wanted is None else set(wanted)

    def run(batches):
        fs, path = open_folder(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{path}/{name}") as f:
                    held, size = [], 0
                    for key, at, packed in FrameReader(f).documents(keys):
                        held.append((key, base + at, packed))
                        size += len(packed)
                        if size >= 4 << 20 or len(held) >= 10_000:
                            yield _rows(held)
                            held, size = [], 0
                    yield _rows(held)

    n = files.count()
    return files.repartition(max(1, n), "name").mapInArrow(run, "key long, start long, ids binary")


def _rows(held):
    columns = list(zip(*held, strict=True)) or [[]] * 3
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "start", "ids"])
