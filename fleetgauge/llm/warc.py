"""WARC archives as a Spark data source, and a writer that stores equal payloads once.

``register(spark)`` makes the format ``warc`` known:

* ``df.write.format("warc").mode("append").save(folder)`` writes rows of ``SCHEMA`` as gzip members,
  one per record. Each member's header names its own length (the "sl" field of the
  format's compression annex), so a reader can step over it.
* ``spark.read.format("warc").load(folder)`` reads them. Files are dealt out to
  partitions of about ``partition_bytes``. Filters on header columns (``=``, ``IN``,
  ``LIKE 'x%'``, null tests) are checked right after the header lines are inflated; the
  payload of a record that fails them, and every payload under ``option("payload",
  "false")``, is neither inflated nor decoded.

Files get their final names only when the job commits: tasks write under names of
their own and the driver then lists the files of successful tasks in a manifest, so
files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, payload_digest string, "
    "payload_length long, refers_to string, payload string"
)
# Header names of the format, by column.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
    "refers_to": "WARC-Refers-To",
}
COLUMN_OF = {name.lower(): col for col, name in HEADERS.items()}
GZIP_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x04\xff"  # deflate, with an extra field
MANIFEST = "_manifest-"
FILE_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


def register(spark: SparkSession) -> None:
    """Make the format known and let Spark hand filters to it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only added to; write to a new folder instead of overwriting")
        return WarcWriter(self.options["path"])


def _files(path: str):
    fs, folder = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs, folder.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path):
        self.path = path

    def write(self, iterator):
        fs, folder = _files(self.path)
        fs.create_dir(folder, recursive=True)
        out, done, size = None, [], 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        done.append([f"part-{uuid.uuid4().hex}.warc.gz", 0])
                        out = fs.open_output_stream(f"{folder}/{done[-1][0]}", compression=None)
                    member = encode_record(row)
                    out.write(member)
                    done[-1][1] += len(member)
                    if done[-1][1] >= FILE_BYTES:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(done)

    def commit(self, messages):
        fs, folder = _files(self.path)
        fs.create_dir(folder, recursive=True)
        names = [f for m in messages if m is not None for f in m.files]
        with fs.open_output_stream(f"{folder}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages):
        fs, folder = _files(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else ():
                fs.delete_file(f"{folder}/{name}")


def _clean(value) -> str:
    """A header value: line ends and other control characters as %XX."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in str(value))


def encode_record(row: dict) -> bytes:
    """One record as a gzip member whose extra field holds its packed and unpacked length."""
    block = (row.get("payload") or "").encode()
    lines = ["WARC/1.1"]
    lines += [f"{name}: {_clean(row[col])}" for col, name in HEADERS.items() if row.get(col) is not None]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    raw = "\r\n".join(lines).encode() + block + b"\r\n\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = pack.compress(raw) + pack.flush()
    extra = b"sl" + struct.pack("<HII", 8, len(body) & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    return GZIP_HEAD + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


@dataclass
class Files(InputPartition):
    names: list

    def __init__(self, names):
        self.names = names


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.partition_bytes = int(options.get("partition_bytes", 32 << 20))
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.tests = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") else None
            if column in HEADERS and column != "payload_length" and isinstance(f, (EqualTo, In, StringStartsWith, IsNull, IsNotNull)):
                self.tests.append((type(f).__name__, column, f.value if hasattr(f, "value") else None))
            else:
                yield f

    def partitions(self):
        fs, folder = _files(self.path)
        files = []
        for info in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if info.base_name.startswith(MANIFEST):
                with fs.open_input_stream(info.path) as f:
                    files += json.loads(f.read())
        parts, size = [], 0
        for name, n in sorted(files):
            if not parts or size + n > self.partition_bytes:
                parts.append(Files([]))
                size = 0
            parts[-1].names.append(name)
            size += n
        return parts or [Files([])]

    def read(self, partition):
        fs, folder = _files(self.path)
        for name in partition.names:
            with fs.open_input_file(f"{folder}/{name}") as f:
                yield from _batches(read_records(f, self.tests, self.payload))


def _batches(records):
    held, size = [], 0
    for row in records:
        held.append(row)
        size += len(row["payload"] or "") + 200
        if size >= BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows):
    kinds = {c: pa.int64() if c == "payload_length" else pa.string() for c in [*HEADERS, "payload"]}
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in kinds.items()], names=list(kinds))


def _fits(row, tests) -> bool:
    for kind, column, value in tests:
        have = row.get(column)
        if kind == "IsNull":
            ok = have is None
        elif have is None:
            ok = False
        elif kind == "EqualTo":
            ok = have == value
        elif kind == "In":
            ok = have in value
        else:
            ok = kind == "IsNotNull" or have.startswith(value)
        if not ok:
            return False
    return True


def read_records(f, tests=(), payload=True):
    """Rows of one archive; only as much of a member is inflated as headers and filters ask for."""
    size, at = f.size(), 0
    while at < size:
        f.seek(at)
        head = f.read(24)
        if head[:4] != GZIP_HEAD[:4] or head[12:14] != b"sl":
            raise ValueError(f"no record at byte {at}")
        packed, _ = struct.unpack_from("<II", head, 16)
        inflate = zlib.decompressobj(-15)
        taken = min(packed, 1024)
        text, rest = b"", f.read(taken)
        while b"\r\n\r\n" not in text:
            if not rest and taken < packed:
                rest = f.read(min(packed - taken, 4096))
                taken += len(rest)
            more = inflate.decompress(rest, 2048)
            rest = inflate.unconsumed_tail
            if not more and not rest and taken >= packed:
                raise ValueError(f"no end of headers at byte {at}")
            text += more
        lines, _, start = text.partition(b"\r\n\r\n")
        row, length = dict.fromkeys([*HEADERS, "payload"]), 0
        for line in lines.decode().split("\r\n")[1:]:
            key, _, value = line.partition(": ")
            if key.lower() == "content-length":
                length = int(value)
            elif key.lower() in COLUMN_OF:
                row[COLUMN_OF[key.lower()]] = value
        if row["payload_length"] is not None:
            row["payload_length"] = int(row["payload_length"])
        if _fits(row, tests):
            if payload:
                tail = rest + f.read(packed - taken)
                whole = text + inflate.decompress(tail) + inflate.flush()
                f.seek(at + 24 + packed)
                if zlib.crc32(whole) != struct.unpack("<I", f.read(4))[0]:
                    raise ValueError(f"checksum of the record at byte {at}")
                row["payload"] = whole[len(lines) + 4 :][:length].decode()
            yield row
        at += 24 + packed + 8


def to_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int = 1000) -> DataFrame:
    """Rows of ``SCHEMA``: a response per page, or a revisit where an equal payload is stored.

    Of pages with equal payloads of at least ``least_bytes`` the one with the largest id
    is the response and the others refer to it; rows that repeat that id are responses
    too. A null payload is empty, a null id stands as 'null' and never
    is the largest while another is there; a null url leaves the header out.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("length"),
    )
    kept = (
        pages.select(F.col(id_col).alias("id"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("length"))
        .where(F.col("length") >= least_bytes).groupBy("digest").agg(F.max("id").alias("kept"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "kept")
    )
    again = F.col("kept").isNotNull() & ~F.col("kept").eqNullSafe(F.col("id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    return rows.join(kept, "digest", "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        urn("id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit("2024-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.col("length").alias("payload_length"),
        F.when(again, urn("kept")).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
    )
