"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split skewed join is worth the extra exchange a parent may then need.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    # Call sites of every column expression cost round trips while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str, cpus: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    on_cluster = not _is_one_process(spark)
    if folder:
        if on_cluster:
            _check_shared(spark, folder)
        return folder
    if on_cluster:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="fleetgauge-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _is_one_process(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


_shared: set[tuple[str, str]] = set()


def _check_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a folder that is not the same on all machines, such as a local one.

    Tasks write a few small files; unless the driver's listing finds them all, some
    went to another machine's disk. Done once per application and folder.
    """
    key = (spark.conf.get("spark.app.id", ""), folder)
    if key in _shared:
        return
    probe, n = os.path.join(folder, f"probe-{uuid.uuid4().hex}"), 8
    spark.range(0, n, 1, n).write.parquet(probe)
    try:
        found = spark.read.schema("id long").parquet(probe).count()
    except Exception as error:
        raise ValueError(f"{folder} is not readable from every executor") from error
    finally:
        delete_folder(spark, probe)
    if found != n:
        raise ValueError(f"{folder} is local to each machine; set spark.checkpoint.dir to a shared one")
    _shared.add(key)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a stored table; in a store that only Spark opens an empty table is left in its place."""
    try:
        files, folder = pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)
        if files.get_file_info(folder).type != pafs.FileType.NotFound:
            files.delete_dir(folder)
    except (pa.ArrowException, OSError):
        spark.range(0).write.mode("overwrite").parquet(path)


def compile_wide_rows(spark: SparkSession) -> None:
    """Have the session run steps over very many columns as separate ones, where one method for all is too large.

    Java does not compile methods above 8000 bytes of code, but interprets them row by row. Spark's own limit is far above.
    """
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit", None)
    if limit is None or int(limit) > 8000:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


_written: list[tuple[str, str]] = []
_named: dict[str, str] = {}  # of interim tables that the catalogue knows: their names by path


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Note a stored table under a name as an interim one, for ``drop_hand_offs``."""
    _written.append((spark.sparkContext.applicationId, path))
    _named[path] = name


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder for tables that are only needed until ``drop_hand_offs``."""
    path = os.path.join(work_folder(spark), f"{label}-{uuid.uuid4().hex}")
    _written.append((spark.sparkContext.applicationId, path))
    return path


def hand_off(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Unlike a cached frame the result survives lost executors, and unlike a row
    checkpoint it stays columnar, so later scans still prune columns.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_hand_offs(spark: SparkSession, since: int = 0) -> int:
    """Delete the interim tables this application has written, from the ``since``-th on; call it when results are stored."""
    app = spark.sparkContext.applicationId
    mine = [path for owner, path in _written if owner == app][since:]
    for path in mine:
        if path in _named:
            spark.sql(f"DROP TABLE IF EXISTS {_named.pop(path)}")
        delete_folder(spark, path)
    _written[:] = [(owner, path) for owner, path in _written if owner != app or path not in set(mine)]
    return len(mine)


@contextmanager
def interim(spark: SparkSession) -> Iterator[None]:
    """Deletes the interim tables written inside, at the end, also after an error.

    What is returned from inside must be computed by then: a model, a count or a stored table.
    """
    app = spark.sparkContext.applicationId
    before = sum(owner == app for owner, _ in _written)
    try:
        yield
    finally:
        drop_hand_offs(spark, before)
