"""Relational tables over JDBC. Connection details are always the caller's."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import nan_to_null
from ..session import hand_off, interim
from .files import to_store
from .scan import extract

READ_ROWS = 50_000
WRITE_ROWS = 10_000
# Table of the batches that were written whole.
BATCHES = "written_batches"


def jdbc_read(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    fetchsize: int = READ_ROWS,
    partition: tuple[str, object, object, int] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table, read in ``fetchsize`` rows per round trip.

    ``partition`` (column, lower, upper, parts) splits the read over that many
    tasks; the bounds only place the cuts, no row is left out.
    """
    reader = (
        spark.read.format("jdbc")
        .options(**(options or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", fetchsize)
    )
    if partition:
        column, lower, upper, parts = partition
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", parts)
        )
    return nan_to_null(reader.load())


def quantile_predicates(keys: DataFrame, parts: int) -> list[str]:
    """SQL conditions on the one numeric column of ``keys`` that cut its rows into at most ``parts`` parts of like size.

    Each row meets one of them, a null key the first. A value is never divided, so a part is larger only by what a single
    value holds.
    """
    name = keys.columns[0]
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    cuts = keys.agg(F.percentile_approx(name, shares, 100 * parts)).first()[0] if parts > 1 else None
    cuts = sorted(set(cuts or []))
    if not cuts:
        return ["1 = 1"]
    inner = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{name} <= {cuts[0]} OR {name} IS NULL", *inner, f"{name} > {cuts[-1]}"]


def jdbc_read_balanced(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    parts: int,
    *,
    fetchsize: int = READ_ROWS,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table, read over ``parts`` connections that get like numbers of rows, however the numeric ``key`` is spread.

    The key column is read once before, over as many connections with even ranges, for its quantiles; even ranges alone would
    leave most rows to one connection where keys crowd.
    """
    given = dict(options or {})
    ends = jdbc_read(spark, url, f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}) ends", options=given).first()
    only = f"(SELECT {key} FROM {table}) keys"
    spread = None if ends[0] is None or ends[0] == ends[1] else (key, ends[0], ends[1], parts)
    keys = jdbc_read(spark, url, only, fetchsize=fetchsize, partition=spread, options=given)
    predicates = quantile_predicates(keys.select(F.col(keys.columns[0]).alias(key)), parts)
    return nan_to_null(spark.read.jdbc(url, table, predicates=predicates, properties={**given, "fetchsize": str(fetchsize)}))


def jdbc_write(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "replace",
    batchsize: int = WRITE_ROWS,
    skip_empty: bool = True,
    column_types: str | None = None,
    parts: int | None = None,
    options: Mapping[str, str] | None = None,
) -> bool:
    """``replace`` the table, ``truncate`` it and keep its definition, or ``append``.

    An empty frame writes nothing and returns False. ``parts`` limits the number
    of parallel connections.
    """
    if mode not in ("replace", "truncate", "append"):
        raise ValueError("mode must be 'replace', 'truncate' or 'append'")
    with interim(df.sparkSession):
        rows = to_store(df, skip_empty)
        if rows is None:
            return False
        writer = (
            rows.write.format("jdbc")
            .mode("append" if mode == "append" else "overwrite")
            .options(**(options or {}))
            .option("url", url)
            .option("dbtable", table)
            .option("batchsize", batchsize)
        )
        if mode == "truncate":
            writer = writer.option("truncate", "true")
        if column_types:
            writer = writer.option("createTableColumnTypes", column_types)
        if parts:
            writer = writer.option("numPartitions", parts)
        writer.save()
    return True


@contextmanager
def _connection(spark: SparkSession, url: str, options: Mapping[str, str] | None) -> Iterator:
    """A connection of the driver, in one transaction: kept if the block ends, taken back if it raises."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for name, value in (options or {}).items():
        properties.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        yield connection
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _run(connection, sql: str) -> int:
    statement = connection.createStatement()
    try:
        return statement.executeUpdate(sql)
    finally:
        statement.close()


def _has_batch(connection, name: str) -> bool:
    statement = connection.createStatement()
    try:
        found = statement.executeQuery(f"SELECT COUNT(*) FROM {BATCHES} WHERE batch = '{name}'")
        found.next()
        return found.getLong(1) > 0
    finally:
        statement.close()


def _table_exists(connection, table: str) -> bool:
    names = connection.getMetaData().getTables(None, None, "%", None)
    while names.next():
        if names.getString("TABLE_NAME").lower() == table.lower():
            return True
    return False


def _with_attempts(df: DataFrame) -> DataFrame:
    """``df`` with the number of each row's part, and of the attempt at writing it."""

    def mark(batches):
        task = TaskContext.get()
        for batch in batches:
            part, attempt = (pa.array([n] * batch.num_rows, pa.int32()) for n in (task.partitionId(), task.attemptNumber()))
            yield pa.RecordBatch.from_arrays([*batch.columns, part, attempt], names=[*batch.schema.names, "w_part", "w_attempt"])

    return df.mapInArrow(mark, T.StructType([*df.schema.fields, T.StructField("w_part", T.IntegerType()), T.StructField("w_attempt", T.IntegerType())]))


def jdbc_append_once(
    df: DataFrame,
    url: str,
    table: str,
    batch: str,
    *,
    batchsize: int = WRITE_ROWS,
    column_types: str | None = None,
    parts: int | None = None,
    options: Mapping[str, str] | None = None,
) -> bool:
    """Append ``df`` to ``table`` once, whatever is repeated; False if the batch was written before.

    ``batch`` names the rows, such as a feed and a day. They go to a table of the batch's own first, each with the number of its part and
    of the attempt at writing it: a part is one transaction, so an attempt is there as a whole or not at all. One last
    transaction then copies the first attempt of each part to ``table`` and notes the batch in ``BATCHES``. A task that is run again, though it
    had written, adds nothing; a job that stops anywhere leaves ``table`` as it was, and can be run again. The
    driver needs the database's JDBC driver on its class path.
    """
    spark = df.sparkSession
    name = sha256(f"{table}|{batch}".encode()).hexdigest()[:24]
    stage = f"stage_{name}"
    typed = f"{column_types}, " if column_types else ""
    with _connection(spark, url, options) as connection:
        if not _table_exists(connection, BATCHES):
            _run(connection, f"CREATE TABLE {BATCHES} (batch VARCHAR(64) PRIMARY KEY, written_rows BIGINT)")
        elif _has_batch(connection, name):
            return False
        there = _table_exists(connection, table)
    with interim(spark):
        rows = hand_off(df, "to-append")  # a part has the same rows in every attempt
        if not there:
            jdbc_write(rows.limit(0), url, table, mode="append", skip_empty=False, column_types=column_types, options=options)
        _stage(_with_attempts(rows), url, stage, batchsize, f"{typed}w_part INTEGER, w_attempt INTEGER", parts, options)
    quote = '"' if not url.startswith("jdbc:mysql") else "`"
    columns = ", ".join(f"{quote}{c}{quote}" for c in df.columns)
    with _connection(spark, url, options) as connection:
        first = f'SELECT MIN(s.{quote}w_attempt{quote}) FROM {stage} s WHERE s.{quote}w_part{quote} = t.{quote}w_part{quote}'
        n = _run(connection, f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage} t WHERE t.{quote}w_attempt{quote} = ({first})")
        _run(connection, f"INSERT INTO {BATCHES} VALUES ('{name}', {n})")
    with _connection(spark, url, options) as connection:
        _run(connection, f"DROP TABLE {stage}")
    return True


def _stage(rows: DataFrame, url: str, stage: str, batchsize: int, column_types: str, parts: int | None, options) -> None:
    """Write a batch's own table anew; what a stopped job left there goes."""
    jdbc_write(rows, url, stage, mode="replace", batchsize=batchsize, skip_empty=False, column_types=column_types, parts=parts, options=options)


def jdbc_copy(
    spark: SparkSession,
    source_url: str,
    target_url: str,
    table: str,
    *,
    fields: Sequence[str] | None = None,
    where: Column | str | None = None,
    target_table: str | None = None,
    column_types: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    source_options: Mapping[str, str] | None = None,
    target_options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Copy chosen fields and rows into a recreated table; returns a five-row preview."""
    target = target_table or table
    source = jdbc_read(spark, source_url, table, partition=partition, options=source_options)
    jdbc_write(
        extract(source, fields, where),
        target_url,
        target,
        skip_empty=False,
        column_types=column_types,
        options=target_options,
    )
    return jdbc_read(spark, target_url, target, options=target_options).limit(5)
