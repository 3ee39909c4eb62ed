"""The trie of all prefixes of many sequences, with totals of every subtree, by van Emde Boas recursion.

A block of 2^j turns is cut in the middle. Down: the upper half keeps the root its block has, the lower half gets
the cut prefix as its root, named by a digest of that root and of the upper half; both halves go on at the same
time, so sequences of d turns take log2(d) steps, whatever d is. At single turns every prefix has a name, the name of
its parent and those of the roots it lies under. Up again: a node at depth t is the root of the lower half that
begins there, 2^j turns high, where 2^j is the largest power of two that divides t. In the order of falling j the
totals of these lower tries are added to their roots, which are then complete; each node is passed on once for
each of its at most log2(d) roots.

Everything is keyed by block or by node, never by sequence alone, so neither one very long sequence nor a
very common prefix makes a large task.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import hand_off

PART_BYTES = 1 << 16  # of a list of ids that is hashed in parts


def digest(*parts: Column) -> Column:
    """16 bytes of the SHA-256 of the parts, one after another."""
    joined = F.concat(*[p.cast("binary") for p in parts])
    return F.unhex(F.substring(F.sha2(joined, 256), 1, 32))


ROOT = hashlib.sha256(b"root").digest()[:16]


def _root() -> Column:
    return F.unhex(F.lit(ROOT.hex()))


def number_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, pos (from 1, in order of turn), token (digest of role and text) and n_bytes of the text, stored.

    Null turns come first, equal ones in order of the token; null role and text are empty; rows with a null
    conv are left out. Rows are sorted over all tasks by conv and turn and counted in each, so that a conversation may
    span many tasks; what each task must add for its first conversation is one row a task, which is broadcast.
    """
    col = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    role, text = col(role_col), col(text_col)
    rows = df.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("token"), F.octet_length(text).cast("long").alias("n_bytes"),
    )

    def count(batches):
        part, conv, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            new = np.diff(ids, prepend=ids[:1]) != 0
            at = np.arange(len(ids))
            first = np.maximum.accumulate(np.where(new, at, 0))
            pos = at - first + 1
            if len(ids) and conv == ids[0]:
                pos[first == 0] += n
            if len(ids):
                conv, n = ids[-1], int(pos[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(ids), part)), pa.array(pos)], names=["conv", "token", "n_bytes", "part", "pos"])

    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("token")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn")
    counted = hand_off(dealt.mapInArrow(count, "conv long, token binary, n_bytes long, part long, pos long"), "turns")
    ends = counted.groupBy("part").agg(F.min("conv").alias("conv"), F.max(F.struct("conv", "pos")).alias("last"))
    before = F.sum("last.pos").over(Window.partitionBy("last.conv").orderBy("part"))
    lag = lambda c: F.lag(c).over(Window.orderBy("part"))  # noqa: E731  one row a task
    carried = ends.withColumn("sum", before).select("part", "conv", lag("last.conv").alias("previous"), lag("sum").alias("add"))
    carried = F.broadcast(carried.where("conv = previous").select("part", "conv", "add"))
    pos = F.col("pos") + F.coalesce("add", F.lit(0))
    return counted.join(carried, ["part", "conv"], "left").select("conv", pos.alias("pos"), "token", "n_bytes")


def _halves(blocks: DataFrame, *more: Column) -> DataFrame:
    """Pairs of neighbouring blocks: the digests of both halves (null if not full), and whether there is a lower one."""
    odd = F.col("block") % 2 == 1
    return blocks.groupBy("conv", "n", F.shiftright("block", 1).alias("pair")).agg(
        F.max(F.when(~odd, F.col("hash"))).alias("upper"), F.max(F.when(odd, F.col("hash"))).alias("lower"), F.max(odd).alias("goes_on"), *more
    )


def name_prefixes(turns: DataFrame, longest: int) -> DataFrame:
    """conv, n, depth, name of the prefix, the names ``path`` of the roots above it (the last is its parent), token and n_bytes of its last turn.

    ``turns``: conv, n (turns of the sequence), pos (1 to n), token, n_bytes; ``longest`` is the largest n.
    """
    height = max(1, (longest - 1).bit_length())
    blocks = turns.select("conv", "n", (F.col("pos") - 1).alias("block"), F.col("token").alias("hash"), "n_bytes")
    odd = F.col("block") % 2 == 1
    sizes = [F.max(F.when(odd == side, F.col("n_bytes"))).alias(c) for c, side in (("upper_bytes", F.lit(False)), ("lower_bytes", F.lit(True)))]
    levels = [hand_off(_halves(blocks, *sizes), "halves")]
    for j in range(1, height):
        full = digest(F.lit("block"), F.col("upper"), F.col("lower"))  # null unless both halves are full
        above = levels[-1].where(F.col("n") > 2**j).select("conv", "n", F.col("pair").alias("block"), full.alias("hash"))
        levels.append(hand_off(_halves(above), "halves"))
    halves = None
    for j in range(height, 0, -1):
        level = levels[j - 1]
        full = digest(F.lit("block"), F.col("upper"), F.col("lower"))
        whole = level.where(F.col("n") <= 2**j)  # sequences that begin at this step: one block, the whole sequence
        state = whole.withColumn("path", F.array(_root())).withColumn("end", digest(F.lit("name"), _root(), full))
        if halves is not None:
            state = state.unionByName(level.where(F.col("n") > 2**j).join(halves.withColumnRenamed("block", "pair"), ["conv", "pair"]))
        cut = digest(F.lit("name"), F.element_at("path", -1), F.col("upper"))
        state = state.withColumn("cut", cut)
        more = lambda side: [F.col(side).alias("token"), F.col(f"{side}_bytes").alias("n_bytes"), F.col("n")] if j == 1 else []  # noqa: B023, E731
        upper = F.struct((2 * F.col("pair")).alias("block"), F.col("path"), F.col("cut").alias("end"), *more("upper"))
        lower = F.struct((2 * F.col("pair") + 1).alias("block"), F.concat("path", F.array("cut")).alias("path"), F.col("end"), *more("lower"))
        both = F.when(F.col("goes_on"), F.array(upper, lower)).otherwise(F.array(upper))
        halves = state.select("conv", F.explode(both).alias("half")).select("conv", "half.*")
    return halves.select("conv", "n", (F.col("block") + 1).alias("depth"), F.col("end").alias("name"), "path", "token", "n_bytes")


def list_digests(rows: DataFrame) -> DataFrame:
    """name, ends_sha256: the SHA-256 of each name's decimal convs in ascending order, joined by commas; ``rows`` must be stored.

    Rows are sorted over all tasks, each of which joins what it has into texts of ``PART_BYTES``; only these
    are brought together, and hashed one after another, so a name with very many convs is neither one task's rows nor held whole.
    """

    def parts(batches):
        name, first, held, size = None, 0, [], 0
        out = []
        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != name or size >= PART_BYTES:
                    if held:
                        out.append((name, first, ",".join(held)))
                    name, first, held, size = key, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            yield from _frames(out, ("name", pa.binary()), ("first", pa.int64()), ("text", pa.string()))
            out = []
        if held:
            yield from _frames([(name, first, ",".join(held))], ("name", pa.binary()), ("first", pa.int64()), ("text", pa.string()))

    def hashes(batches):
        name, state, out = None, None, []
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if key != name:
                    if state:
                        out.append((name, state.hexdigest()))
                    name, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield from _frames(out, ("name", pa.binary()), ("ends_sha256", pa.string()))
            out = []
        if state:
            yield from _frames([(name, state.hexdigest())], ("name", pa.binary()), ("ends_sha256", pa.string()))

    dealt = rows.select("name", "conv").repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
    texts = dealt.mapInArrow(parts, "name binary, first long, text string")
    return texts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashes, "name binary, ends_sha256 string")


def _frames(rows: list[tuple], *columns: tuple[str, pa.DataType]):
    if rows:
        arrays = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(columns)]
        yield pa.RecordBatch.from_arrays(arrays, names=[c for c, _ in columns])


def _graft(tree: DataFrame, deepest: int) -> list[DataFrame]:
    """``tree`` with the totals n_leaves and saved of each subtree, in one stored frame for each power of two that divides a depth.

    In: name, depth (from 1), path, own_leaves, own_saved and any others.
    """
    done: list[DataFrame] = []
    for j in range(max(deepest, 1).bit_length() - 1, -1, -1):
        s = 2**j
        above = lambda: F.col("path")[F.bit_count(F.shiftright(F.col("depth") - 1, j)).cast("int")].alias("name")  # noqa: B023, E731
        inner = tree.where(((F.col("depth") - 1).bitwiseAND(s) != 0) & (F.col("depth") % (2 * s) != 0))
        given = [inner.select(above(), F.col("own_leaves").alias("leaves"), F.col("own_saved").alias("saved"))]
        given += [d.select(above(), F.col("n_leaves").alias("leaves"), "saved") for d in done]
        lower = reduce(DataFrame.unionByName, given).groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        total = lambda own, add: F.col(own) + F.coalesce(add, F.lit(0))
        grown = tree.where(F.col("depth") % (2 * s) == s).join(lower, "name", "left")
        grown = grown.withColumn("n_leaves", total("own_leaves", "leaves")).withColumn("saved", total("own_saved", "saved")).drop("leaves")
        done.append(hand_off(grown, "totals"))
    return done


def prefix_trie(members: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each distinct prefix, the empty one included, of all sequences.

    ``members``: conv, each once, also of sequences without turns; ``turns``, stored: conv, n, pos, token, n_bytes as
    in ``name_prefixes``. Out: name and parent (digests that stand for the prefixes; the root's parent is null),
    token of the last turn (null at the root), conv_id (smallest member), parent_conv_id, depth, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256. Without members there is no row.

    Prefixes are told apart by 128 bits of SHA-256. Sums are 64-bit integers.
    """
    longest = turns.agg(F.max("n")).first()[0] or 0
    root = members.agg(F.min("conv").alias("conv_id"), F.count("conv").alias("n_convs")).where("n_convs > 0").select(
        _root().alias("name"), F.lit(0).cast("long").alias("depth"), F.array().cast("array<binary>").alias("path"),
        F.lit(None).cast("binary").alias("token"), F.lit(0).cast("long").alias("n_bytes"), "conv_id", "n_convs",
    )
    silent = members.join(turns.where("pos = 1").select("conv"), "conv", "left_anti").select(_root().alias("name"), "conv")
    if longest:
        prefixes = hand_off(name_prefixes(turns, longest), "prefixes")
        same = [F.first(c).alias(c) for c in ("depth", "path", "token", "n_bytes")]
        nodes = prefixes.groupBy("name").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), *same)
        nodes = hand_off(nodes.select(*root.columns).unionByName(root), "nodes")
        ends = hand_off(prefixes.where("depth = n").select("name", "conv").unionByName(silent), "ends")
    else:
        nodes, ends = hand_off(root, "nodes"), hand_off(silent, "ends")
    parent = F.when(F.col("depth") > 0, F.element_at("path", -1))
    nodes = nodes.withColumn("parent", parent)
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    tree = nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    tree = tree.withColumn("own_leaves", (F.col("n_children") == 0).cast("long")).withColumn("own_saved", (F.col("n_convs") - 1) * F.col("n_bytes"))
    tree = hand_off(tree, "tree")
    totals = _graft(tree.where("depth > 0"), longest)
    whole = F.broadcast(tree.agg(F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved")))  # one row
    found = reduce(DataFrame.unionByName, [tree.where("depth = 0").crossJoin(whole), *totals])
    above = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = found.join(above, "parent", "left").join(list_digests(ends), "name", "left")
    return found.select(
        "name", "parent", "token", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def rebuild(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(members, turns) for ``prefix_trie``: each conversation begins like another one.

    The first ``head`` (an expression over conv, at most ``most``) turns are those of conversation ``base``, fewer or none if that has
    fewer or is absent; the rest are the own turns after the first ``head``. ``turns`` as from ``number_turns``.
    """
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    lengths = hand_off(lengths.select("conv", "own", base.alias("base"), head.cast("long").alias("head")), "lengths")
    there = lengths.select(F.col("conv").alias("base"), F.col("own").alias("has"))
    lengths = lengths.join(there, "base", "left").withColumn("taken", F.least("head", F.coalesce("has", F.lit(0))))
    lengths = hand_off(lengths.withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))), "lengths")
    heads = turns.where(F.col("pos") <= most).withColumnRenamed("conv", "base")
    heads = lengths.select("conv", "base", "taken", "n").join(heads, "base").where("pos <= taken")
    own = turns.where(F.col("pos") > head).join(lengths.select("conv", "head", "taken", "n"), "conv")
    own = own.withColumn("pos", F.col("pos") - F.col("head") + F.col("taken"))
    columns = ["conv", "n", "pos", "token", "n_bytes"]
    return lengths.select("conv"), hand_off(heads.select(*columns).unionByName(own.select(*columns)), "sequences")
