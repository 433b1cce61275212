"""Merkle tree over the rows of a table, and the proof of each row.

The rows of a group are ordered and cut into blocks of ``ARITY ** LEVELS``
nodes. A block keeps each of its levels as one string of concatenated hex
digests, 64 characters wide each: the parents are the hashes of fixed-width
substrings, and the siblings of a node are the substrings to the left and
right of it within its run. The tops of the blocks are the nodes of the next
round, until one block is left per group; the roots of the groups are the
nodes of a last tree.

No task holds more than a block, and the driver only learns how many nodes the
largest group has.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.runtime import materialise

ARITY = 2
#: Levels that a block lifts its nodes by.
LEVELS = 8
WIDTH = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def spelled(value: Column) -> Column:
    """UTF-8 byte count, ``:`` and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: Sequence[Column]) -> Column:
    return digest(F.concat(*map(spelled, columns)))


def numbered(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """``rows`` with ``pos``, their place within their key, and ``size``, the rows of it.

    Rows are dealt out by ranges and numbered inside each; the few counts by
    range and key say where a range starts. Rows that are equal in every column
    named are told apart by where they were read, so many of them can be dealt
    to several tasks; which of them comes first makes no difference.
    """
    along = [key, *order, "_read"]
    stored = materialise(
        rows.withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(*along)
        .sortWithinPartitions(*along)
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
        .drop("_read"),
        "numbered",
    )
    of_key = Window.partitionBy(key)
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("_part", key)
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
        .withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "size": F.sum("_n").over(of_key)})
    )
    return (
        stored.join(starts, ["_part", key])
        .withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_part", "_at", "_first", "_n", "_before")
    )


def _part(level: Column, first: Column, count: Column | int) -> Column:
    """``count`` nodes of a level from the ``first``, as far as it has them."""
    return F.substring(level, first.cast("int") * WIDTH + 1, F.lit(count).cast("int") * WIDTH)


def _parents(level: Column, arity: int) -> Column:
    runs = F.ceil(F.octet_length(level) / (WIDTH * arity)).cast("int")
    hashes = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: digest(_part(level, i * arity, arity)))
    return F.array_join(hashes, "").cast("binary")


def _levels(nodes: Column, alone: Column, arity: int, levels: int) -> Column:
    """Levels of a block, the given nodes first: up to one node if it is alone, else all."""
    last = lambda done: F.element_at(done, -1)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(levels)),
        F.array(nodes),
        lambda done, _: F.when(
            ~alone | (F.octet_length(last(done)) > WIDTH), F.concat(done, F.array(_parents(last(done), arity)))
        ).otherwise(done),
    )


def _siblings(levels: Column, i: Column, arity: int) -> Column:
    """Digests to the left and to the right of a node and of what it is lifted to."""

    def flanks(level: Column, up: Column) -> Column:
        place = F.floor(i / F.pow(F.lit(arity), up))
        run = place - place % arity
        return F.struct(
            _part(level, run, place - run).cast("string").alias("left"),
            _part(level, place + 1, run + arity - place - 1).cast("string").alias("right"),
        )

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), flanks)


EMPTY_PATH = "cast(array() as array<struct<left:string,right:string>>)"


def paths(
    nodes: DataFrame,
    arity: int = ARITY,
    levels: int = LEVELS,
    beyond: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The way of every node to the root of its key.

    ``nodes`` has ``key``, ``pos`` (0 to ``size`` - 1 within the key), ``size``
    and ``digest``; further columns stay. Added are ``path`` (left and right
    siblings by level), ``root`` (of the key) and ``whole`` (where the path
    ends). Every run of ``arity`` consecutive nodes, the last one perhaps
    shorter, becomes the hash of its digests until one is left; a lone node is
    its own root. ``beyond`` takes the roots (``key``, ``digest``) and gives
    ``key``, ``path`` and ``whole``: how they go on.
    """
    block = arity**levels
    carried = [c for c in nodes.columns if c not in ("key", "size")]
    stored = materialise(
        nodes.withColumn("block", F.floor(F.col("pos") / block))
        .groupBy("key", "size", "block")
        .agg(F.array_sort(F.collect_list(F.struct("pos", *[c for c in carried if c != "pos"]))).alias("nodes"))
        .withColumn(
            "levels",
            _levels(
                F.array_join(F.col("nodes.digest"), "").cast("binary"), F.col("size") <= block, arity, levels
            ),
        ),
        "blocks",
    )
    tops = stored.select(
        "key",
        F.col("block").alias("pos"),
        F.ceil(F.col("size") / block).alias("size"),
        F.element_at("levels", -1).cast("string").alias("digest"),
    )
    if (stored.agg(F.max("size")).first()[0] or 0) > block:
        above = paths(tops, arity, levels, beyond)
    elif beyond:
        above = tops.join(beyond(tops.select("key", "digest")), "key").withColumn("root", F.col("digest"))
    else:
        above = tops.withColumns({"path": F.expr(EMPTY_PATH), "root": F.col("digest"), "whole": F.col("digest")})
    above = above.select("key", F.col("pos").alias("block"), F.col("path").alias("_above"), "root", "whole")
    members = F.transform(
        "nodes", lambda node, i: F.struct(node.alias("node"), _siblings(F.col("levels"), i, arity).alias("own"))
    )
    return (
        stored.join(above, ["key", "block"])
        .select("key", "size", "root", "whole", "_above", F.inline(members))
        .select("key", "size", "node.*", F.concat("own", "_above").alias("path"), "root", "whole")
    )


def proof(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """Root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def manifest(
    df: DataFrame,
    altered: Mapping[str, Column] | None = None,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns: Sequence[str] = COLUMNS,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A row's leaf is the hash of its ``columns``; the leaves of one value of
    ``group_col`` ascend by ``id_col`` and have the root ``subroot``; the
    subroots, by group, have the root ``root``. ``altered`` gives, by column,
    the value found later: ``folded_root`` is what the leaf of the altered row
    and the siblings of the original lead to.

    A null group is a group of its own, before all others; a null id comes
    before all others; rows of one id are ordered by their leaf, so repeated
    rows change nothing but the size. Null values and empty texts have
    different leaves. A single row has no siblings, and the hash of nothing as
    its proof; an empty table gives an empty one. Other columns are not read.
    """
    altered = altered or {}
    leaves = materialise(
        df.select(
            # A text key that keeps the order, so that null rows group and join like others.
            F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("")).alias("key"),
            F.col(f"`{id_col}`").alias("id"),
            leaf_of([F.col(f"`{c}`") for c in columns]).alias("digest"),
            leaf_of([altered.get(c, F.col(f"`{c}`")) for c in columns]).alias("found"),
        ),
        "leaves",
    )

    def beyond(roots: DataFrame) -> DataFrame:
        one = numbered(roots.select(F.lit("").alias("all"), F.col("key").alias("group"), "digest"), "all", "group")
        return paths(one.withColumnRenamed("all", "key"), arity, levels).select(
            F.col("group").alias("key"), "path", "whole"
        )

    return (
        paths(numbered(leaves, "key", "id", "digest"), arity, levels, beyond)
        .select(
            F.col("id").alias("doc_id"),
            F.col("digest").alias("leaf"),
            F.col("root").alias("subroot"),
            F.col("whole").alias("root"),
            proof(F.col("path")).alias("proof_sha256"),
            folded(F.col("found"), F.col("path")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
