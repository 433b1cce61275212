"""SimHash near-duplicates found with covering locality-sensitive hashing.

A fingerprint has 64 bits. For radius 2 every bit position gets one of the
seven non-zero vectors of three bits; mask v keeps the positions whose vector
has an odd product with v. Two fingerprints that differ in at most two bits
put at most two linear conditions on v, and three dimensions leave a non-zero
v that meets both: under that mask the two are equal. So every linked pair
meets in some of the seven tables, without exception.

A bucket with many fingerprints is dealt out again by the same construction
over the positions its mask has dropped. What then still shares a bucket
differs in at most twelve positions, so it holds at most 4,096 fingerprints,
whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import only, unused
from blotter.llm.components import connected_components
from blotter.runtime import materialise

BITS = 64
RADIUS = 2
SEED = 42
#: Fingerprints in a bucket from which on it is dealt out again. It moves work
#: only: the links are the same for any value.
BUCKET = 512
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
HASHES_AT_ONCE = 1 << 14


def simhash(text: str | None, words: int = 3, seed: int = SEED) -> int:
    """Fingerprint of the word shingles of ``text``, repeats included.

    A text of fewer words is one shingle; without any word (or null) it is 0.
    """
    found = (text or "").encode("utf-8", "replace").translate(FOLD).split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(found) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), HASHES_AT_ONCE):
        j = min(i + HASHES_AT_ONCE, len(starts))
        hashes = np.fromiter(
            (digest(joined[a:b]) for a, b in zip(starts[i:j], ends[i:j])), np.dtype("<u8"), j - i
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3
) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long), one row per row."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = [_signed(simhash(t, words)) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": np.array(fp, np.int64)})

    source = only(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([source.schema["doc_id"], T.StructField("fp", T.LongType())])
    return source.mapInPandas(rows, schema)


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``positions``; any ``radius`` of them escape one mask at least."""
    top = 1 << radius
    # From the upper half on: where positions are fewer than vectors, each mask
    # still keeps about half of them.
    vectors = [*range(top, 2 * top), *range(1, top)]
    given = {p: vectors[i % len(vectors)] for i, p in enumerate(positions)}
    return [sum(1 << p for p, g in given.items() if (g & v).bit_count() % 2) for v in vectors]


def _dropped(mask: int) -> list[int]:
    return [p for p in range(BITS) if not mask >> p & 1]


def _forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (earlier, later) that span each linked set among ``members``."""
    rest = np.unique(members)
    out = []
    if len(rest) == 2:
        a, b = rest.tolist()
        return [(a, b)] if ((a ^ b) & ((1 << BITS) - 1)).bit_count() <= radius else []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            close = np.bitwise_count((front[:256, None] ^ rest[None, :]).view(np.uint64)) <= radius
            near = close.any(axis=0)
            out += zip(front[close.argmax(axis=0)[near]].tolist(), rest[near].tolist())
            front, rest = np.concatenate([front[256:], rest[near]]), rest[~near]
    return out


def linked_fingerprints(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a``, ``b`` that connect whatever links of ``radius`` bits connect.

    ``distinct`` has one row per fingerprint ``fp``. Links inside a bucket are
    handed on as a spanning forest, so a dense group stays linear.
    """
    first = covering_masks(list(range(BITS)), radius)
    second = [covering_masks(_dropped(m), radius) for m in first]
    lits = lambda masks: F.array(*[F.lit(_signed(m)) for m in masks])
    # Few bytes, much work: each row becomes one per mask, so deal the rows out first.
    keyed = distinct.repartition("fp").select(
        "fp", F.posexplode(F.transform(lits(first), lambda m: F.col("fp").bitwiseAND(m))).alias("t", "key")
    )
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    again = F.array(*[lits(masks) for masks in second])
    whole = F.array(F.struct(F.lit(-1).alias("u"), F.lit(0).cast("long").alias("sub")))
    parts = F.transform(
        F.element_at(again, F.col("t") + 1),
        lambda m, u: F.struct(u.alias("u"), F.col("fp").bitwiseAND(m).alias("sub")),
    )
    buckets = (
        keyed.join(shared, ["t", "key"])
        .select("fp", "t", "key", F.explode(F.when(F.col("n") <= BUCKET, whole).otherwise(parts)).alias("p"))
        .select("fp", "t", "key", "p.u", "p.sub")
        .repartition("t", "key", "u", "sub")
        .groupBy("t", "key", "u", "sub")
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
        .select("members")
    )

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [e for m in batch["members"] for e in _forest(np.asarray(m, np.int64), radius)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return buckets.mapInPandas(edges, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    radius: int = RADIUS,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` per row.

    Rows link if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest id that links reach. Null, empty and
    blank texts have fingerprint zero and link like any other. Repeated rows
    come back as often as they came. A null id is never a component's id
    unless the component has no other. An empty table gives an empty one.
    """
    fps = materialise(fingerprints(docs, id_col, text_col, words), "simhash")
    nodes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected_components(linked_fingerprints(nodes.select("fp"), radius))
    labelled = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    labelled = materialise(labelled, "simhash-roots")
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(labelled.join(smallest, "root").select("fp", "component_id"), "simhash-named")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_copies(
    docs: DataFrame,
    words: int = 3,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each group of near copies, columns as given.

    Groups are those of ``near_duplicates``. The row with the smallest id
    stays, a null id counting as the largest; of rows with equal ids any one.
    So repeated rows go, rows without words are one group, and a row alone
    stays whatever its id. An empty table stays empty.

    The rows are stored under numbers of their own, so that no id, however
    often it occurs, brings its rows together.
    """
    row = unused(docs, "row")
    stored = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(stored, row, text_col, words, radius).select(F.col("doc_id").alias("row"), "component_id")
    members = materialise(groups.join(only(stored, row=row, own=id_col), "row"), "members")
    first = F.min(F.struct(F.col("own").isNull(), "own", "row"))
    several = members.groupBy("component_id").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = members.join(several, "component_id").where(F.col("row") != F.col("first.row")).select(F.col("row").alias(row))
    # Rows that go are fewer than rows that stay, and mostly few enough to spare the texts a shuffle.
    return stored.join(materialise(gone, "gone"), row, "left_anti").drop(row)
