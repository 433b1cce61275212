"""Packing documents into sequences by linear grouping.

Piece lengths are whole numbers up to the capacity, so a histogram of at most
``capacity`` counts describes the corpus, whatever its size. On it, on the
driver:

1. lengths over ``capacity // LARGE`` are sorted and cut into groups of equal
   cardinality, and each is rounded up to the longest of its group;
2. the few sizes left are packed by configurations: a linear program over all
   ways to fill a sequence, solved by column generation, rounded down;
3. the actual lengths take the places of the rounded ones, group by group;
4. sequences that the actual lengths leave loose are opened again;
5. what is left over, and all small pieces, go to the fullest sequence that
   still has room (best fit, longest first).

The outcome is a short table: of the pieces of one length, those ranked so to
so go to such sequences at such an offset. Spark ranks the pieces of each
length and joins that table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import only
from blotter.llm.segments import byte_bpe
from blotter.runtime import materialise

CAPACITY = 1024
GROUPS = 96
#: Lengths over this part of the capacity are planned; shorter ones fill the gaps.
LARGE = 4
#: A planned sequence is opened again if over this part of it stays free.
LOOSE = 128
END_ID = 2
#: Rows that share one ranking task, and the most such shares a length has.
RANKED_TOGETHER = 2_000
SHARES = 4_096

Pattern = tuple[int, tuple[int, ...]]


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its ids and ``end_id``; a null text is empty. Only a longer
    one than ``capacity`` is cut: into pieces of ``capacity``, the first of
    which takes the remainder.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = byte_bpe(tokenizer)
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch["doc_id"].tolist(), encoder.ids(batch["text"])):
                ids += end
                n = len(ids) // 4
                start, stop = 0, n % capacity or capacity
                piece = 0
                while start < n:
                    out.append((doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    piece, start, stop = piece + 1, stop, stop + capacity
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"}) if integral else frame

    source = only(docs, doc_id=id_col, text=text_col)
    integral = isinstance(source.schema["doc_id"].dataType, T.IntegralType)
    schema = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    return source.mapInPandas(cut, schema)


def grouped(counts: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Equal-cardinality groups, longest first: (rounded length, [[length, n]])."""
    share = max(1, math.ceil(sum(counts.values()) / groups))
    out: list[tuple[int, list[list[int]]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append((length, []))
                room = share
            n = min(left, room)
            out[-1][1].append([length, n])
            left, room = left - n, room - n
    merged: dict[int, list[list[int]]] = {}
    for size, runs in out:
        merged.setdefault(size, []).extend(runs)
    return list(merged.items())


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[int, np.ndarray]]:
    """(times, how many of each size): the linear program's plan, rounded down.

    Column generation: the basis starts with sequences of one size each; an
    unbounded knapsack over the current prices finds the configuration that
    helps most, until none does.
    """
    k = len(sizes)
    if not k:
        return []
    size, want = np.array(sizes), np.array(demand, float)
    columns = np.diag(capacity // size).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    level = inverse @ want
    for _ in range(40 * k + 200):
        price = inverse.sum(axis=0)
        best = np.zeros(capacity + 1)
        taken = np.full(capacity + 1, -1)
        for c in range(int(size.min()), capacity + 1):
            value = np.where(size <= c, price + best[np.maximum(c - size, 0)], -1.0)
            g = int(value.argmax())
            if value[g] > best[c - 1] + 1e-12:
                best[c], taken[c] = value[g], g
            else:
                best[c] = best[c - 1]
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if taken[c] < 0:
                c -= 1
            else:
                column[taken[c]] += 1
                c -= size[taken[c]]
        step = inverse @ column
        ratio = np.where(step > 1e-9, level / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        columns[:, out] = column
        inverse[out] /= step[out]
        moved = np.delete(np.arange(k), out)
        inverse[moved] -= np.outer(step[moved], inverse[out])
        amount = max(0.0, ratio[out])
        level -= step * amount
        level[out] = amount
        level = np.maximum(level, 0)
    left = np.array(demand)
    plan = []
    for j in np.argsort(-level):
        column = columns[:, j].astype(int)
        used = column > 0
        times = min(int(level[j] + 1e-9), int((left[used] // column[used]).min()) if used.any() else 0)
        if times > 0:
            plan.append((times, column))
            left = left - times * column
    return plan


def substituted(groups: list[tuple[int, list[list[int]]]], plan: list[tuple[int, np.ndarray]]) -> list[Pattern]:
    """The plan with actual lengths; takes them out of the runs of ``groups``."""
    out: list[Pattern] = []
    for times, column in plan:
        slots = [g for g, n in enumerate(column) for _ in range(int(n))]
        drawn = []
        for g in slots:
            need, runs = times, groups[g][1]
            mine = []
            while need:
                length, n = runs[0]
                take = min(n, need)
                mine.append([length, take])
                need -= take
                if take == n:
                    runs.pop(0)
                else:
                    runs[0][1] -= take
            drawn.append(mine)
        while drawn[0]:
            n = min(runs[0][1] for runs in drawn)
            out.append((n, tuple(runs[0][0] for runs in drawn)))
            for runs in drawn:
                runs[0][1] -= n
                if not runs[0][1]:
                    runs.pop(0)
    return out


def best_fit(bins: list[Pattern], counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Each piece, longest first, into the fullest sequence that has room for it."""
    room: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for n, lengths in bins:
        room[capacity - sum(lengths)].append((n, lengths))
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            r = next((r for r in range(length, capacity) if room[r]), capacity)
            n, lengths = room[r].pop() if r < capacity else (left, ())
            per = min(r // length, left)
            full = min(n, left // per)
            if n > full and r < capacity:
                room[r].append((n - full, lengths))
            room[r - per * length].append((full, lengths + (length,) * per))
            left -= full * per
    return [p for level in room for p in level]


def packed(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Pattern]:
    """(times, lengths in a sequence) for a histogram of piece lengths."""
    large = {x: n for x, n in counts.items() if x > capacity // LARGE}
    small = {x: n for x, n in counts.items() if x <= capacity // LARGE}
    by_group = grouped(large, groups)
    plan = configurations([g[0] for g in by_group], [sum(n for _, n in g[1]) for g in by_group], capacity)
    bins = substituted(by_group, plan)
    rest = dict(small)
    for _, runs in by_group:
        for length, n in runs:
            rest[length] = rest.get(length, 0) + n
    tight = []
    for times, lengths in bins:
        if capacity - sum(lengths) <= capacity // LOOSE:
            tight.append((times, lengths))
        else:
            for length in lengths:
                rest[length] = rest.get(length, 0) + times
    return best_fit(tight, rest, capacity)


def _places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank behind the last, first sequence, offset)."""
    out, next_rank, sequence = [], {}, 0
    for times, lengths in patterns:
        offset = 0
        for length in lengths:
            rank = next_rank.get(length, 0)
            out.append((length, rank, rank + times, sequence, offset))
            next_rank[length], offset = rank + times, offset + length
        sequence += times
    return out


def ranked(cut: DataFrame) -> DataFrame:
    """``cut`` with ``rank``: the place among the pieces of its length, from 0.

    A length may hold most pieces, so each is dealt out in shares: a share
    ranks its own rows and adds the sizes of the shares before it.
    """
    shares = max(16, min(SHARES, cut.count() // RANKED_TOGETHER))
    dealt = cut.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shares)))
    sizes = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = sizes.withColumn(
        "before",
        F.coalesce(
            F.sum("n").over(
                Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).drop("n")
    own = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.withColumn("own", F.row_number().over(own) - 1)
        .join(before, ["length", "share"])
        .withColumn("rank", F.col("before") + F.col("own"))
        .drop("share", "own", "before")
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    groups: int = GROUPS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece of ``pieces``: also ``sequence_id`` and ``offset`` there.

    Sequences hold at most ``capacity`` ids and have no gaps. Null, empty and
    blank texts are a piece of the end id alone. Repeated rows are packed each
    for itself; an empty table gives an empty one. On the driver are only the
    histogram (``capacity`` counts) and the table of places made from it,
    which is broadcast; both are bounded by ``capacity``, not by the input.
    """
    spark = docs.sparkSession
    cut = materialise(pieces(docs, tokenizer, capacity, id_col=id_col, text_col=text_col), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.createDataFrame(
        _places(packed(counts, capacity, groups)), "len long, lo long, hi long, sequence long, offset long"
    )
    rows = ranked(cut)
    return rows.join(
        F.broadcast(places), (F.col("length") == F.col("len")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    ).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("lo")).alias("sequence_id"),
        "offset",
    )
