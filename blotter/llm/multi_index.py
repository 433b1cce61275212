"""Nearest neighbours with an inverted multi-index.

Both halves of a vector are quantised by codebooks of their own, so ``k`` +
``k`` centroids cut space into ``k`` times ``k`` cells. A query goes through
the pairs of centroids in order of their summed distance, taken from a heap,
until the cells seen hold ``SCANNED`` of all rows and enough candidates; what
lies in them is ranked by exact distance.

Cells are dealt to blocks of some thousand rows, a full cell to several. A
block meets the queries that visit one of its cells, some at a time, and hands
on each query's nearest; so no task holds a cell, a query's candidates or all
queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import only
from blotter.runtime import materialise

CENTROIDS = 64
#: The bounded sample that the codebooks are fitted on.
SAMPLE = 20_000
ROUNDS = 10
#: Share of all rows that the visited cells hold. Vectors that are all about
#: equally far apart need a large one for the recall asked for.
SCANNED = 0.5
BLOCK_ROWS = 4_096
QUERIES_TOGETHER = 2_048
#: Queries, on average, whose cells one task looks up.
QUERIES_A_TASK = 64
NEAREST = 10


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``v``: vectors that can be compared, each row once.

    Left out are null ids and vectors, vectors with null or non-finite parts,
    zero vectors and those whose length is not the most frequent one.
    """
    rows = only(vectors, vec_id=id_col, v=vector_col).withColumn("v", F.col("v").cast("array<double>"))
    good = rows.where(
        F.col("vec_id").isNotNull()
        & F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        & F.exists("v", lambda x: x != 0)
    )
    size = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size("v") == (size["n"] if size else 0)).distinct()


def codebook(points: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Centroids of Lloyd's rounds from distinct starting points."""
    start = np.unique(points, axis=0)
    centres = start[np.random.default_rng(seed).permutation(len(start))[:k]]
    for _ in range(ROUNDS):
        own = _nearest(points, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)


def visited(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: float) -> list[int]:
    """Filled cells by summed distance until they hold ``wanted`` rows.

    ``left`` and ``right``: distances of the query's halves to the centroids.
    """
    a, b = left.argsort(kind="stable"), right.argsort(kind="stable")
    x, y = left[a].tolist(), right[b].tolist()
    heap, seen, out, held = [(x[0] + y[0], 0, 0)], {(0, 0)}, [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(right) + int(b[j])
        if counts[cell]:
            out.append(cell)
            held += counts[cell]
        for p in ((i + 1, j), (i, j + 1)):
            if p[0] < len(x) and p[1] < len(y) and p not in seen:
                seen.add(p)
                heapq.heappush(heap, (x[p[0]] + y[p[1]], *p))
    return out


def _blocks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each cell: its first block, and over how many blocks it is spread."""
    first, spread = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    block, room = 0, BLOCK_ROWS
    for cell, n in enumerate(counts):
        if n > BLOCK_ROWS:
            block += room < BLOCK_ROWS
            first[cell], spread[cell] = block, -(-n // BLOCK_ROWS)
            block, room = block + spread[cell], BLOCK_ROWS
        elif n:
            if n > room:
                block, room = block + 1, BLOCK_ROWS
            first[cell], room = block, room - n
    return first, spread


def _stack(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.float64)


def search(
    vectors: DataFrame,
    every: int = 100,
    nearest: int = NEAREST,
    scanned: float = SCANNED,
    centroids: int = CENTROIDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score`` (Euclidean distance).

    Queries are the rows whose id is divisible by ``every``; candidates all
    other rows. Ties go to the smaller id. A row that repeats another counts
    once; an id with two vectors is two rows, neither of which finds the other.
    With too few rows a query gets all of them; an empty table gives no rows.
    The driver holds the sample, the codebooks and one count per cell.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    good = materialise(usable(vectors, id_col, vector_col), "vectors")
    sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()
    if sample.empty:
        return empty
    points = _stack(sample["v"])
    half = points.shape[1] // 2
    books = [codebook(points[:, :half], centroids), codebook(points[:, half:], centroids, 1)]
    wide = len(books[1])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                v = _stack(batch["v"])
                cell = _nearest(v[:, :half], books[0]) * wide + _nearest(v[:, half:], books[1])
                yield batch.assign(cell=cell)

    index = materialise(good.mapInPandas(encode, "vec_id long, v array<double>, cell long"), "cells")
    counts = np.zeros(len(books[0]) * wide, np.int64)
    for r in index.groupBy("cell").count().collect():
        counts[r["cell"]] = r["count"]
    total = int(counts.sum())
    first, spread = _blocks(counts)
    shares = max(1, -(-total // every // QUERIES_TOGETHER))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for query_id, v, own in zip(batch["vec_id"], batch["v"], batch["own"]):
                left = ((books[0] - v[:half]) ** 2).sum(1)
                right = ((books[1] - v[half:]) ** 2).sum(1)
                cells = np.array(visited(left, right, counts, max(scanned * total, nearest + own)), np.int64)
                owner = np.repeat(first[cells], spread[cells])
                owner += np.concatenate([np.arange(n) for n in spread[cells]])
                held = np.repeat(cells, spread[cells])
                order = owner.argsort(kind="stable")
                blocks, at = np.unique(owner[order], return_index=True)
                yield pd.DataFrame(
                    {
                        "block": blocks,
                        "share": query_id // every % shares,
                        "query_id": query_id,
                        "q": [v] * len(blocks),
                        "cells": np.split(held[order], at[1:]),
                    }
                )

    queries = index.where(F.col("vec_id") % every == 0).select("vec_id", "v")
    # Few bytes, much work: the walks are dealt out by their number.
    walks = max(1, total // every // QUERIES_A_TASK)
    asked = (
        queries.join(queries.groupBy("vec_id").agg(F.count("*").alias("own")), "vec_id")
        .repartition(walks, "vec_id")
        .mapInPandas(ask, "block long, share long, query_id long, q array<double>, cells array<long>")
    )

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = batch["cell"].to_numpy()
            yield batch.assign(block=first[cell] + batch["h"].to_numpy() % spread[cell]).drop(columns="h")

    dealt = (
        index.withColumn("h", F.shiftrightunsigned(F.xxhash64("vec_id"), 1))
        .mapInPandas(deal, "vec_id long, v array<double>, cell long, block long")
        .withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    )

    def rank(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            ids, v, cell = rows["vec_id"].to_numpy(), _stack(rows["v"]), rows["cell"].to_numpy()
            for query_id, q, cells in zip(queries["query_id"], queries["q"], queries["cells"]):
                mine = np.flatnonzero(np.isin(cell, cells) & (ids != query_id))
                apart = v[mine] - q
                far = np.sqrt((apart * apart).sum(axis=1))
                best = np.lexsort((ids[mine], far))[:nearest]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[mine][best], "score": far[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    near = (
        dealt.groupBy("block", "share")
        .cogroup(asked.groupBy("block", "share"))
        .applyInPandas(rank, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )
