"""Nearest neighbours by an inverted multi-index.

Method. Each half of a vector is quantised by its own ``centroids`` k-means
centroids, so a cell is a pair of centroids. A query walks the pairs in order
of summed squared distance with a heap (the multi-sequence traversal) until the
cells it has met hold at least ``visit`` of all entries and the query's ``k``;
these entries are reranked by the exact double-precision distance. ``visit`` is
measured, not set: it is the share at which walks over the sample meet
``recall`` of the true neighbours there, found by brute force for ``PROBES`` of
its vectors. In the whole table neighbours are nearer than in a sample of it, so
the share errs on the careful side.

At scale. The centroids and that share are fitted on at most ``sample_rows``
vectors, chosen by a hash of the whole table; every row is indexed. The cell
counts are one
aggregate of at most ``centroids ** 2`` rows; from them each cell gets a block
of about ``block_rows`` entries, and a cell with more is split over several.
Queries go to the blocks that hold their cells, in as many groups of about
``query_rows`` as the block is asked by, and entries to the groups of their block
alone, so a task holds one block of entries and one group of queries whatever the
sizes, and a block that no query walks goes nowhere.
Copies of one vector are cut to the ``k + 1`` smallest ids before the shuffle:
no more can be among a query's neighbours.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.frames import written

PROBES = 512


def kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows of the (hash-ordered) sample."""
    k = min(k, len(rows))
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = squared(rows, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        counts = np.bincount(near, minlength=k)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def squared(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    gap = (rows ** 2).sum(1)[:, None] - 2 * rows @ centres.T + (centres ** 2).sum(1)
    return np.maximum(gap, 0)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells by growing ``first[i] + second[j]``, from a heap, until they hold
    ``wanted`` entries. ``counts`` has a row for each ``i``."""
    a, b = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    d1, d2, width = first[a].tolist(), second[b].tolist(), len(second)
    sizes = counts.tolist()
    heap, out, got = [(d1[0] + d2[0], 0, 0)], [], 0
    while heap and got < wanted:
        _, i, j = heapq.heappop(heap)
        size = sizes[a[i]][b[j]]
        if size:
            got += size
            out.append(a[i] * width + b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (d1[i] + d2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (d1[i + 1] + d2[0], i + 1, 0))
    return out


def visited_share(rows: np.ndarray, halves: list[np.ndarray], centres: list[np.ndarray],
                  k: int, recall: float) -> float:
    """The share of ``rows`` that walks have to visit to meet ``recall`` of the
    ``k`` nearest of ``PROBES`` evenly spaced ones; 1 where there are no others.
    ``halves`` are the rows' two parts."""
    width, n = len(centres[1]), len(rows)
    if n < 2:
        return 1.0
    cells = (squared(halves[0], centres[0]).argmin(1) * width
             + squared(halves[1], centres[1]).argmin(1))
    counts = np.bincount(cells, minlength=len(centres[0]) * width)
    need = []
    for at in np.unique(np.linspace(0, n - 1, PROBES).astype(int)):
        gap = ((rows - rows[at]) ** 2).sum(1)
        gap[at] = np.inf
        near = np.argpartition(gap, min(k, n - 1) - 1)[:min(k, n - 1)]
        sums = (squared(halves[0][at:at + 1], centres[0])[0][:, None]
                + squared(halves[1][at:at + 1], centres[1])[0]).ravel()
        order = np.argsort(sums, kind="stable")
        before = np.empty(len(order), dtype=np.int64)
        before[order] = np.cumsum(counts[order]) - counts[order]
        need.append(before[cells[near]] + 1)
    return float(np.quantile(np.concatenate(need), recall, method="higher")) / n


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` of the rows that take part: no null id, and a vector that
    is not null, not empty, not zero and has only finite components."""
    v = F.col(vector_col).cast("array<double>")
    whole = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & v.isNotNull())
            .where(whole & F.exists(v, lambda x: x != 0))
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")))


def search(vectors: DataFrame, queries, *, k: int = 10, id_col: str = "vec_id",
           vector_col: str = "embedding", centroids: int = 128, visit: float | None = None,
           recall: float = 0.95, sample_rows: int = 20_000, block_rows: int = 2048,
           query_rows: int = 2048) -> DataFrame:
    """The ``k`` nearest found for each query row; ``queries`` is a condition on
    ``vec_id`` that names the query set. ``visit`` sets the visited share by hand;
    1 makes the search exact.

    Returns ``query_id, rank, vec_id, score``. Every row but the query's own is a
    candidate. Vectors that are null, zero, or hold a null or non-finite
    component take no part, nor do rows without an id or vectors of another
    length than the sample's commonest; repeated rows count once; ties go to the
    smaller ``vec_id``; with no usable vector or query the result is empty.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, id_col, vector_col).dropDuplicates(["vec_id", "v"])
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id", "v")).select("v")
              .limit(sample_rows).collect()]
    if not sample:
        return spark.createDataFrame([], out)
    sizes = np.bincount([len(v) for v in sample])
    dim = int(sizes.argmax())
    fit = np.array([v for v in sample if len(v) == dim])
    half = max(1, dim // 2)
    # A single component has no second half: a constant stands in for it.
    cut = (lambda x: (x[:, :half], x[:, half:] if dim > 1 else np.zeros((len(x), 1))))
    fitted = [kmeans(x, centroids) for x in cut(fit)]
    centres = spark.sparkContext.broadcast(fitted)
    if visit is None:
        distinct = np.unique(fit, axis=0)  # copies would be found for nothing
        visit = visited_share(distinct, cut(distinct), fitted, k, recall)

    def place(batches):
        for batch in batches:
            if len(batch):
                near = [squared(x, c).argmin(1) for x, c
                        in zip(cut(np.stack(batch["v"].to_numpy())), centres.value)]
                batch["cell"] = (near[0] * len(centres.value[1]) + near[1]).astype("int32")
                yield batch

    copies = Window.partitionBy("v").orderBy("vec_id")
    rows = rows.where(F.size("v") == dim)
    entries = written(
        rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
        .select("vec_id", "v")
        .mapInPandas(place, "vec_id long, v array<double>, cell int"), "multi-index")
    counts = {r["cell"]: r["count"] for r in entries.groupBy("cell").count().collect()}
    total = sum(counts.values())
    wanted = max(k + 1, math.ceil(visit * total))

    first_block, parts, block, held = {}, {}, 0, 0
    for cell in sorted(counts):
        n = counts[cell]
        if held and held + n > block_rows:
            block, held = block + 1, 0
        first_block[cell], parts[cell] = block, -(-n // block_rows)
        if n > block_rows:
            block, held = block + parts[cell], 0
        else:
            held += n
    asked = rows.where(queries)
    index = spark.sparkContext.broadcast((counts, first_block, parts))

    def route(batches):
        """Each query to the blocks of the cells it walks, with those cells."""
        counts, first_block, parts = index.value
        one, two = centres.value
        grid = np.zeros((len(one), len(two)), dtype=np.int64)
        for cell, n in counts.items():
            grid[cell // len(two), cell % len(two)] = n
        for batch in batches:
            for q, v in zip(batch["vec_id"], batch["v"]):
                x, y = cut(np.array(v)[None])
                blocks: dict[int, list[int]] = {}
                for cell in walk(squared(x, one)[0], squared(y, two)[0], grid, wanted):
                    for part in range(parts[cell]):
                        blocks.setdefault(first_block[cell] + part, []).append(cell)
                yield pd.DataFrame({"query_id": q, "qv": [v] * len(blocks),
                                    "block": list(blocks), "cells": list(blocks.values())})

    def block_of(batches):
        _, first_block, parts = index.value
        for batch in batches:
            part = batch.pop("part").to_numpy()
            cells = batch["cell"].to_numpy()
            batch["block"] = [first_block[c] + p % parts[c] for c, p in zip(cells, part)]
            yield batch

    def rerank(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            left = left.sort_values("vec_id", kind="stable")
            ids, cells = left["vec_id"].to_numpy(), left["cell"].to_numpy()
            matrix = np.stack(left["v"].to_numpy())
            for q, qv, seen in zip(right["query_id"], right["qv"], right["cells"]):
                at = np.flatnonzero(np.isin(cells, seen) & (ids != q))
                if len(at):
                    score = np.sqrt(((matrix[at] - np.asarray(qv)) ** 2).sum(1))
                    best = np.argsort(score, kind="stable")[:k]
                    found.append(pd.DataFrame({"query_id": q, "vec_id": ids[at[best]],
                                               "score": score[best]}))
        return (pd.concat(found) if found
                else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}))

    asked = written(asked.mapInPandas(
        route, "query_id long, qv array<double>, block int, cells array<int>"),
        "multi-index-asked")
    groups = asked.groupBy("block").agg(
        F.ceil(F.count("*") / F.lit(query_rows)).cast("int").alias("groups"))
    asked = (asked.join(groups, "block")
             .withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int"))
             .drop("groups"))
    entries = (entries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)).cast("int"))
               .mapInPandas(block_of, "vec_id long, v array<double>, cell int, block int")
               .join(groups, "block")
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
               .drop("groups"))
    found = (entries.groupBy("block", "part").cogroup(asked.groupBy("block", "part"))
             .applyInPandas(rerank, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
