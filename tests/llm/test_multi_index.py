import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import multi_index as mi


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit("own") for c in ("v", "cell", "rank", "score", "query_id", "block")})


def brute(rows, k, wanted):
    data = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            data.setdefault(i, np.array(v, dtype=np.float32).astype(float))
    out = {}
    for q, qv in data.items():
        if wanted(q):
            near = sorted((float(np.sqrt(((v - qv) ** 2).sum())), i) for i, v in data.items()
                          if i != q)[:k]
            out[q] = [(i, s) for s, i in near]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_walk_orders_cells_by_sum():
    rng = np.random.default_rng(1)
    first, second = rng.random(6), rng.random(5)
    counts = np.ones((6, 5), dtype=int)
    got = mi.walk(first, second, counts, 30)
    sums = [first[c // 5] + second[c % 5] for c in got]
    assert sorted(got) == list(range(30)) and sums == sorted(sums)
    assert len(mi.walk(first, second, counts, 7)) == 7


def test_exact_where_all_cells_are_walked(spark):
    rng = random.Random(3)
    same = [rng.random() for _ in range(6)]
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], 0) for i in range(300)]
    rows += [(300 + i, same, 0) for i in range(60)]
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 6, 0), (403, [float("nan")] * 6, 0),
             (404, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (None, same, 0), (405, [math.inf] * 6, 0)]
    rows += rows[:20]
    got = result(mi.search(vectors(spark, rows), F.col("vec_id") % 10 == 0, centroids=8, visit=1.0,
                           block_rows=40, query_rows=7))
    assert got == brute(rows, 10, lambda i: i % 10 == 0)


def test_recall(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=32).tolist(), 0) for i in range(4000)]
    got = result(mi.search(vectors(spark, rows), F.col("vec_id") % 100 == 0))
    want = brute(rows, 10, lambda i: i % 100 == 0)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    got = result(mi.search(table, F.col("vec_id") % 100 == 0))
    want = brute(rows, 10, lambda i: i % 100 == 0)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9


def test_visited_share_is_measured():
    """Clustered vectors need few entries, shapeless ones most; each share meets
    its recall."""
    rng = np.random.default_rng(8)
    shapeless = rng.normal(size=(3000, 32))
    clustered = rng.normal(size=(60, 32))[rng.integers(60, size=3000)] + shapeless / 20
    share = {}
    for name, rows in (("shapeless", shapeless), ("clustered", clustered)):
        halves = [rows[:, :16], rows[:, 16:]]
        centres = [mi.kmeans(x, 32) for x in halves]
        share[name] = [mi.visited_share(rows, halves, centres, 10, r) for r in (0.8, 0.95, 1.0)]
        assert share[name] == sorted(share[name])
    assert share["clustered"][1] < 0.1 < share["shapeless"][1] < 0.9
    assert mi.visited_share(rows[:1], [x[:1] for x in halves], centres, 10, 0.9) == 1.0


def test_no_query_group_takes_blocks_it_did_not_ask_for(spark):
    """Two far clusters and queries in one: exact results from that one's blocks,
    in several groups of queries."""
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) + 1000 * (i % 2) for _ in range(4)], 0) for i in range(400)]
    got = result(mi.search(vectors(spark, rows), F.col("vec_id") % 10 == 0, centroids=4,
                           visit=0.5, block_rows=30, query_rows=3))
    assert got == brute(rows, 10, lambda i: i % 10 == 0)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0], 0), (1, [2.0], 0), (2, [4.0], 0)]
    assert result(mi.search(vectors(spark, rows), F.col("vec_id") == 0)) == {0: [(1, 1.0), (2, 3.0)]}
    assert mi.search(vectors(spark, []), F.col("vec_id") == 0).count() == 0
    assert mi.search(vectors(spark, rows), F.col("vec_id") == 9).count() == 0
    assert mi.search(vectors(spark, [(0, None, 0)]), F.col("vec_id") == 0).count() == 0
