import re

import numpy as np
import pytest

from quayside.llm import jaccard_join as jj
from quayside.llm.components import connected
from tests.llm import cases


def grams(text, n):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n, percent):
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets[doc] = grams(text, n)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {(d, len(sets[d]), root(d)) for d in ids}


@pytest.mark.parametrize("n,percent,bits", [(3, 90, 10), (5, 80, 4), (2, 60, 12)])
def test_equals_brute_force(spark, n, percent, bits):
    rows = cases.prose(n, 250)
    got = jj.components(cases.documents(spark, rows).repartition(5), n=n, percent=percent,
                        sketch_bits=bits).collect()
    assert len(got) == len(rows)
    assert {tuple(r) for r in got} == brute(rows, n, percent)


def test_chains_and_hot_columns(spark):
    """Every text shares all n-grams but a few with the next one only."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 2:i * 2 + 60])) for i in range(120)]
    rows += [(1000 + i, " ".join(words[:30]) + f" own{i} " * 40) for i in range(60)]
    got = jj.components(cases.documents(spark, rows), n=3, percent=80, sketch_bits=8).collect()
    assert {tuple(r) for r in got} == brute(rows, 3, 80)


def test_odd_rows(spark):
    rows = jj.components(cases.documents(spark), n=3, percent=90, sketch_bits=8).collect()
    assert len(rows) == len(cases.TEXTS)
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows
             if r["doc_id"] is not None}
    assert by_id[2] == (0, 2) and by_id[3] == (0, 3) and by_id[4] == (0, 4)
    assert by_id[7][1] == 1 and by_id[12] == (1, 5) and by_id[6] == (1, 6)
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None, None]


def test_one_of_each(spark):
    kept = jj.one_of_each(cases.documents(spark), n=3, percent=90, sketch_bits=8)
    assert kept.columns == cases.documents(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 2, 3, 4, 5, 6, 8, 9, 10, 11] and ids.count(None) == 2


def test_empty_table(spark):
    assert jj.components(cases.empty(spark), sketch_bits=8).count() == 0
    assert jj.one_of_each(cases.empty(spark), sketch_bits=8).count() == 0


def test_linked_counts_exactly():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 40, rng.integers(1, 40)).astype(np.uint64))
                for _ in range(2))
        both = len(np.intersect1d(a, b))
        assert jj.linked(a, b, 60) == (100 * both >= 60 * (len(a) + len(b) - both))


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 90), (95, 100)],
                                  "a long, b long")
    got = {r["node"]: r["component"] for r in connected(links).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {90: 90, 95: 90, 100: 90}


def test_rows_of_one_id_with_two_texts_both_stay(spark):
    rows = [(1, "alpha beta gamma delta epsilon"), (1, "one two three four five six"),
            (1, "alpha beta gamma delta epsilon"), (2, "one two three four five six")]
    kept = jj.one_of_each(cases.documents(spark, rows), n=3, percent=90, sketch_bits=8).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [rows[0], rows[1]]


def test_hot_columns_of_unlinked_texts(spark):
    """Texts of common lines, none linked to another: columns are hot, links are none."""
    import random
    rng = random.Random(1)
    lines = [" ".join(f"l{i}w{j}" for j in range(12)) for i in range(40)]
    rows = [(i, " ".join(rng.sample(lines, 6))) for i in range(300)]
    got = jj.components(cases.documents(spark, rows), n=3, percent=80, sketch_bits=8).collect()
    assert {tuple(r) for r in got} == brute(rows, 3, 80)
