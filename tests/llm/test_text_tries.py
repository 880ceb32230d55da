import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from quayside.llm import text_tries as tt
from tests.llm import cases

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
           "good_lost", "toxic_lost", "shapley")


def brute(rows, labels):
    """The audit from (id, text, lang) rows, filter by filter."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    docs = []
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and least[t] < i}
        docs.append((lang or "", fails, i in good, i in toxic))
    out = set()
    for part in {d[0] for d in docs}:
        mine, rows_, shapley = [d for d in docs if d[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                shapley[f] += len(gone)
                failing = sum(d[1][f] for d in mine)
                alone = sum(d[1][f] and sum(d[1].values()) == 1 for d in mine)
                rows_.append((part, "".join(order), step, len(left), len(gone),
                              failing - len(gone), alone, sum(d[2] for d in gone),
                              sum(d[3] for d in gone), f))
        out |= {r[:-1] + (shapley[r[-1]],) for r in rows_}
    return out


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {c: F.lit("own") for c in ("part", "mask", "n", "prefix", "text_hash", "good", "step",
                                   "quality", "least")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn(
        "text", F.lit("own"))
    return docs, marks


def result(spark, rows, labels):
    return {tuple(r) for r in tt.audit(tt.masks(*frames(spark, rows, labels)))
            .select(*COLUMNS).collect()}


LABELS = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, None, None), (7, 1, 1), (None, 1, 1), (99, 1, 1),
          (10, 1, 0)]


def test_odd_rows(spark):
    rows = [(i, t, lang) for (i, t), lang in zip(cases.TEXTS, itertools.cycle(["en", None, ""]))]
    rows += [(5, "another text of one id", "en"), (None, "", None), (12, "a$b", "de"),
             (13, "one", "de"), (14, "ONE", "de")]
    assert result(spark, rows, LABELS) == brute(rows, LABELS)


def test_no_rows_and_no_labels(spark):
    assert result(spark, [], LABELS) == set()
    rows = [(1, None, "en"), (2, "", "en")]
    assert result(spark, rows, []) == brute(rows, [])


def test_random_texts_with_copies(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, t, rng.choice(["en", "fr", None])) for i, t in cases.prose(3, 250)]
    head = "the same long heading " * 20
    rows += [(2000 + i, head + rng.choice("abc") * rng.randint(0, 3), "fr") for i in range(120)]
    rows += [(3000 + i, "one hot text # with a sign", rng.choice(["en", "fr"])) for i in range(400)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i, _, _ in rows if rng.random() < 0.4]
    assert result(spark, rows, labels) == brute(rows, labels)
    monkeypatch.setattr(tt, "BUFFER_BYTES", 2000)
    assert result(spark, rows, labels) == brute(rows, labels)


def test_heavy_prefixes_are_extended(spark):
    head = "x" * 100
    rows = [(i, head + f"{i:03d}") for i in range(200)] + [(500, "y" * 400)]
    texts = cases.documents(spark, rows, clashing=False).withColumn(
        "text_hash", F.xxhash64("text"))
    keys = texts.select(tt.adaptive_prefix(texts, share=0.1).alias("k")).distinct().count()
    assert keys == 201


@pytest.mark.parametrize("seed", range(5))
def test_trie_releases_terminals_in_order(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.choices(b"ab\xc3", k=rng.randint(0, 9))) for _ in range(400)]
    pairs = sorted((t, rng.randrange(1000)) for t in texts)
    trie, got, last = tt.RadixTrie(), [], None
    for text, number in pairs:
        trie.insert(text, number, text)
        if text != last:
            got += trie.release(text)
            last = text
    got += trie.terminals()
    want = {}
    for text, number in pairs:
        want[text] = min(number, want.get(text, number))
    assert sorted(got) == sorted((n, t) for t, n in want.items())
    # Any order of insertion gives the same trie.
    rng.shuffle(pairs)
    trie = tt.RadixTrie()
    for text, number in pairs:
        trie.insert(text, number, text)
    assert sorted(trie.terminals()) == sorted(got)
