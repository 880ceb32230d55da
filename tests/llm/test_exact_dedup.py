import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import exact_dedup as ed
from quayside.llm import fuse_filter
from tests.llm import cases


def brute(rows):
    """keep_id, size and verdict of each (id, text), by the whole text."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode("utf-8")).hexdigest()
        out += [(i, keep if len(ids) > 1 else i, len(ids),
                 i == keep if len(ids) > 1 else True, sha) for i in ids]
    return sorted(out, key=repr)


def result(df):
    out = df.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_filters_pass_all_their_keys():
    rng = np.random.default_rng(5)
    others = rng.integers(-2 ** 63, 2 ** 63 - 1, 50_000)
    for n in (0, 1, 2, 7, 100, 30_000):
        keys = rng.integers(-2 ** 63, 2 ** 63 - 1, n)
        found = fuse_filter.build(np.concatenate([keys, keys]))
        assert fuse_filter.passes(found, keys).all()
        assert fuse_filter.passes(found, others).mean() < (0.01 if n else 1e-9)
        if n == 30_000:
            assert len(found) * 8 < 10.5 * n


def test_odd_rows(spark):
    rows = cases.TEXTS + [(20, "a  b"), (19, "a\t\nb"), (None, "a b"), (30, " a b"), (31, " ")]
    docs = cases.documents(spark, rows)
    assert result(ed.deduplicate(ed.halves(docs))) == brute(rows)
    assert result(ed.deduplicate([docs])) == brute(rows)


def test_empty_tables_and_batches(spark):
    none = cases.empty(spark)
    assert ed.deduplicate(ed.halves(none)).count() == 0
    docs = cases.documents(spark)
    assert result(ed.deduplicate([none, docs, none])) == brute(cases.TEXTS)
    nameless = cases.documents(spark, [(None, "x"), (None, "x"), (None, None)])
    assert result(ed.deduplicate(ed.halves(nameless))) == brute(
        [(None, "x"), (None, "x"), (None, None)])


def test_three_snapshots_many_buckets(spark):
    rows = cases.prose(4, 300)
    parts = [cases.documents(spark, rows[k::3], clashing=False) for k in range(3)]
    assert result(ed.deduplicate(parts, bucket_keys=7)) == brute(rows)


def test_large_batch_against_small_snapshot(spark):
    rows = cases.prose(6, 200)
    small, large = (cases.documents(spark, r, clashing=False) for r in (rows[:3], rows[3:]))
    assert result(ed.deduplicate([small, large], bucket_keys=10)) == brute(rows)


def test_texts_of_one_digest_are_told_apart(spark):
    """A hash of four values: the byte check alone decides."""
    rows = cases.prose(8, 120) + [(1000, "one"), (1001, "one"), (1002, "two")]
    parts = [cases.documents(spark, rows[k::2], clashing=False) for k in range(2)]

    def weak(text):
        return F.to_binary(F.pmod(F.xxhash64(text), F.lit(4)).cast("string"), F.lit("utf-8"))

    got = [t[:4] for t in result(ed.deduplicate(parts, digest=weak))]
    assert sorted(got, key=repr) == sorted((t[:4] for t in brute(rows)), key=repr)


def test_one_text_of_most_rows(spark):
    rows = [(i, "hot") for i in range(4000)] + [(5000 + i, f"t{i // 2}") for i in range(400)]
    docs = cases.documents(spark, rows, clashing=False)
    assert result(ed.deduplicate(ed.halves(docs))) == brute(rows)
