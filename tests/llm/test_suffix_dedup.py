import random

import pytest
from pyspark.sql import functions as F

from quayside.llm import suffix_dedup as sd
from tests.llm import cases


def brute(rows, length):
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, (text or "").encode())
    first = {}
    for doc in sorted(d for d in texts if d is not None):
        data = texts[doc]
        for p in range(len(data) - length + 1):
            first.setdefault(data[p:p + length], doc)
    out = set()
    for doc, data in texts.items():
        gone = bytearray(len(data))
        if doc is not None:
            for p in range(len(data) - length + 1):
                if first[data[p:p + length]] < doc:
                    gone[p:p + length] = b"\1" * length
        spans, at = [], 0
        while at < len(data):
            if gone[at]:
                end = at
                while end < len(data) and gone[end]:
                    end += 1
                spans.append((at, end))
                at = end
            at += 1
        out.add((doc, len(data), tuple(spans), bytes(b for b, g in zip(data, gone) if not g)))
    return out


def rows_of(df):
    return {(r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]),
             bytes(r["kept"])) for r in df.collect()}


@pytest.mark.parametrize("length,n,options", [
    (50, 150, {}), (30, 150, {"bucket_rows": 20}), (50, 25, {"filter_bytes": 200})])
def test_equals_brute_force(spark, length, n, options):
    rows = cases.prose(length, n)
    docs = cases.documents(spark, rows).repartition(3)
    got = sd.remove_repeats(docs, length=length, **options)
    assert got.count() == len(rows)
    assert rows_of(got) == brute(rows, length)


def test_long_texts_are_cut_without_losing_strings(spark, monkeypatch):
    rows = cases.prose(9, 60)
    rows += [(1000, " ".join(t for _, t in rows)), (1001, "a" * 500), (1002, "a" * 700)]
    names = [sd.parts([d for d, _ in rows], [t.encode() for _, t in rows], 50)]
    whole = {x for chunk in names for x in _strings(chunk, 50)}
    monkeypatch.setattr(sd, "CHUNK", 300)
    cut = [x for chunk in sd.parts([d for d, _ in rows], [t.encode() for _, t in rows], 50)
           for x in _strings(chunk, 50)]
    assert len(cut) == len(set(cut)) and set(cut) == whole


def _strings(chunks, length):
    for ids, begins, data, ends in chunks if isinstance(chunks, list) or hasattr(
            chunks, "__next__") else [chunks]:
        starts = [0, *ends[:-1]]
        _, first, last, text = sd.samples(data, ends, length)
        for a, b, t in zip(first, last, text):
            for p in range(a, b + 1):
                yield ids[t], p - starts[t] + begins[t]


def test_odd_rows(spark):
    got = rows_of(sd.remove_repeats(cases.documents(spark), length=50))
    assert {r[:3] for r in got} == {r[:3] for r in brute(
        [r for r in cases.TEXTS if r[0] is not None], 50)} | {(None, 19, ()), (None, 0, ())}


def test_ids_with_two_texts_lose_nothing(spark):
    text = "a passage of more than fifty bytes that stands in all of these rows " * 2
    rows = [(1, text), (2, text), (2, "x" + text), (3, text + "y")]
    got = rows_of(sd.remove_repeats(cases.documents(spark, rows), length=50))
    assert (2, len(text), (), text.encode()) in got
    assert (3, len(text) + 1, ((0, len(text)),), b"y") in got


def test_text_stays_readable(spark):
    text = "é" * 60
    rows = [(1, "a" + text), (2, "bb" + text + "c"), (3, None)]
    docs = cases.documents(spark, rows)
    out = sd.without_repeats(docs, length=51)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a" + text, 2: "bbc", 3: ""}


def most_in_a_bucket(spark, monkeypatch, rows, **options):
    """Strings in the fullest bucket that is sorted, and the result."""
    docs, seen = cases.documents(spark, rows).repartition(3), []
    kind = type(docs)
    group = kind.groupBy

    def spy(self, *cols):
        if len(cols) == 1 and isinstance(cols[0], str) and cols[0] == "bucket":
            seen.append(self)
        return group(self, *cols)

    with monkeypatch.context() as m:
        m.setattr(kind, "groupBy", spy)
        got = rows_of(sd.remove_repeats(docs, length=50, **options))
    size = F.when(F.col("bytes").isNull(), 1).otherwise(F.octet_length("bytes") - 49)
    return max(df.groupBy("bucket").agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0]
               for df in seen), got


def test_a_short_line_in_every_document_is_spread(spark, monkeypatch):
    rng = random.Random(4)
    own = lambda: "".join(rng.choices("abcdefgh ", k=60))
    rows = [(i, f"{own()}Share this page with all of your friends now{own() if i % 5 else ''}")
            for i in range(600)]
    most, got = most_in_a_bucket(spark, monkeypatch, rows, bucket_rows=20)
    assert got == brute(rows, 50)
    assert most <= 4 * 20 * 31


def test_a_long_run_of_one_byte_is_few_rows(spark, monkeypatch):
    rows = [(1, "x" + "a" * 30_000), (2, "b" + "a" * 9_000 + "c"), (3, "ab" * 5_000),
            (4, "cab" * 40 + "ab" * 400 + "a" * 70), (5, "d" * 3_000)]
    most, got = most_in_a_bucket(spark, monkeypatch, rows, bucket_rows=20)
    assert got == brute(rows, 50)
    assert most <= 4 * 20 * 31


def test_empty_table(spark):
    assert sd.remove_repeats(cases.empty(spark)).count() == 0


def test_rows_held_do_not_follow_the_text_length(spark, monkeypatch):
    """What is settled together is bounded, in texts of any length."""
    sizes = []
    settle = sd._settle_around

    def noted(found):
        sizes.append(sum(map(len, found)))
        return settle(found)

    monkeypatch.setattr(sd, "_settle_around", noted)
    monkeypatch.setattr(sd, "AROUND", 500)
    monkeypatch.setattr(sd, "CHUNK", 4000)
    import random

    import numpy as np
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(30_000)).encode()

    class Everything:
        value = np.full((1, 8), 0xFFFFFFFF, np.uint32)

    class Rows:  # a frame whose mapInPandas runs here
        def mapInPandas(self, run, _schema):
            import pandas as pd
            return list(run([pd.DataFrame({"doc": [1], "text": [text], "h": ["x"]})]))

    out = sd._around(Rows(), Everything, None, 50, 0, 1)
    assert len(sizes) > 10 and max(sizes) < 500 + 4000
    assert sum(map(len, out)) == sum(sizes)
