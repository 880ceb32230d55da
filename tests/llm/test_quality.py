"""Ops 1 and 9: the classifier by held-out accuracy, the rules by brute force."""

import collections
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quayside.llm import compress_quality as cq
from quayside.llm import frames
from quayside.llm import quality_rules as qr
from quayside.llm.frames import table
from quayside.llm.queries import held_out
from tests.llm import cases

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents")
    model = cq.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    test = labels.where(held_out(F.col("doc_id"))).select("doc_id", "quality")
    rows = cq.score_documents(docs.join(test, "doc_id"), model).select("quality", "score").collect()
    right = sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in rows) / len(rows)
    assert right >= 0.95
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["score"] >= 0.5 for r in good) / len(good) >= 0.98


def test_held_out_fold(spark):
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)


def test_classifier_on_odd_rows(spark):
    model = cq.train([("good words in a row " * 5, 1), ("!!! !!!", 0)] * 20)
    out = cq.score_documents(cases.documents(spark), model)
    rows = out.collect()
    assert len(rows) == len(cases.TEXTS) and out.columns.count("score") == 1
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1


@pytest.mark.parametrize("rows", [[], [("a text", 1)], [("a", 1), ("b", 1), ("c", 1)]])
def test_classifier_without_two_labels(spark, rows):
    assert 0 <= cq.Scorer(**vars(cq.train(rows))).score("any") <= 1


def test_classifier_on_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = cq.fit(cases.empty(spark), labels)
    assert cq.score_documents(cases.empty(spark), model).count() == 0
    assert cq.fit(cases.documents(spark), labels).weights[2] == 0


def test_a_worker_keeps_what_its_own_operator_kept():
    frames.kept_by("packing")["a"] = "an encoder"
    assert list(frames.handing_back(iter, "packing")(iter([1, 2]))) == [1, 2]
    assert frames.kept_by("packing") == {"a": "an encoder"}
    assert list(frames.handing_back(iter)(iter([3]))) == [3]
    assert frames.kept_by("packing") == {}


def test_scores_are_those_of_the_scorer(spark):
    model = cq.train([("good words in a row " * 5, 1), ("!!! !!!", 0)] * 20)
    scorer = cq.Scorer(model.good, model.bad, model.weights)
    texts = [None, "", "a", "\u00e9\u4e2d\U0001f600 \x00" * 300, "good words in a row"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = cq.score_documents(df, model)
    assert {r["doc_id"]: r["score"] for r in got.collect()} == {
        i: scorer.score(t) for i, t in enumerate(texts)}


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    n = len(words)
    windows = collections.Counter(tuple(words[k:k + 8]) for k in range(n - 7))
    covered = {i for k in range(n - 7) if windows[tuple(words[k:k + 8])] > 1
               for i in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def test_counts_equal_brute_force(spark):
    rows = cases.TEXTS + cases.prose(1, 60, words=6) + [
        (500, "a b c d e f g h " * 3), (501, "a b c d e f g h a b c d e f g h a b"), (502, "x " * 40),
        (503, "# | <b>\n# | <b>\n\x0b\n"), (504, " ".join("abcdefgh") + " z " + " ".join("abcdefgh"))]
    out = qr.judge(cases.documents(spark, rows), qr.learn([]))
    got = collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"],
                               r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
                              for r in out.collect())
    assert got == collections.Counter((d, *brute(t)) for d, t in rows)
    assert out.columns.count("kept") == 1 and out.columns.count("n_words") == 1


def test_rules_tell_labels_apart_without_seeing_them(spark):
    docs = table(spark, SF, "documents").join(table(spark, SF, "labels"), "doc_id")
    model = qr.fit(table(spark, SF, "documents"))
    rows = (qr.judge(docs, model).where(~F.col("base_failed")).groupBy("quality", "kept").count()
            .collect())
    n = {(r["quality"], r["kept"]): r["count"] for r in rows}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) >= 0.99
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) >= 0.9


def test_keep_holds_rows_and_columns(spark):
    docs = cases.documents(spark, cases.TEXTS + cases.prose(2, 30))
    model = qr.fit(docs)
    kept = qr.keep(docs, model)
    assert kept.columns == docs.columns
    want = qr.judge(docs, model).where(F.col("posterior") >= 0.5).where(~F.col("base_failed"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in want.collect())


def test_rules_on_an_empty_table(spark):
    model = qr.fit(cases.empty(spark))
    assert qr.judge(cases.empty(spark), model).count() == 0


def test_a_good_vote_never_speaks_against(spark):
    model = qr.learn([((1, 1, -1, 1, 1, 1, 1), 50), ((1,) * 7, 900), ((0, 1, 1, -1, -1, 1, 1), 20)])
    for kind in range(7):
        assert all(x <= 1e-12 for x in model["good"][kind])
