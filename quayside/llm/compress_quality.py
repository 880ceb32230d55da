"""Quality score by compression.

Method. One zstandard dictionary is built from text labelled good and one from
text labelled bad. A text is compressed with either, in blocks of ``BLOCK``
bytes over its whole length; the normalised difference of the two sizes, beside
the share of the text that is left, is turned into a probability by a logistic
curve fitted on labelled rows that no dictionary has seen.

Bound. The fit uses at most ``fit_rows`` labelled rows of at most ``fit_bytes``
bytes in all, chosen by a hash of the id over the whole label table; half of
them build the dictionaries, half calibrate. Scoring covers every row and its
whole text, one pass without a shuffle; the model that is broadcast has a fixed
size (two dictionaries of at most ``DICT_BYTES`` and three numbers).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.frames import handing_back

BLOCK = 256
DICT_BYTES = 64 << 10
LEVEL = 3
PIECE = 1024  # bytes of a text that enter a dictionary as one sample


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]
    """Of the size difference and the share left, and the constant."""


class Scorer:
    def __init__(self, good: bytes, bad: bytes, weights=(0.0, 0.0, 0.0)):
        self.weights = np.array(weights)
        params = zstd.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_dict_id=False, format=zstd.FORMAT_ZSTD1_MAGICLESS)
        self.by = []
        for content in (good, bad):
            book = zstd.ZstdCompressionDict(content)
            book.precompute_compress(compression_params=params)
            self.by.append(zstd.ZstdCompressor(dict_data=book, compression_params=params))

    def features(self, text: str | None) -> tuple[float, float]:
        data = (text or "").encode("utf-8", "replace")
        sizes = [0, 0]
        for at in range(0, len(data), BLOCK):
            block = data[at:at + BLOCK]
            for k, by in enumerate(self.by):
                sizes[k] += len(by.compress(block))
        good, bad = sizes
        if not data:
            return 0.0, 0.0
        return (bad - good) / (bad + good), min(1.0, min(good, bad) / len(data))

    def score(self, text: str | None) -> float:
        a, b = self.features(text)
        z = float(self.weights @ (a, b, 1.0))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _book(texts: list[bytes]) -> bytes:
    """A dictionary trained on pieces of the texts; where they are too few to
    train on, the texts themselves."""
    pieces = [x[at:at + PIECE] for x in texts for at in range(0, min(len(x), 6 * PIECE), PIECE)]
    try:
        return zstd.train_dictionary(DICT_BYTES, pieces).as_bytes()
    except zstd.ZstdError:
        return b"\n".join(texts)[:DICT_BYTES].ljust(8)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3, 1e-3, 1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)),
                               x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(rows: list[tuple[str, int]]) -> Model:
    """``rows``: text and label (1 good, 0 bad), in any fixed order."""
    build, judge = rows[::2], rows[1::2]
    books = [_book([t.encode("utf-8", "replace") for t, y in build if y == label])
             for label in (1, 0)]
    labels = np.array([y for _, y in judge], dtype=float)
    if len(set(labels)) < 2 or len({y for _, y in build}) < 2:
        seen = [y for _, y in rows]
        rate = (sum(seen) + 1) / (len(seen) + 2)
        return Model(*books, (0.0, 0.0, float(np.log(rate / (1 - rate)))))
    scorer = Scorer(*books)
    found = _logistic(np.array([scorer.features(t) for t, _ in judge]), labels)
    return Model(*books, tuple(map(float, found)))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", fit_rows: int = 6000, fit_bytes: int = 24 << 20) -> Model:
    """Fit on at most ``fit_rows`` rows of ``docs`` that ``labels`` marks 0 or 1.
    Null ids, labels and texts are left out; an id with two labels counts as
    bad; with no labelled row every score is one half."""
    label = F.col(label_col).cast("int")
    marked = (labels.where(F.col(id_col).isNotNull() & label.isin(0, 1))
              .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label).alias("y")))
    # At most fit_rows ids: the only data that is broadcast.
    picked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text")).where(
        F.col("text").isNotNull() & (F.octet_length("text") <= fit_bytes // 64))
    found = (texts.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])
             .orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "y"))
    rows, held = [], 0
    for r in found.limit(fit_rows).toLocalIterator():
        held += len(r["text"])
        if held > fit_bytes:
            break
        rows.append((r["text"], r["y"]))
    return train(rows)


def score_column(spark, model: Model, text):
    """The score of a text column: 0 to 1, higher is likelier good."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        scorer = Scorer(m.good, m.bad, m.weights)
        for texts in batches:
            # A batch's texts stay in Arrow; one at a time becomes a Python string.
            yield pa.array([scorer.score(t.as_py()) for t in texts], pa.float64())

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return handing_back(run)(batches)

    return score(text)


def score_documents(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with a ``score`` column (an earlier column of that name is
    replaced). A null or empty text gets the curve's value at zero; every row
    and every other column stays."""
    return docs.withColumn("score", score_column(docs.sparkSession, model, F.col(text_col)))
