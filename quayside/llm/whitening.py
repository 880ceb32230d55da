"""Embedding whitening by weighted multiplicity covariance.

Method. Each vector becomes a vector x of integers. Equal x vectors are grouped once
(copies are combined in the map tasks); their counts, or one, are the weights of the
fit. Integer sums give the exact mean; tasks multiply their centred, weighted rows
(GEMM) and the products are added row by row. Each distinct vector is whitened once,
and the rows take their result by a join on x.

At scale. What reaches the driver has the size of the dimension alone: the sums and the
covariance (``dims ** 2`` doubles). The distinct vectors are written once. In the join
back, vectors with more than one in ``HOT_SHARE`` of all rows (at most ``HOT_SHARE``
vectors) are broadcast; no other key has a larger share of the shuffle.

Defined results. Rows whose vector is null, empty, or holds null or non-finite entries
take no part; nor do rows whose length isn't the most frequent one (the larger of equally
frequent ones). Entries beyond a 64-bit integer count as the nearest one. A component
without variance (below 1e-12 of the trace) has ``whitened`` 0 and stays out of
``identity_error``. ``deviation`` is an exact decimal, null beyond 38 digits. Rows that
repeat an id, and rows without one, are rows like others. Without rows the result is
empty. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.frames import written

# The integer grid of the vectors.
SCALE, SHIFT = 1024, 100_000
HOT_SHARE = 1024
_NO_VARIANCE = 1e-12
_MOST = 10 ** 38


def integers(vector: Column) -> Column:
    """x of a vector: ``floor(1024 c) + 100000`` of each entry, as a double."""
    top = float(2 ** 62)
    return F.transform(vector, lambda c: (F.floor(
        F.greatest(F.lit(-top), F.least(F.lit(top), c.cast("double") * SCALE))) + SHIFT)
        .cast("long"))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c)
                      & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def _matrix(batch: pd.DataFrame, column: str, dtype) -> np.ndarray:
    return np.array([np.asarray(v, dtype) for v in batch[column]], dtype).reshape(len(batch), -1)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - S / n``, the difference taken between integers."""
    return (_offsets(x, n, sums) / n).astype(np.float64)


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S``, exact: in 64 bits where they hold it, else in Python integers."""
    reach = max(abs(int(x.max())), abs(int(x.min())), 1) * n + max(abs(s) for s in sums)
    if reach < 2 ** 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _add_rows(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sums of the partial rows ``i, values`` by ``i`` (a matrix's rows). Those of one
    ``i`` stream through one task, which holds a single sum for each ``i``."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch["i"], batch["values"]):
                held[i] = held.get(i, 0.0) + np.asarray(v, np.float64)
        if held:
            yield pd.DataFrame({"i": list(held), "values": [v.tolist() for v in held.values()]})

    added = parts.repartition("i").mapInPandas(add, "i int, values array<double>").collect()
    return {r["i"]: np.array(r["values"]) for r in added}


def _sums(grouped: DataFrame, dims: int) -> list[int]:
    """Exact weighted sums of x, one per dimension."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [0] * dims
        for batch in batches:
            if len(batch):
                x, w = _matrix(batch, "x", np.int64), batch["weight"].to_numpy(np.int64)
                if max(abs(int(x.max())), abs(int(x.min()))) * int(w.sum()) >= 2 ** 62:
                    x, w = x.astype(object), w.astype(object)
                total = [t + int(s) for t, s in zip(total, (x * w[:, None]).sum(0))]
        yield pd.DataFrame({"d": range(dims), "s": [Decimal(t) for t in total]})

    rows = (grouped.select("x", "weight").mapInPandas(add, "d int, s decimal(38,0)")
            .groupBy("d").agg(F.sum("s").alias("s")).collect())
    return [int(r["s"]) for r in sorted(rows, key=lambda r: r["d"])]


def _products(rows: DataFrame, width: int, centre) -> np.ndarray:
    """Sum over rows of weight * z zT, where ``centre`` gives z of a batch."""
    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                z = centre(batch)
                total += (z * batch["weight"].to_numpy(np.float64)[:, None]).T @ z
        yield pd.DataFrame({"i": range(width), "values": [r.tolist() for r in total]})

    added = _add_rows(rows.mapInPandas(multiply, "i int, values array<double>"))
    return np.array([added.get(i, np.zeros(width)) for i in range(width)])


def _spectrum(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(values, kind="stable")[::-1][:components]
    return np.maximum(values[order], 0), vectors[:, order]


def whiten(rows: DataFrame, components: int = 8, weights: str = "count",
           vector: str = "embedding") -> DataFrame:
    """Whiten ``rows`` (``vec_id`` and a vector column): ``vec_id, component, n,
    deviation, whitened, explained, identity_error``, a row per vector and component.

    ``weights`` fits on every row (``count``) or on each distinct vector once (``one``);
    ``n``, the mean, the covariance and ``identity_error`` follow that choice."""
    if weights not in ("count", "one"):
        raise ValueError("weights must be 'count' or 'one'")
    spark = rows.sparkSession
    valid = rows.where(usable(F.col(vector))).select("vec_id", F.col(vector).alias("v"))
    lengths = valid.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c"))
    most = lengths.orderBy(F.desc("c"), F.desc("d")).first()
    if most is None:
        return _empty(spark)
    dims, total = int(most["d"]), int(most["c"])
    x = valid.where(F.size("v") == dims).select("vec_id", integers(F.col("v")).alias("x"))
    weight = F.col("copies") if weights == "count" else F.lit(1).cast("long")
    grouped = written(x.groupBy("x").agg(F.count("*").alias("copies"))
                      .withColumn("weight", weight), "whiten-distinct")
    n = int(grouped.agg(F.sum("weight")).first()[0])
    sums = _sums(grouped, dims)
    cov = _products(grouped.select("x", "weight"), dims,
                    lambda b: _centred(_matrix(b, "x", np.int64), n, sums)) / n
    values, vectors = _spectrum(cov, min(components, dims))
    trace = float(np.trace(cov))
    alive = values > _NO_VARIANCE * trace
    scale = np.where(alive, 1 / np.sqrt(np.where(alive, values, 1)), 0)
    project = vectors * scale

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            offsets = _offsets(_matrix(batch, "x", np.int64), n, sums)
            y = (offsets / n).astype(np.float64) @ project
            squares = [_exact(s) for s in _squares(offsets)]
            yield pd.DataFrame({"x": batch["x"], "copies": batch["copies"],
                                "weight": batch["weight"], "deviation": squares,
                                "y": y.tolist()})

    done = written(grouped.mapInPandas(
        each, "x array<long>, copies long, weight long, deviation decimal(38,0), "
              "y array<double>"), "whiten-values")
    error = _identity_error(done.select("y", "weight"), len(values), n, alive)
    explained = [float(v / trace) if trace > 0 else 0.0 for v in values]
    shares = F.array(*[F.lit(v) for v in explained])
    joined = _join_back(x, done, total)
    return joined.select(
        "vec_id", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"))


def _squares(offsets: np.ndarray) -> list[int]:
    """Exact sums of squares of each row."""
    if offsets.dtype == object or int(np.abs(offsets).max()) ** 2 * offsets.shape[1] >= 2 ** 62:
        offsets = offsets.astype(object)
    return [int(s) for s in (offsets * offsets).sum(1)]


def _exact(value: int) -> Decimal | None:
    return Decimal(value) if value < _MOST else None


def _identity_error(values: DataFrame, width: int, n: int, alive: np.ndarray) -> float:
    """Largest entry of the whitened values' covariance minus the identity: their mean
    first, then the products of the centred values."""
    means = values.select("weight", F.posexplode("y").alias("d", "v")).groupBy("d").agg(
        (F.sum(F.col("v") * F.col("weight")) / n).alias("m")).collect()
    mean = np.zeros(width)
    for r in means:
        mean[r["d"]] = r["m"]
    cov = _products(values, width, lambda b: _matrix(b, "y", np.float64) - mean) / n
    gap = np.abs(cov - np.eye(width))[np.ix_(alive, alive)]
    return float(gap.max()) if gap.size else 0.0


def _join_back(x: DataFrame, done: DataFrame, total: int) -> DataFrame:
    """Each row with its vector's deviation and whitened values."""
    is_hot = F.col("copies") * HOT_SHARE > total
    hot = done.where(is_hot).select("x", "deviation", "y")
    cold = done.where(~is_hot).select("x", "deviation", "y")
    few = F.broadcast(hot.select("x"))
    return (x.join(F.broadcast(hot), "x").select("vec_id", "deviation", "y").unionByName(
        x.join(few, "x", "left_anti").join(cold, "x").select("vec_id", "deviation", "y")))


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "vec_id long, component int, n long, deviation "
                                     "decimal(38,0), whitened double, explained double, "
                                     "identity_error double")
