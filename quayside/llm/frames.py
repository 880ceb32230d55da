"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, label)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_slices(rows: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Cut the incoming Arrow batches into frames of at most ``rows`` rows, so
    that what a worker holds doesn't follow the batch size."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                yield batch.iloc[at:at + rows]
    return cut


def hand_back(collect: bool = True) -> None:
    """Give memory that a worker has freed back to the system: Spark keeps workers for
    later stages, and what their allocators hold on to counts against the executor.
    Without ``collect`` (after each of many groups) only what is free already."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: its allocator decides


#: By operator: what its tasks keep in a worker for the next ones.
KEPT: dict[str, dict] = {}


def kept_by(operator: str) -> dict:
    return KEPT.setdefault(operator, {})


def let_go(but: str = "") -> None:
    """Drop what a worker's earlier tasks kept, except those of the operator ``but``."""
    for other in KEPT.keys() - {but}:
        del KEPT[other]


def handing_back(run: Callable[[Iterator], Iterator], operator: str = ""
                 ) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, with ``hand_back`` after the last. What other
    operators than ``operator`` kept in the worker goes before the first."""
    def task(batches: Iterator) -> Iterator:
        let_go(operator)
        try:
            yield from run(batches)
        finally:
            hand_back()
    return task


def ascii_lower(col):
    """Lower-case A-Z alone; other letters stay as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
