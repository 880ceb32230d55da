"""Blocked Bloom filters of 64-bit hashes.

A hash names one block of ``WORDS`` 32-bit words and one bit in each, so a test
touches one block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 8
BLOCK_BYTES = 4 * WORDS
ROW_BLOCKS = 2048
# One odd multiplier for each word of a block, unrelated to each other.
SALTS = np.random.default_rng(20).integers(0, 2 ** 63, WORDS, dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)


def places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    h = hashes.astype(np.int64).view(np.uint64)
    block = (h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    bits = (h[:, None] * SALTS) >> np.uint64(59)
    return block.astype(np.int64), np.uint32(1) << bits.astype(np.uint32)


def build_filter(hashes, keys: int, bits_per_key: int, max_bytes: int) -> np.ndarray:
    """``hashes`` yields arrays of 64-bit hashes of the listed keys."""
    blocks = max(1, min(max_bytes, keys * bits_per_key // 8) // BLOCK_BYTES)
    table = np.zeros((blocks, WORDS), dtype=np.uint32)
    for part in hashes:
        block, bits = places(part, blocks)
        for word in range(WORDS):
            np.bitwise_or.at(table[:, word], block, bits[:, word])
    return table


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    block, bits = places(hashes, len(table))
    return ((table[block] & bits) == bits).all(axis=1)


def key_filter(keys: DataFrame, count: int, *, bits: int = 16, most: int) -> np.ndarray:
    """A filter of the ``count`` values of a ``key`` column, built in Spark by
    rows of ``ROW_BLOCKS`` blocks and gathered; never over ``most`` bytes."""
    blocks = max(1, min(most, count * bits // 8) // BLOCK_BYTES)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        block, bit = places(rows["key"].to_numpy(), blocks)
        row = int(block[0]) // ROW_BLOCKS
        table = np.zeros((ROW_BLOCKS, WORDS), dtype=np.uint32)
        for word in range(WORDS):
            np.bitwise_or.at(table[:, word], block - row * ROW_BLOCKS, bit[:, word])
        return pd.DataFrame({"row": [row], "table": [table.tobytes()]})

    rows = -(-blocks // ROW_BLOCKS)

    @F.pandas_udf("long")
    def row_of(key: pd.Series) -> pd.Series:
        return pd.Series(places(key.to_numpy(), blocks)[0] // ROW_BLOCKS)

    out = np.zeros((rows * ROW_BLOCKS, WORDS), dtype=np.uint32)
    for r in (keys.select("key").distinct().groupBy(row_of("key").alias("row"))
              .applyInPandas(build, "row long, table binary").toLocalIterator()):
        at = r["row"] * ROW_BLOCKS
        out[at:at + ROW_BLOCKS] = np.frombuffer(r["table"], dtype=np.uint32).reshape(-1, WORDS)
    return out[:blocks]
