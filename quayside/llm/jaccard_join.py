"""Components of documents whose word n-gram sets overlap enough.

Method. The join is a product of the sparse matrix of documents by n-grams with
its transpose, of which only entries that can reach the threshold are formed:

* A row's n-grams are ordered from rare to frequent. A pair above the threshold
  must share ``SHARED`` of the first ``size - needed + SHARED`` of either row (all it
  needs, if that is less), so only these columns open pairs, and a pair that meets in
  fewer of them is dropped; frequent n-grams come last and open none.
* Sizes bound the overlap: a pair whose smaller set is below the threshold's
  share of the larger is dropped unseen.
* Pairs left are multiplied in blocks of pairs, and each pair in blocks of
  columns whose counts are accumulated; it is dropped as soon as the columns to
  come cannot lift its count to the size-derived minimum.

Counts are exact, on 64-bit n-gram hashes. Only the order rests on a sketch of
the n-grams' frequency (``2 ** sketch_bits`` one-byte cells over all documents,
the one thing that is broadcast): any order gives the same links.

At scale. Equal sets are one class, found by one aggregate. Within a column the
documents are linked as stars, first within a batch, then across batches, so a
column held by a third of all documents sends one row per batch to its task and
makes as many pairs as documents. After the links of all stars are joined into
components, only pairs of documents that share a column, still lie in different
components and have room for the overlap from that column on are multiplied: no
link between different texts is lost, and copies are never expanded into all
pairs. A star's centre is the document where its column ranks lowest, the one
with the fewest n-grams of its own. What is reread is written to the
shared folder; nothing but the sketch and a few sums reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.bloom import key_filter, may_hold
from quayside.llm.components import connected
from quayside.llm.frames import hand_back, handing_back, in_slices, written

SLICE = 256
SHARED = 2
CELL_ROWS = 64
COLUMN_BLOCK = 2048
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[4]
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of a text's n-grams of ASCII-lower-cased words; a
    text with fewer words has the whole sequence as its one n-gram."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(n, len(words))
    acc = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        acc = acc * _ODD[0] + _mixed(h[k:len(words) - size + 1 + k] + _ODD[1])
    return np.unique(_mixed(acc))


def needed(size: int, percent: int) -> int:
    """The least overlap with any partner: ``percent`` of the own size."""
    return -(-percent * size // 100)


def leading(grams: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The n-grams that open pairs: the rarest ``size - needed + SHARED``."""
    first = len(grams) - needed(len(grams), percent) + SHARED
    shift = np.uint64(64 - (len(levels).bit_length() - 1))
    order = np.lexsort((grams, levels[(grams >> shift).astype(np.int64)]))
    return grams[order[:first]]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether ``100 * overlap >= percent * union``, counted block by block."""
    both = len(a) + len(b)
    least = -(-percent * both // (100 + percent))
    if min(len(a), len(b)) < least:
        return False
    if len(a) > len(b):
        a, b = b, a
    count = 0
    for at in range(0, len(a), COLUMN_BLOCK):
        part = a[at:at + COLUMN_BLOCK]
        places = np.searchsorted(b, part)
        places[places == len(b)] = 0
        count += int((b[places] == part).sum())
        if count + len(a) - at - len(part) < least:
            return False
    return count >= least


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def frequency_levels(texts: DataFrame, n: int, sketch_bits: int) -> np.ndarray:
    """The sketch over all documents: a level that grows with the logarithm of a
    cell's count. Each task sends its counts (cut at 255) once, and they are
    added up row by row."""
    cells = 1 << sketch_bits
    width = max(1, cells // CELL_ROWS)
    shift = np.uint64(64 - sketch_bits)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, held, size = np.zeros(cells, dtype=np.uint32), [], 0
        for rows in in_slices(SLICE)(batches):
            for text in rows["text"]:
                held.append((shingles(text, n) >> shift).astype(np.int64))
                size += len(held[-1])
            if size > cells // 4:
                np.add.at(total, np.concatenate(held), 1)
                held, size = [], 0
        if held:
            np.add.at(total, np.concatenate(held), 1)
        if total.any():
            cut = np.minimum(total, 255).astype(np.uint8).reshape(-1, width)
            yield pd.DataFrame({"row": range(len(cut)), "cells": [x.tobytes() for x in cut]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, part in zip(batch["row"], batch["cells"]):
                got = np.frombuffer(part, dtype=np.uint8)
                sums[row] = sums.get(row, np.zeros(width, dtype=np.int64)) + got
        if sums:
            yield pd.DataFrame({"row": list(sums), "cells": [
                np.minimum(4 * np.log2(x + 1), 255).astype(np.uint8).tobytes()
                for x in sums.values()]})

    kind = "row int, cells binary"
    added = (texts.select("text").mapInPandas(handing_back(count), kind)
             .repartition(CELL_ROWS, "row").mapInPandas(add, kind))
    levels = np.zeros((cells // width, width), dtype=np.uint8)
    for r in added.toLocalIterator():
        levels[r["row"]] = np.frombuffer(r["cells"], dtype=np.uint8)
    return levels.ravel()


def _columns(texts: DataFrame, levels, n: int, percent: int) -> DataFrame:
    """Two kinds of rows in one pass. For each document: ``doc, n, h1, h2`` (its
    set's size and digest). For each column that it opens: ``key, doc, place``
    (the column's rank among the document's) and ``n``, and ``pivot``, the batch's
    document of lowest place in that column (``pivot_place``) where that is another
    one; ``more`` marks such a pivot. Later copies of a set in a task open no columns."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for batch in batches:
            keys, owners, places, sizes = [], [], [], []
            for rows in in_slices(SLICE)([batch]):
                base = []
                for doc, text in zip(rows["doc"], rows["text"]):
                    grams = shingles(text, n)
                    digest = xxhash.xxh3_128_digest(grams.tobytes())
                    h1, h2 = np.frombuffer(digest, dtype=np.int64)
                    base.append((doc, len(grams), h1, h2))
                    if not pd.isna(doc) and len(grams) and digest not in seen:
                        seen.add(digest)
                        keys.append(leading(grams, levels.value, percent).view(np.int64))
                        owners.append(np.full(len(keys[-1]), doc, dtype=np.int64))
                        places.append(np.arange(len(keys[-1])))
                        sizes.append(np.full(len(keys[-1]), len(grams)))
                yield pd.DataFrame(base, columns=["doc", "n", "h1", "h2"]).assign(
                    key=None, pivot=None, pivot_place=None, more=None, place=None)[_ORDER]
            if keys:
                key, doc = np.concatenate(keys), np.concatenate(owners)
                place, n_of = np.concatenate(places), np.concatenate(sizes)
                order = np.lexsort((doc, place, key))
                key, doc, place, n_of = key[order], doc[order], place[order], n_of[order]
                new = np.r_[True, key[1:] != key[:-1]]
                first, lowest = (x[new][np.cumsum(new) - 1] for x in (doc, place))
                more = np.r_[~new[1:], False]
                yield pd.DataFrame({
                    "key": key, "doc": doc, "pivot": pd.Series(first).astype("Int64").mask(new),
                    "pivot_place": pd.Series(lowest).astype("Int64").mask(new),
                    "more": more & new, "place": place, "n": n_of, "h1": None,
                    "h2": None})[_ORDER]

    return texts.mapInPandas(handing_back(run), "key long, doc long, pivot long, pivot_place int, more boolean, "
                                  "place int, n long, h1 long, h2 long")


_ORDER = ["key", "doc", "pivot", "pivot_place", "more", "place", "n", "h1", "h2"]


def _may_be_in(ids: DataFrame, count: int, most: int):
    """A test of a ``doc`` column against ``ids`` (``doc``, written) by a Bloom
    filter of at most ``most`` bytes: rows that are surely not in a join stay
    out of its shuffle."""
    bloom = ids.sparkSession.sparkContext.broadcast(
        key_filter(ids.select(F.xxhash64("doc").alias("key")), count, most=most))

    @F.pandas_udf("boolean")
    def maybe(key: pd.Series) -> pd.Series:
        return pd.Series(may_hold(bloom.value, key.to_numpy()))

    return maybe(F.xxhash64("doc"))


def _multiply(pairs: DataFrame, texts: DataFrame, n: int, percent: int, filter_bytes: int,
              block_grams: int = 2_000_000) -> DataFrame:
    """``a, b`` of the ``pairs`` (``a, na, b, nb``, written) that are linked. A
    block takes pairs by ``b``, so a document that is ``a`` in many pairs is sent
    to each block once."""
    grams, count = pairs.agg(F.coalesce(F.sum("nb"), F.lit(0)), F.count("*")).first()
    docs = pairs.select(F.col("a").alias("doc")).union(pairs.select("b"))
    texts = texts.where(_may_be_in(docs, 2 * count, filter_bytes))
    blocks = max(1, -(-2 * grams // block_grams))
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("b"), F.lit(blocks)))
    wanted = (pairs.select(F.col("block").alias("of"), F.col("a").alias("doc"))
              .union(pairs.select("block", "b")).distinct())
    members = wanted.join(texts, "doc").select("of", "doc", "text")

    def product(pairs: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        # Where rows share an id, the one text that stands for them all.
        one = members.groupby("doc")["text"].min()
        sets = {d: shingles(t, n) for d, t in one.items()}
        keep = [a in sets and b in sets and linked(sets[a], sets[b], percent)
                for a, b in zip(pairs["a"], pairs["b"])]
        del one, sets
        hand_back()
        return pairs.loc[keep, ["a", "b"]]

    return (pairs.select("block", "a", "b").groupBy("block").cogroup(members.groupBy("of"))
            .applyInPandas(product, "a long, b long"))


def components(docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id",
               text_col: str = "text", sketch_bits: int = 22,
               filter_bytes: int = 64 << 20) -> DataFrame:
    """Link documents whose sets of ``n``-word n-grams have a Jaccard similarity
    of at least ``percent`` hundredths.

    Returns ``doc_id, n_shingles, component_id`` (the smallest id reachable by
    links, itself included), one row per row of ``docs``. A null text counts as
    empty; without words a document has no n-grams and no links. A row without
    an id has no links and a null component. Repeated rows are one document and
    are returned as often as they occur; where rows share an id but not a text,
    their links are united and one text stands for both in comparisons. Other
    columns are ignored; an empty table gives an empty table."""
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    levels = spark.sparkContext.broadcast(frequency_levels(texts, n, sketch_bits))
    rows = written(_columns(texts, levels, n, percent), "jaccard-columns")
    base = rows.where(F.col("h1").isNotNull()).select("doc", "n", "h1", "h2")
    sets = (base.where((F.col("n") > 0) & F.col("doc").isNotNull())
            .groupBy("n", "h1", "h2").agg(F.min("doc").alias("rep")))
    classed = written(base.join(sets, ["n", "h1", "h2"], "left")
                      .select("doc", "n", F.coalesce("rep", "doc").alias("rep")),
                      "jaccard-classes")
    class_of = classed.where(F.col("n") > 0).groupBy("doc").agg(
        F.min(F.struct("rep", "n")).alias("c")).select("doc", "c.rep", "c.n")

    by_key = Window.partitionBy("key").orderBy("place", "doc")
    columns = rows.where(F.col("key").isNotNull())
    so_far = by_key.rowsBetween(Window.unboundedPreceding, 0)
    firsts = (columns.where(F.col("pivot").isNull())
              .select("key", "doc", "more", "place", F.first("doc").over(so_far).alias("pivot"),
                      F.first("place").over(so_far).alias("pivot_place"),
                      F.lead("doc").over(by_key).alias("next"))
              .where(F.col("more") | F.col("next").isNotNull() | (F.col("pivot") != F.col("doc")))
              .select("key", "doc", "pivot", "place", "pivot_place"))
    shared = written(firsts.union(columns.where(F.col("pivot").isNotNull()).select(
        "key", "doc", "pivot", "place", "pivot_place")), "jaccard-shared")
    bound = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    least = percent * (F.col("na") + F.col("nb"))
    # In the first column that a linked pair shares either set has room for the needed
    # overlap from that place on, and in the SHARED-th for all of it but SHARED - 1.
    room, rest = (((100 + percent) * (F.col("na") - F.col("pa") + spare) >= least)
                  & ((100 + percent) * (F.col("nb") - F.col("pb") + spare) >= least)
                  for spare in (0, SHARED - 1))
    # Columns that a pair must meet in: as many as it needs in common, SHARED at most.
    meets = (F.col("columns") >= SHARED) | ((100 + percent) * F.col("columns") >= least)
    one, two = (class_of.select(F.col("doc").alias(d), F.col("rep").alias(r), F.col("n").alias(m))
                for d, r, m in (("pivot", "a", "na"), ("doc", "b", "nb")))

    def pairs_of(met: DataFrame) -> DataFrame:
        """The pairs ``a < b`` that may be linked, of rows for each column they share."""
        swap = F.col("a") > F.col("b")
        return (met.where(bound).where(rest).groupBy(F.least("a", "b").alias("a"),
                                         F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
                                         F.greatest("a", "b").alias("b"),
                                         F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb"))
                .agg(F.count_distinct("key").alias("columns"), F.max(room).alias("room"))
                .where(F.col("room") & meets).select("a", "na", "b", "nb"))

    stars = (shared.where(F.col("pivot") != F.col("doc"))
             .select("key", "pivot", F.col("pivot_place").alias("pa"), "doc",
                     F.col("place").alias("pb"))
             .join(one, "pivot").join(two, "doc").where(F.col("a") != F.col("b")))
    stars = written(pairs_of(stars), "jaccard-stars")
    links = written(_multiply(stars, texts, n, percent, filter_bytes), "jaccard-links")
    found = connected(links, "jaccard-components")

    # Columns whose documents the stars have not joined into one component.
    members = (shared.select("key", "doc", "place").join(class_of, "doc")
               .join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
               .select("key", "rep", "n", "place",
                       F.coalesce("component", "rep").alias("component")))
    members = written(members.distinct(), "jaccard-members")
    split = (members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
             .where(F.col("x") != F.col("y")).select("key", "x"))
    apart = members.join(split, "key")
    one, two = (apart.select("key", "x", F.col("rep").alias(r), F.col("n").alias(m),
                             F.col("place").alias(p), F.col("component").alias(c))
                for r, m, p, c in (("a", "na", "pa", "ca"), ("b", "nb", "pb", "cb")))
    # The column's first component, most often the large one, is on one side alone.
    once = (F.col("cb") == F.col("x")) | (F.col("a") < F.col("b"))
    crossing = pairs_of(one.where(F.col("ca") != F.col("x")).join(two.drop("x"), "key")
                        .where((F.col("ca") != F.col("cb")) & once))
    tried = stars.select("a", "b")
    crossing = written(crossing.join(tried, ["a", "b"], "left_anti"), "jaccard-crossing")
    if not crossing.isEmpty():
        more = _multiply(crossing, texts, n, percent, filter_bytes)
        links = written(links.union(more), "jaccard-links")
        found = connected(links, "jaccard-components")
    return (classed.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
            .select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "rep").alias("component_id")))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                filter_bytes: int = 64 << 20, **how) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; rows
    without an id all stay. Rows that share this id but not a text all stay too, as
    only equal rows are copies of each other. A null text counts as empty, texts of any
    length are compared whole, and an empty table stays empty. Only rows whose id may be one to drop (a Bloom filter
    of at most ``filter_bytes`` tells) are shuffled to the exact check."""
    found = components(docs, id_col=id_col, text_col=text_col, filter_bytes=filter_bytes, **how)
    kind = (found.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("doc"))
            .agg(F.min("component_id").alias("_least"), F.count("*").alias("_rows"))
            .where((F.col("_least") != F.col("doc")) | (F.col("_rows") > 1)))
    kind = written(kind, "jaccard-later")
    maybe = _may_be_in(kind, kind.count(), filter_bytes)
    kind = kind.withColumnRenamed("doc", "_doc")
    doc = F.col(id_col).cast("long")
    own = docs.columns
    flagged = docs.select(F.struct(*own).alias("_row"), doc.alias("doc")).select(
        "_row", F.col("doc").alias("_doc"), (F.col("doc").isNotNull() & maybe).alias("_maybe"))
    checked = (flagged.where("_maybe").join(kind, "_doc", "left")
               .where(F.coalesce("_least", "_doc") == F.col("_doc"))
               .withColumn("_text", F.sha2(F.coalesce(
                   F.col("_row").getField(text_col).cast("string"), F.lit("")), 256))
               .dropDuplicates(["_doc", "_text"]))
    return checked.select("_row.*").union(flagged.where(~F.col("_maybe")).select("_row.*"))
