"""Exact dedup over immutable snapshots screened by binary-fuse filters.

Method. Each batch of documents becomes an immutable snapshot: its equal texts are
grouped by the texts themselves (new-batch duplicates; copies are combined in the
map tasks, so a text that a third of all rows share sends one row a task), and a
static binary-fuse filter is built over the digests of each bucket. The digests of
one snapshot are screened by the filters of the others. Digests that pass lead to
the exact buckets: there the whole texts of both sides are compared, which removes
the filters' false positives and tells texts of one digest apart. All other texts
are alone in their snapshot and move no further.

At scale. Texts are shuffled once, and those that pass a filter once more. Screening
moves 8-byte keys: a task holds one bucket's filter (about ``BUCKET_KEYS`` keys) and
as many probes; a batch larger than the snapshot is cut into slices. The digests that
passed are broadcast only where their counted bytes are below ``BROADCAST_BYTES``,
joined by a shuffle beyond. Of the final classes those with more than one in
``HOT_SHARE`` of all rows (so at most ``HOT_SHARE``) are broadcast to the rows; the
rest go through a shuffle in which no key has a larger share.

Defined results. Null text is the empty text; a text of white space alone is one space.
``keep_id`` is the smallest id of the equal texts, null ids last: a row without an id
stays only where no equal text has one. Rows that repeat both id and text are one
document and share the verdict. Texts of any length are compared whole. An empty table
gives no rows. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import fuse_filter
from quayside.llm.frames import written

# Fixed value: the white space that counts as equal.
WHITE = r"[\x20\x09-\x0D]+"
# Keys of a bucket: bounds what a screening task holds; no result depends on it.
BUCKET_KEYS = 60_000
BROADCAST_BYTES = 16 * 1024 * 1024
HOT_SHARE = 1024
_DIGEST_BYTES = 64  # a digest and its row overhead, counted generously


def normalised(text: Column) -> Column:
    """White space runs as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass(frozen=True)
class Snapshot:
    """A batch that no longer changes: ``texts`` (digest, body, first, copies), each
    text once, and ``filters`` (bucket, filter) over ``buckets`` buckets."""
    texts: DataFrame
    filters: DataFrame
    rows: int
    buckets: int


def _bucketed(texts: DataFrame, buckets: int) -> DataFrame:
    key = F.xxhash64("digest")
    return texts.select(F.pmod(key, F.lit(buckets)).cast("int").alias("bucket"), key.alias("key"))


def snapshot(docs: DataFrame, digest: Callable[[Column], Column] = digest_of,
             bucket_keys: int = BUCKET_KEYS) -> Snapshot:
    """Group a batch's equal texts and build its filters; both are written under the
    shared checkpoint folder and only read from then on."""
    grouped = (docs.select(F.col("doc_id"), normalised(F.col("text")).alias("body"))
               .groupBy("body").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")))
    texts = written(grouped.select(digest(F.col("body")).alias("digest"), "body", "first",
                                   "copies"), "exact-texts")
    rows = texts.count()
    buckets = max(1, -(-rows // bucket_keys))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1],
                             "filter": [fuse_filter.build(group["key"].to_numpy())]})

    filters = _bucketed(texts, buckets).groupBy("bucket").applyInPandas(
        build, "bucket int, filter binary")
    return Snapshot(texts, written(filters, "exact-filters"), rows, buckets)


def screen(batch: Snapshot, against: Snapshot, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Keys (``xxhash64`` of the digest) of ``batch`` that may be in ``against``: all
    that are, and about one in 256 of the others."""
    slices = max(1, -(-batch.rows // (against.buckets * bucket_keys)))
    part = F.pmod(F.shiftright("key", 40), F.lit(slices)).cast("int").alias("slice")
    probes = _bucketed(batch.texts, against.buckets).select("bucket", part, "key")
    filters = against.filters.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "filter")

    def test(probes: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        keys = probes["key"].to_numpy(np.int64)
        found = np.zeros(len(keys), bool)
        for f in filters["filter"]:
            found |= fuse_filter.passes(bytes(f), keys)
        return pd.DataFrame({"key": keys[found]})

    return (probes.groupBy("bucket", "slice").cogroup(filters.groupBy("bucket", "slice"))
            .applyInPandas(test, "key long"))


def _semi(texts: DataFrame, keys: DataFrame, small: bool, how: str = "left_semi") -> DataFrame:
    """Texts whose digest's key is (not) among ``keys``; broadcast where they are few."""
    other = F.broadcast(keys) if small else keys
    return texts.join(other, F.xxhash64(texts["digest"]) == other["key"], how)


def classes(snapshots: Sequence[Snapshot], bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Every distinct text of the snapshots: ``digest, first, copies, hidden``, where
    ``hidden`` is null unless another text has the same digest; then it is the text."""
    parts = []
    for i, one in enumerate(snapshots):
        others = [screen(one, other, bucket_keys) for j, other in enumerate(snapshots) if j != i]
        if not others:
            parts.append((one.texts, None))
            continue
        hits = written(reduce(DataFrame.union, others).distinct(), "exact-hits")
        small = hits.count() * _DIGEST_BYTES <= BROADCAST_BYTES
        parts.append((_semi(one.texts, hits, small),
                      _semi(one.texts.drop("body"), hits, small, "left_anti")))
    # Exact buckets: equal digests meet, and the whole texts are compared.
    met = (reduce(DataFrame.unionByName, [hit for hit, _ in parts])
           .groupBy("digest", "body").agg(F.min("first").alias("first"),
                                          F.sum("copies").alias("copies")))
    met = written(met, "exact-met")
    alone = [miss for _, miss in parts if miss is not None]
    every = reduce(DataFrame.unionByName, [met.drop("body"), *alone])
    # Digests of several texts are known by their texts as well.
    doubled = written(every.groupBy("digest").agg(F.count("*").alias("texts"))
                      .where("texts > 1").select("digest"), "exact-doubled")
    if doubled.isEmpty():
        return every.withColumn("hidden", F.lit(None).cast("string"))
    texts = reduce(DataFrame.unionByName, [s.texts for s in snapshots])
    apart = (texts.join(doubled, "digest", "left_semi").groupBy("digest", "body")
             .agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
             .select("digest", "first", "copies", F.col("body").alias("hidden")))
    return every.join(doubled, "digest", "left_anti").withColumn(
        "hidden", F.lit(None).cast("string")).unionByName(apart)


def _attach(rows: DataFrame, found: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with ``first`` and ``copies`` of their class where it has one. Classes
    with a large share of all rows are broadcast, so no shuffled key has one."""
    is_hot = F.col("copies") * HOT_SHARE > total
    hot = found.where(is_hot).select(*keys, F.col("first").alias("hot_first"),
                                     F.col("copies").alias("hot_copies"))
    cold = found.where(~is_hot).select(*[F.col(k).alias(f"cold_{k}") for k in keys], "first",
                                       "copies")
    met = rows.join(F.broadcast(hot), keys, "left")
    # Rows already met keep out of the next join's keys, spread by their place.
    spread = F.to_binary(F.monotonically_increasing_id().cast("string"), F.lit("utf-8"))
    met = met.withColumn("meet", F.when(F.col("hot_copies").isNull(), F.col(keys[0]))
                         .otherwise(spread))
    on = F.col("meet") == F.col(f"cold_{keys[0]}")
    for k in keys[1:]:
        on = on & (F.col(k) == F.col(f"cold_{k}"))
    joined = met.join(cold, on, "left")
    return joined.select("doc_id", "digest", F.coalesce("hot_copies", "copies").alias("copies"),
                         F.when(F.col("hot_copies").isNull(), F.col("first"))
                         .otherwise(F.col("hot_first")).alias("first"))


def deduplicate(batches: Sequence[DataFrame], digest: Callable[[Column], Column] = digest_of,
                bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per row of the batches (``doc_id``, ``text``): ``doc_id, keep_id,
    group_size, kept, digest``. The first batches are the older snapshots; the order
    changes no result. ``digest`` may be any binary hash of a text: equal digests of
    different texts are told apart."""
    snapshots = [snapshot(b, digest, bucket_keys) for b in batches]
    every = written(classes(snapshots, bucket_keys), "exact-classes")
    sums = every.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count("hidden")).first()
    total, hidden = int(sums[0]), int(sums[1])
    body = normalised(F.col("text"))
    rows = reduce(DataFrame.union, [b.select("doc_id", digest(body).alias("digest"),
                                             body.alias("hidden")) for b in batches])
    repeated = every.where("copies > 1")
    plain = _attach(rows.drop("hidden"), repeated.where("hidden IS NULL").drop("hidden"),
                    ["digest"], total)
    if hidden:
        doubled = every.where("hidden IS NOT NULL").select("digest").distinct()
        apart = _attach(rows.join(doubled, "digest", "left_semi"),
                        every.where("hidden IS NOT NULL"), ["digest", "hidden"], total)
        plain = _attach(rows.drop("hidden").join(doubled, "digest", "left_anti"),
                        repeated.where("hidden IS NULL").drop("hidden"), ["digest"],
                        total).unionByName(apart)
    several = F.coalesce("copies", F.lit(1)) > 1
    keep = F.when(several, F.col("first")).otherwise(F.col("doc_id"))
    return plain.select("doc_id", keep.alias("keep_id"),
                        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), "digest")


def halves(docs: DataFrame) -> list[DataFrame]:
    """The documents up to the middle id, and the later ones with those without an id."""
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    older = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    return [docs.where(older), docs.where(~older)]
