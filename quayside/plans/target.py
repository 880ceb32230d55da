"""The keyed target table: K1-K6.

Parquet has no keyed update, so the table is an append log plus a bucketed
snapshot::

    <target>/_target/key=<key>/             marker made by ensure_target (K1)
    <target>/log/_run=<run>/                one load's rows, unique by key (K2)
    <target>/_commits/<n>.json              the n-th load that counts, and its run
    <target>/snapshot/_run=<run>/_bucket=<k>/   rows of bucket k
    <target>/_snapshots/<n>.json            live folder of each bucket as of load n
    <target>/_audit/batch-<n>.json          the load's audit record

Every write goes to a folder of its own, so loads never overwrite each other
and need no lock: a load counts from the moment its commit file exists, and
that file is created exclusively under the next free number. A load that fails
before it leaves nothing readable. The current state (K5) is the snapshot, less
the keys loaded since, plus the latest row per key of the newer loads: the last
load wins and replaces the whole row (D18).

Only buckets that hold a newer key are joined; the others are read as they
are. Compaction rewrites the same buckets alone, and writes all of them anew
with twice as many (or more) once the table has outgrown their number, so a
bucket stays near ``BUCKET_TARGET_BYTES`` whatever the table grows to, and each
byte is moved a bounded number of times by it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.hashing import quoted
from quayside.operators.columns import KEY
from quayside.operators.quality import dedup
from quayside.plans import files

# Partition columns of the log and the snapshot, and the order of loads: names
# that no loaded column may take.
RUN = "_run"
BATCH = "_batch"
BUCKET = "_bucket"
RESERVED = (RUN, BATCH, BUCKET)
# Snapshot buckets: about this many bytes each, a power of two.
BUCKET_TARGET_BYTES = 1 << 30
MAX_BUCKETS = 1 << 16
BLOOM_BYTES = 1 << 20


def _p(target: str, *parts: str) -> str:
    return "/".join([target.rstrip("/"), *parts])


class KeyMismatchError(ValueError):
    """The table is keyed by another column."""


def ensure_target(spark: SparkSession, target: str, key: str = KEY) -> bool:
    """K1: create the table keyed by ``key`` if absent; keep it if present.

    Returns true when it was created. A table made with another key is refused.
    """
    marker = _p(target, "_target")
    names = [n for n in files.child_dirs(spark, marker) if n.startswith("key=")]
    if names and f"key={key}" not in names:
        raise KeyMismatchError(f"{target} is keyed by {names[0][4:]!r}, not {key!r}")
    if names:
        return False
    files.mkdirs(spark, _p(marker, f"key={key}"))
    return True


def drop_target(spark: SparkSession, target: str) -> bool:
    """K4: delete the table if it exists; no error when it does not."""
    return files.delete(spark, target)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = (n[:-5] for n in files.child_files(spark, folder) if n.endswith(".json"))
    return sorted(int(n) for n in names if n.isdigit())


def _record(spark: SparkSession, path: str) -> dict:
    """A control record; empty where its writer died before filling it."""
    text = files.read_text(spark, path)
    return json.loads(text) if text else {}


def commits(spark: SparkSession, target: str, after: int = 0) -> list[tuple[int, dict]]:
    """Number and record of the loads after ``after``, in order."""
    folder = _p(target, "_commits")
    return [(n, _record(spark, _p(folder, f"{n}.json")))
            for n in _numbers(spark, folder) if n > after]


def batch_ids(spark: SparkSession, target: str, after: int = 0) -> list[int]:
    """Numbers of the loads that hold rows."""
    return [n for n, r in commits(spark, target, after) if r.get("rows")]


def new_run() -> str:
    return "r" + uuid.uuid4().hex


def commit(spark: SparkSession, target: str, run: str, rows: bool = True) -> int:
    """Make a run count: its record is created under the next free number."""
    folder = _p(target, "_commits")
    n = max(_numbers(spark, folder), default=0) + 1
    text = json.dumps({"run": run, "rows": rows})
    while not files.create_text(spark, _p(folder, f"{n}.json"), text):
        n += 1
    return n


def _label_path(target: str, label: str) -> str:
    import hashlib
    return _p(target, "_labels", hashlib.sha1(label.encode("utf-8")).hexdigest() + ".json")


def start_label(spark: SparkSession, target: str, label: str, run: str) -> None:
    """Note, before it writes, which run is about to load ``label``."""
    last = max(_numbers(spark, _p(target, "_commits")), default=0)
    files.mkdirs(spark, _p(target, "_labels"))
    files.write_text(spark, _label_path(target, label), json.dumps({"run": run, "after": last}))


def already_loaded(spark: SparkSession, target: str, label: str) -> bool:
    """True when the run that last began ``label`` was committed: an epoch
    replayed after a restart is then done, wherever the driver died."""
    path = _label_path(target, label)
    if not files.exists(spark, path):
        return False
    begun = _record(spark, path)
    return bool(begun) and any(r.get("run") == begun["run"]
                               for _n, r in commits(spark, target, begun["after"]))


def write_run(df: DataFrame, target: str, run: str, key: str = KEY,
              write_partitions: int | None = None) -> str:
    """Write one load, unique by ``key``, to its own folder; it doesn't count yet.

    ``write_partitions`` bounds the number of parallel write tasks (and files)
    by a shuffle on the key after the load's own stages, which keep their
    parallelism; by default AQE sizes them.
    """
    if key not in df.columns:
        raise ValueError(f"frame has no key column {key!r}")
    taken = [c for c in df.columns if c in RESERVED]
    if taken:
        raise ValueError(f"columns {taken} are reserved for the table layout")
    path = _p(target, "log", f"{RUN}={run}")
    out = df.repartition(write_partitions, quoted(key)) if write_partitions else df
    out.write.parquet(path)
    return path


def upsert(df: DataFrame, target: str, key: str = KEY,
           write_partitions: int | None = None) -> int:
    """K2 (+K3): write one load and make it count; returns its number."""
    run = new_run()
    write_run(df, target, run, key, write_partitions)
    return commit(df.sparkSession, target, run)


def drop_run(spark: SparkSession, target: str, run: str) -> bool:
    """Remove what a failed load has written."""
    return files.delete(spark, _p(target, "log", f"{RUN}={run}"))


def _manifest(spark: SparkSession, target: str) -> dict | None:
    """The last snapshot: ``version``, ``buckets``, and ``live``, the run and
    bytes of each bucket (at most ``MAX_BUCKETS`` entries)."""
    folder = _p(target, "_snapshots")
    for n in reversed(_numbers(spark, folder)):
        record = _record(spark, _p(folder, f"{n}.json"))
        if record:
            return record | {"live": {int(b): x for b, x in record["live"].items()}}
    return None


def snapshot_version(spark: SparkSession, target: str) -> int | None:
    manifest = _manifest(spark, target)
    return manifest["version"] if manifest else None


def _snapshot(spark: SparkSession, target: str, manifest: dict | None,
              buckets) -> DataFrame | None:
    """The live folders of some buckets, read as one frame."""
    base = _p(target, "snapshot")
    live = manifest["live"] if manifest else {}
    paths = [f"{base}/{RUN}={live[b][0]}/{BUCKET}={b}" for b in sorted(buckets) if b in live]
    if not paths:
        return None
    return (spark.read.option("basePath", base).option("mergeSchema", True)
            .parquet(*paths).drop(RUN, BUCKET))


def _runs(spark: SparkSession, target: str, after: int) -> list[tuple[int, str]]:
    return [(n, r["run"]) for n, r in commits(spark, target, after) if r.get("rows")]


def _log(spark: SparkSession, target: str, runs) -> DataFrame:
    """The rows of some loads, with each one's number; no other folder is
    listed or read."""
    base = _p(target, "log")
    rows = (spark.read.option("basePath", base).option("mergeSchema", True)
            .parquet(*[f"{base}/{RUN}={run}" for _n, run in runs]))
    number = F.create_map(*[F.lit(x) for n, run in runs for x in (run, n)])
    return rows.withColumn(BATCH, number[F.col(RUN)]).drop(RUN)


def _latest(spark: SparkSession, target: str, runs, key: str, only=None) -> DataFrame:
    """Latest row per key over some loads; ``only`` filters their rows by key."""
    rows = _log(spark, target, runs)
    rows = only(rows) if only else rows
    if len(runs) == 1:  # unique by key already: no aggregate, no shuffle
        return rows.drop(BATCH)
    return dedup(rows, [key], order_by=[BATCH]).drop(BATCH)


def _touched(spark: SparkSession, target: str, runs, key: str, buckets: int) -> list[int]:
    """Buckets that hold a key of these loads; only the key column is read."""
    keys = _log(spark, target, runs).select(bucket_of(quoted(key), buckets).alias(BUCKET))
    return sorted(int(r[0]) for r in keys.distinct().collect())


def _replace_keys(old: DataFrame | None, latest: DataFrame, key: str) -> DataFrame:
    if old is None:
        return latest
    kept = old.join(latest.select(quoted(key).alias(key)), on=key, how="left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def current(spark: SparkSession, target: str, key: str = KEY) -> DataFrame:
    """K5: one row per key, the one of the latest load. Buckets without a newer
    key are passed through; only the others meet the newer keys."""
    manifest = _manifest(spark, target)
    live = set(manifest["live"]) if manifest else set()
    runs = _runs(spark, target, manifest["version"] if manifest else 0)
    if not runs:
        snap = _snapshot(spark, target, manifest, live)
        return snap if snap is not None else spark.createDataFrame([], f"`{key}` string")
    touched = live
    if len(live) > 1:
        touched = live & set(_touched(spark, target, runs, key, manifest["buckets"]))
    changed = _replace_keys(_snapshot(spark, target, manifest, touched),
                            _latest(spark, target, runs, key), key)
    same = _snapshot(spark, target, manifest, live - touched)
    return changed if same is None else same.unionByName(changed, allowMissingColumns=True)


def read_keys(spark: SparkSession, target: str, keys: DataFrame | Sequence[str],
              key: str = KEY) -> DataFrame:
    """K5 for some keys: their rows of :func:`current`, from the buckets that hold them.

    ``keys`` is a list, or a frame with the key column of any size. Only the folders of
    the keys' buckets are read, and of their files only row groups whose Bloom filter
    or range admits a key: a list is a pushed-down predicate, and from a frame Spark
    makes one where it's small. Keys that the table doesn't hold give no row.
    """
    if isinstance(keys, DataFrame):
        asked = keys.select(quoted(key).cast("string").alias(key)).where(
            quoted(key).isNotNull()).distinct()

        def only(df):
            return df.join(asked, key, "left_semi")
    else:
        listed = sorted({str(k) for k in keys if k is not None})
        asked = spark.createDataFrame([(k,) for k in listed], f"`{key}` string")

        def only(df):
            return df.where(quoted(key).isin(listed))

    manifest = _manifest(spark, target)
    runs = _runs(spark, target, manifest["version"] if manifest else 0)
    live = set(manifest["live"]) if manifest else set()
    if len(live) > 1:
        at = bucket_of(quoted(key), manifest["buckets"]).alias(BUCKET)
        live &= {int(r[0]) for r in asked.select(at).distinct().collect()}
    old = _snapshot(spark, target, manifest, live)
    old = old if old is None else only(old)
    if runs:
        return _replace_keys(old, _latest(spark, target, runs, key, only), key)
    if old is not None:
        return old
    some = _snapshot(spark, target, manifest, list(manifest["live"])[:1]) if manifest else None
    empty = some if some is not None else spark.createDataFrame([], f"`{key}` string")
    return empty.where(F.lit(False))


def choose_buckets(table_bytes: int) -> int:
    """Buckets for a table of ``table_bytes``: about 1 GB each, a power of
    two, so that a compaction rewrites little when few keys change."""
    buckets = 1
    while buckets < MAX_BUCKETS and buckets * BUCKET_TARGET_BYTES < table_bytes:
        buckets *= 2
    return buckets


def bucket_of(key_col, buckets: int):
    """The snapshot bucket of a key: a stable hash, modulo ``buckets``."""
    return F.pmod(F.xxhash64(key_col), F.lit(buckets)).cast("int")


def compact(spark: SparkSession, target: str, key: str = KEY,
            buckets: int | None = None) -> int | None:
    """Fold the loads since the snapshot into it.

    Only buckets that hold a key loaded since are rewritten, unless the table
    has outgrown their number (or ``buckets`` asks for another): then all are.
    Returns the new snapshot's version (the last load folded in), or None when
    nothing was loaded. Of two compactions at once the first to finish counts.
    """
    manifest = _manifest(spark, target)
    runs = _runs(spark, target, manifest["version"] if manifest else 0)
    if not runs:
        return manifest["version"] if manifest else None
    version, live = runs[-1][0], dict(manifest["live"]) if manifest else {}
    size = sum(x[1] for x in live.values()) + sum(
        files.size_of(spark, _p(target, "log", f"{RUN}={run}")) for _n, run in runs)
    had = manifest["buckets"] if manifest else None
    count = buckets or max(had or 1, choose_buckets(size))
    touched = list(live) if count != had else _touched(spark, target, runs, key, count)
    merged = _replace_keys(_snapshot(spark, target, manifest, touched),
                           _latest(spark, target, runs, key), key)
    # rebalance: AQE splits a large bucket over several tasks and merges small
    # ones, so files come out near the advisory size whatever the bucket size.
    # With one bucket there is nothing to gather: each task writes its own file.
    out = merged.withColumn(BUCKET, bucket_of(quoted(key), count))
    if count > 1:
        out = out.hint("rebalance", BUCKET)
    run = new_run()
    folder = _p(target, "snapshot", f"{RUN}={run}")
    # Bloom filters on the key let reads by key pass over row groups; each takes a small
    # share of its bucket's bytes.
    share = min(BLOOM_BYTES, max(1 << 10, size // count // 16))
    (out.write.partitionBy(BUCKET).option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true")
     .option("parquet.bloom.filter.max.bytes", share).parquet(folder))
    if count != had:
        live = {}
    for b in files.partition_values(spark, folder, BUCKET):
        live[b] = [run, files.size_of(spark, _p(folder, f"{BUCKET}={b}"))]
    record = {"version": version, "buckets": count, "live": live}
    if not files.create_text(spark, _p(target, "_snapshots", f"{version}.json"),
                             json.dumps(record)):
        files.delete(spark, folder)  # another compaction of the same loads was first
    return version


def compact_if_due(spark: SparkSession, target: str, every: int, key: str = KEY) -> int | None:
    """Compact once ``every`` loads have been made since the snapshot, so reads
    never aggregate more than about that many."""
    if len(_runs(spark, target, snapshot_version(spark, target) or 0)) >= every:
        return compact(spark, target, key)
    return None


def merge_schemas(frames: Sequence[DataFrame]) -> DataFrame:
    """K6: stack frames with different columns by name; absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def to_items(df: DataFrame, key: str = KEY, attrs: str = "attrs") -> DataFrame:
    """K6: ``(key, attrs map<string,string>)``; null attributes left out,
    as an item store keeps no attribute for them."""
    names = [c for c in df.columns if c != key]
    m = F.map_from_arrays(F.array(*[F.lit(c) for c in names]),
                          F.array(*[quoted(c).cast("string") for c in names]))
    return df.select(quoted(key).alias(key),
                     F.map_filter(m, lambda _k, v: v.isNotNull()).alias(attrs))


def items_long(df: DataFrame, key: str = KEY) -> DataFrame:
    """K6: one row per (key, attribute, value) of the items."""
    items = to_items(df, key, "_attrs")
    return items.select(key, F.explode("_attrs").alias("attribute", "value"))
