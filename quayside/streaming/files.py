"""Arrival-driven loads: S4 (discovery), P2 (load per micro-batch), P5.

New files are found by a Structured Streaming file source over the raw
zone. The source is the binary-file format with only ``path`` and ``length``
selected, so discovery never reads file contents; the streaming checkpoint
remembers which files were seen, so a restart neither loses nor repeats a
file. Each micro-batch is one load (``foreachBatch``): its files are read per
header, and key, row hash and required columns follow each file's own header,
as in a load of its own. Of rows with one key the one that arrived last stays,
however many files share a micro-batch. ``source_file`` records each row's own
file; a header that can't be loaded is a ``FAILED`` record of its files alone.

Overlap (P5): one query per checkpoint; files that arrive while a batch
runs wait for the next micro-batch instead of being refused, and loads of other
queries may run at the same time.

A path overwritten in place is not seen again by the file source (D17);
:mod:`quayside.streaming.notifications` loads on every notification instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.functions.paths import CSV_GLOB, plain_path
from quayside.plans import target as tgt
from quayside.plans.load import (LoadConfig, LoadResult, counts_files, load_frame, loadable,
                                 refuse, scan)
from quayside.plans.quarantine import is_read_error, unreadable
from quayside.plans.target import already_loaded
from quayside.sources.csv import FILE_COLUMN
from quayside.streaming.progress import LiveCounts, observe_arrivals

# Fixed value: the binary-file source's schema.
BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
# Files per micro-batch by default: bounds the paths a batch brings to the
# driver; a backlog drains over several batches.
DEFAULT_MAX_FILES_PER_TRIGGER = 10_000


def stream_new_files(spark: SparkSession, raw_dir: str, glob: str = CSV_GLOB,
                     max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER
                     ) -> DataFrame:
    """A stream of ``(path, length, modificationTime)`` for each new
    CSV file anywhere under ``raw_dir`` (suffix matched without case)."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
              .option("pathGlobFilter", glob)
              .option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(raw_dir).select("path", "length", "modificationTime")


def load_files(spark: SparkSession, paths: list[str], config: LoadConfig,
               root: str | None, label: str, missing: list[str] = (),
               sizes: dict[str, int] | None = None) -> LoadResult | None:
    """One load over a set of files that may differ in header, with an audit row for
    each of them. Notified files that were gone (``missing``), files that can't be read
    and headers that can't be loaded leave a ``FAILED`` record each and don't stop the
    others. The label is noted even where nothing could be loaded, so that a replay
    doesn't refuse the same files again."""
    def stop(p, why):
        refuse(spark, config, p, why, _key(p, root) if root else None)

    for p in missing:
        stop(p, "notified file is missing")
    result, paths, refused = None, sorted(paths), len(missing)
    while paths and result is None:
        try:
            frames, group = [], []
            for df, some in scan(spark, paths, config, sizes):
                why = loadable(df, config)
                if why is None:
                    frames.append(df)
                    group += some
                else:
                    paths = [p for p in paths if p not in set(some)]
                    refused += len(some)
                for p in some if why else ():
                    stop(p, why)
            if not frames:
                if not refused and root and counts_files(config):
                    frames = [spark.createDataFrame([], f"{FILE_COLUMN} string")]
                else:
                    break
            note = f"{len(missing)} notified file(s) missing" if missing else None
            arrived = [_key(p, root) for p in paths] if root and counts_files(config) else None
            result = load_frame(spark, frames, config, label, root=root, note=note, once=True,
                                source_column=FILE_COLUMN, arrived=arrived, keep_failure=False)
        except Exception as exc:
            bad = unreadable(paths, lambda some: _read(spark, some, config, sizes)
                             ) if is_read_error(exc) else {}
            if not bad:
                refuse(spark, config, label, f"{type(exc).__name__}: {exc}")
                raise
            for p, why in sorted(bad.items()):
                stop(p, why)
            refused += len(bad)
            paths = [p for p in paths if p not in bad]
    if result is None and refused:
        run = tgt.new_run()
        tgt.start_label(spark, config.target, label, run)
        tgt.commit(spark, config.target, run, rows=False)
    return result


def _read(spark: SparkSession, paths, config: LoadConfig, sizes) -> None:
    """Read every row of the files, and drop it."""
    for df, _files in scan(spark, paths, config, sizes):
        df.write.format("noop").mode("overwrite").save()


def _key(path: str, root: str) -> str:
    """A file's key below ``root``, as its rows name it."""
    path, base = plain_path(path), plain_path(root) + "/"
    return path.removeprefix(base)


def start_stream(spark: SparkSession, raw_dir: str, config: LoadConfig, checkpoint: str,
                 root: str | None = None, available_now: bool = True,
                 processing_time: str = "10 seconds",
                 max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                 live: LiveCounts | None = None):
    """Start the query that loads every new CSV under ``raw_dir``.

    Returns ``(query, results)``; ``results`` fills with one
    :class:`LoadResult` per micro-batch. ``root`` (default: the parent of
    ``raw_dir``) is cut from file paths to give keys such as ``raw/x.csv``.
    ``live`` receives the counts of each micro-batch as the query reports it.
    """
    root = root or raw_dir.rstrip("/").rsplit("/", 1)[0]
    results: list[LoadResult] = []

    def on_batch(batch: DataFrame, epoch: int) -> None:
        label = f"stream {checkpoint} epoch {epoch}"
        if already_loaded(spark, config.target, label):
            return  # an epoch replayed after a restart: its load is done
        # Only the new files' paths and lengths come to the driver.
        sizes = {r["path"]: r["length"] for r in batch.select("path", "length").collect()}
        res = load_files(spark, list(sizes), config, root, label, sizes=sizes)
        if res is not None:
            results.append(res)
            if live:
                live.loaded(epoch, res.counts)

    new_files = stream_new_files(spark, raw_dir, max_files_per_trigger=max_files_per_trigger)
    writer = (observe_arrivals(new_files).writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(), results


def run_stream(spark: SparkSession, raw_dir: str, config: LoadConfig, checkpoint: str,
               root: str | None = None,
               max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
               live: LiveCounts | None = None) -> list[LoadResult]:
    """P2 drained once: load what has arrived since the last run, then stop."""
    query, results = start_stream(spark, raw_dir, config, checkpoint, root,
                                  max_files_per_trigger=max_files_per_trigger, live=live)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if live:
        live.wait()
    return results
