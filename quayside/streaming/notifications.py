"""Loads driven by a stream of arrival notifications: P3.

Every notification routed ``LOAD`` loads its file, so a file put again under
the same key loads again (D17), as the notification-driven original does. A
notification that is delivered twice (the same bucket, key and event time) loads
once. Of several events of one key in a micro-batch the last one loads, as the file
holds its content alone; each earlier one leaves a ``SUPERSEDED`` audit row.
Routing rows for every record, whatever the status, can be kept in
``routing_dir`` (one folder per micro-batch, replaced on a retry).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans import files
from quayside.plans.load import LoadConfig, LoadResult, refuse
from quayside.plans.target import already_loaded
from quayside.sources.notify import LOAD, drop_redelivered, route_notifications
from quayside.streaming.files import load_files

SUPERSEDED = "SUPERSEDED"
# How long an event is remembered by default, to know it when it is delivered again.
REDELIVERY_WINDOW = "1 day"

# Files whose existence is asked for at a time.
CHECK_THREADS = 32
# Message files per micro-batch by default (bounds the keys a batch brings
# to the driver; a backlog drains over several batches).
DEFAULT_MESSAGE_FILES_PER_TRIGGER = 1_000


def stream_messages(spark: SparkSession, inbox: str,
                    max_files_per_trigger: int | None = DEFAULT_MESSAGE_FILES_PER_TRIGGER
                    ) -> DataFrame:
    """Notification messages, one JSON document per line, from files
    dropped in ``inbox``; the message is in column ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(inbox)


def start_notifications(spark: SparkSession, messages: DataFrame, config: LoadConfig,
                        checkpoint: str, zone_for: Callable[[str], str] | str,
                        json_col: str = "value", routing_dir: str | None = None,
                        available_now: bool = True,
                        redelivered_within: str = REDELIVERY_WINDOW):
    """Start the query; returns ``(query, results)``.

    ``zone_for`` maps a bucket name to the folder that stands for it (or is
    that folder, for a single bucket); a record's file is
    ``<zone>/<key>`` and its ``source_file`` is the key. Events are remembered for
    ``redelivered_within``.
    """
    results: list[LoadResult] = []
    resolve = (lambda _b: zone_for) if isinstance(zone_for, str) else zone_for

    def on_batch(routed: DataFrame, epoch: int) -> None:
        if routing_dir:
            routed.write.mode("overwrite").parquet(f"{routing_dir.rstrip('/')}/epoch={epoch}")
        # Only keys of files to load come to the driver, and how often each was put.
        todo = (routed.where(F.col("status") == LOAD).groupBy("bucket", "key")
                .agg(F.greatest(F.count_distinct("event_time"), F.lit(1)).alias("events"),
                     F.max("event_time").cast("string").alias("last")).collect())
        by_zone: dict[str, dict[str, tuple]] = {}
        for r in todo:
            zone = resolve(r["bucket"]).rstrip("/")
            by_zone.setdefault(zone, {})[r["key"]] = (r["events"], r["last"])
        for i, (zone, keys) in enumerate(sorted(by_zone.items())):
            label = f"notifications {checkpoint} epoch {epoch} zone {i}"
            if already_loaded(spark, config.target, label):
                continue  # replayed after a restart: this load is done
            for k, (events, last) in sorted(keys.items()):
                for _ in range(events - 1):
                    refuse(spark, config, f"{zone}/{k}", f"put again at {last}", k, SUPERSEDED)
            paths = [f"{zone}/{k}" for k in sorted(keys)]
            # A file removed since its notification is skipped, not fatal.
            with ThreadPoolExecutor(CHECK_THREADS) as pool:
                there = list(pool.map(lambda p: files.exists(spark, p), paths))
            res = load_files(spark, [p for p, t in zip(paths, there) if t], config, zone, label,
                             missing=[p for p, t in zip(paths, there) if not t])
            if res is not None:
                results.append(res)

    events = drop_redelivered(route_notifications(messages, json_col), redelivered_within)
    writer = (events.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(), results


def run_notifications(spark: SparkSession, messages: DataFrame, config: LoadConfig,
                      checkpoint: str, zone_for: Callable[[str], str] | str,
                      json_col: str = "value", routing_dir: str | None = None,
                      redelivered_within: str = REDELIVERY_WINDOW) -> list[LoadResult]:
    """P3 drained once: handle every notification that has arrived."""
    query, results = start_notifications(spark, messages, config, checkpoint, zone_for,
                                         json_col, routing_dir,
                                         redelivered_within=redelivered_within)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return results
