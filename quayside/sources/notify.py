"""Arrival notifications (S5): JSON messages to one routing row per record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.paths import RAW_PREFIX, decode_key, is_csv

# Fixed value: the shape of an object-created notification.
NOTIFICATION_SCHEMA = (
    "Records ARRAY<STRUCT<eventTime: STRING, s3: STRUCT<bucket: STRUCT<name: STRING>, "
    "object: STRUCT<key: STRING>>>>"
)

LOAD = "LOAD"
SKIPPED_FORMAT = "SKIPPED_FORMAT"
SKIPPED_PREFIX = "SKIPPED_PREFIX"
INVALID = "INVALID"


def route_notifications(df: DataFrame, json_col: str = "body",
                        prefix: str = RAW_PREFIX) -> DataFrame:
    """Parse ``json_col`` and give one row per record.

    Output: the other input columns, then ``record`` (position in the
    message, null when there is none), ``bucket``, ``key`` (form-decoded:
    ``+`` is a space), ``status``, ``message`` and ``event_time`` (null where the
    record has none that can be read). A message that is not
    JSON, has no ``Records`` or an empty one gives a single ``INVALID`` row;
    a record whose key is not under ``prefix`` is ``SKIPPED_PREFIX``, one whose
    key does not end in ``.csv`` (any case) ``SKIPPED_FORMAT``; the rest are ``LOAD``. Every record is handled,
    whatever the status of the ones before it.
    """
    keep = [F.col("`" + c + "`") for c in df.columns if c != json_col]
    parsed = F.from_json(F.col(json_col), NOTIFICATION_SCHEMA)
    rows = df.select(*keep, F.posexplode_outer(parsed["Records"]).alias("record", "_r"))
    # The key is decoded in a projection of its own: once a record.
    rows = rows.select(*keep, "record", F.col("_r").isNull().alias("_none"),
                       F.col("_r.s3.bucket.name").alias("bucket"),
                       decode_key(F.col("_r.s3.object.key")).alias("key"),
                       F.expr("try_cast(_r.eventTime AS timestamp)").alias("event_time"))
    key = F.col("key")
    status = (F.when(key.isNull(), F.lit(INVALID))
               .when(~F.startswith(key, F.lit(prefix)), F.lit(SKIPPED_PREFIX))
               .when(is_csv(key), F.lit(LOAD))
               .otherwise(F.lit(SKIPPED_FORMAT)))
    message = (F.when(F.col("_none"), F.lit("no records in message"))
                .when(key.isNull(), F.lit("record without key"))
                .when(~F.startswith(key, F.lit(prefix)), F.lit("not under the raw prefix"))
                .when(~is_csv(key), F.lit("not a csv key")))
    return rows.select(*keep, "record", "bucket", "key", status.alias("status"),
                       message.alias("message"), "event_time")


def drop_redelivered(routed: DataFrame, within: str) -> DataFrame:
    """Of a stream of routing rows, drop ``LOAD`` rows that repeat an event: the same
    bucket, key and event time, seen ``within`` this time before. Rows without an event
    time can't be told from new events and stay, as do rows of another status. The
    watermark follows the clock of arrival, so no row is ever too late; state older
    than ``within`` is dropped."""
    event = F.concat_ws("\n", F.coalesce("bucket", F.lit("")), "key",
                        F.unix_micros("event_time").cast("string"))
    known = (F.col("status") == LOAD) & F.col("event_time").isNotNull()
    marked = routed.withColumn("_event", F.when(known, event).otherwise(F.uuid()))
    return (marked.withColumn("_seen_at", F.current_timestamp())
            .withWatermark("_seen_at", within).dropDuplicatesWithinWatermark(["_event"])
            .drop("_event", "_seen_at"))
