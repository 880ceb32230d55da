"""

Every query reads the given tables (or data Spark derives from them) whole.
Queries that exercise the write path (landing, loads, streams, the target)
write under a fresh folder below the session's ``spark.checkpoint.dir``.
Column names match between each query and its oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.paths import extension, is_csv
from quayside.operators.audit import count_load, read_audit, read_file_audit
from quayside.operators.columns import (ColumnCollisionError, add_metadata, apply_mapping,
                                        ensure_id, schema_profile)
from quayside.operators.quality import dedup, dedup_rows, redistribute, require_not_null
from quayside.plans import files
from quayside.plans import target as tgt
from quayside.plans.load import LoadConfig, prepare, run_load
from quayside.session import configure, scratch_dir
from quayside.sources.csv import inventory, land_csv, list_files, to_text
from quayside.sources.notify import route_notifications
from quayside.streaming.files import run_stream
from quayside.streaming.notifications import run_notifications, stream_messages
from quayside.streaming.progress import LiveCounts

try:
    from quayside.llm import queries as _llm
except ImportError:  # the subpackage, or something that it needs, isn't there
    _llm = None

# Fixed load time and decimal text format used by the query set.
TS = "2024-02-01 00:00:00"
MONEY = "decimal(18,2)"
SPLIT = "2024-01-15 00:00:00"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------- queries

def q_row_hash_content(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("text", "lang", "source")
    return ensure_id(docs, "content").select("id", "text", "lang", "source")


def q_row_hash_as_coded(spark, sf_dir):
    nation = add_metadata(_t(spark, sf_dir, "nation"), "raw/nation.csv", TS)
    return ensure_id(nation, "as_coded").select("id", "n_nationkey", "n_name", "n_regionkey")


def q_metadata_columns(spark, sf_dir):
    region = add_metadata(_t(spark, sf_dir, "region"), "raw/region.csv", TS)
    return region.select("r_regionkey", "r_name",
                         F.col("ingestion_timestamp").cast("string").alias("ingestion_timestamp"),
                         "source_file")


def _events_with_id(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", "user_id",
                     F.nullif(F.col("event_type"), F.lit("error")).alias("id"))


def q_required_not_null(spark, sf_dir):
    kept, _rejected = require_not_null(_events_with_id(spark, sf_dir), ["id"])
    return kept


def q_required_rejects(spark, sf_dir):
    kept, rejected = require_not_null(_events_with_id(spark, sf_dir), ["id"])
    one = kept.agg(F.count("*").alias("kept"))
    return one.select("kept", rejected.agg(F.count("*")).scalar().alias("rejected"))


def q_dedup_exact(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("text", "lang", "source")
    return dedup_rows(docs).select("id", "text", "lang", "source")


def q_dedup_latest(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    out = dedup(ev, ["user_id"], order_by=["ts", "event_id"])
    return out.select("user_id", "event_id", F.col("ts").cast("string").alias("ts"),
                      "event_type", "value", "props")


def q_apply_mapping(spark, sf_dir):
    orders = to_text(_t(spark, sf_dir, "orders"), MONEY).withColumnRenamed("o_orderkey", "id")
    return apply_mapping(add_metadata(orders, "raw/orders.csv", TS))


def q_schema_profile(spark, sf_dir):
    return schema_profile(_t(spark, sf_dir, "customer"))


def q_load_audit(spark, sf_dir):
    return count_load(_t(spark, sf_dir, "conversations"), "conv_id")


def q_ingest_orders(spark, sf_dir):
    orders = to_text(_t(spark, sf_dir, "orders"), MONEY)
    mapped, _obs = prepare(orders, LoadConfig(target="unused", ts=TS), source="raw/orders.csv")
    return mapped


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate"]


def hot_key_lineitem(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as text with a file key where every open line shares the
    key ``hot`` (about half of all rows) and the rest repeat now and then."""
    li = to_text(lineitem, MONEY)
    key = (F.when(F.col("l_linestatus") == "O", F.lit("hot"))
            .otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber")))
    return li.select(key.alias("id"), *_LI_COLS)


def q_ingest_hot_key(spark, sf_dir):
    df = hot_key_lineitem(_t(spark, sf_dir, "lineitem"))
    cfg = LoadConfig(target="unused", ts=TS, order_by=("l_orderkey", "l_linenumber"))
    mapped, _obs = prepare(df, cfg, source="raw/lineitem.csv")
    return mapped


def q_dedup_conversations(spark, sf_dir):
    conv = _t(spark, sf_dir, "conversations")
    return dedup(conv, ["conv_id"], order_by=["turn"])


def q_ingest_csv_roundtrip(spark, sf_dir):
    zone = scratch_dir(spark, "roundtrip")
    raw = land_csv(_t(spark, sf_dir, "customer"), f"{zone}/raw", "customer.csv",
                   double_format=MONEY)
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_load(spark, raw, cfg, key="raw/customer.csv")
    return tgt.current(spark, cfg.target)


def _csv_round_trip(spark, sf_dir, table, label):
    zone = scratch_dir(spark, label)
    raw = land_csv(_t(spark, sf_dir, table), f"{zone}/raw", f"{table}.csv")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_load(spark, raw, cfg, key=f"raw/{table}.csv")
    return tgt.current(spark, cfg.target)


def q_ingest_documents_csv(spark, sf_dir):
    """Whole texts with quotes and line breaks through CSV and a load."""
    return _csv_round_trip(spark, sf_dir, "documents", "documents")


def q_ingest_pages_csv(spark, sf_dir):
    """Raw HTML pages through CSV and a load."""
    return _csv_round_trip(spark, sf_dir, "pages", "pages")


def q_ingest_split_scan(spark, sf_dir):
    """Quoted texts with line breaks, every file read in several splits."""
    zone = scratch_dir(spark, "split")
    raw = land_csv(_t(spark, sf_dir, "documents"), f"{zone}/raw", "documents.csv")
    total = sum(list_files(spark, raw).values())
    cfg = LoadConfig(target=f"{zone}/target", ts=TS, split_over=0,
                     split_bytes=max(total // 64, 1 << 16))
    run_load(spark, raw, cfg, key="raw/documents.csv")
    return tgt.current(spark, cfg.target)


def q_load_run_audit(spark, sf_dir):
    zone = scratch_dir(spark, "audit")
    ev = _t(spark, sf_dir, "events").select(
        F.nullif(F.col("event_type"), F.lit("error")).alias("id"), "event_id", "user_id")
    raw = land_csv(ev, f"{zone}/raw", "events.csv")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS, order_by=("event_id",))
    run_load(spark, raw, cfg, key="raw/events.csv")
    return read_audit(spark, cfg.target).select("read", "null_rejected", "duplicates",
                                                "written", "status")


def _load_events_slice(spark, df, target, batch_id):
    latest = dedup(df, ["user_id"], order_by=["ts", "event_id"])
    text = to_text(latest, MONEY).withColumnRenamed("user_id", "id")
    mapped = apply_mapping(add_metadata(text, f"raw/events_{batch_id}.csv", TS))
    tgt.ensure_target(spark, target)
    tgt.upsert(mapped, target)


def _two_loads(spark, sf_dir, compact_between: bool):
    target = scratch_dir(spark, "upsert") + "/target"
    ev = _t(spark, sf_dir, "events")
    _load_events_slice(spark, ev.where(F.col("ts") < F.lit(SPLIT).cast("timestamp")), target, 1)
    if compact_between:
        tgt.compact(spark, target)
    _load_events_slice(spark, ev.where(F.col("ts") >= F.lit(SPLIT).cast("timestamp")), target, 2)
    return tgt.current(spark, target)


def q_upsert_two_loads(spark, sf_dir):
    return _two_loads(spark, sf_dir, compact_between=False)


def q_upsert_compacted(spark, sf_dir):
    return _two_loads(spark, sf_dir, compact_between=True)


def q_read_by_key(spark, sf_dir):
    """K5 for the keys of some users, of a compacted table with a newer load."""
    target = scratch_dir(spark, "by-key") + "/target"
    ev = _t(spark, sf_dir, "events")
    split = F.lit(SPLIT).cast("timestamp")
    _load_events_slice(spark, ev.where(F.col("ts") < split), target, 1)
    tgt.compact(spark, target, buckets=16)
    _load_events_slice(spark, ev.where(F.col("ts") >= split), target, 2)
    asked = ev.where(F.col("user_id") % 7 == 0).select(F.col("user_id").cast("string").alias("id"))
    return tgt.read_keys(spark, target, asked)


def q_schema_drift(spark, sf_dir):
    return tgt.merge_schemas([_t(spark, sf_dir, "customer"), _t(spark, sf_dir, "supplier")])


def q_items_long(spark, sf_dir):
    sup = to_text(_t(spark, sf_dir, "supplier"), MONEY).withColumnRenamed("s_suppkey", "id")
    return tgt.items_long(sup)


def notification_messages(events: DataFrame) -> DataFrame:
    """Arrival messages derived from events: one per event; purchases carry
    a second, non-CSV record; error events carry no ``Records``."""
    ext = (F.when(F.col("event_type") == "click", F.lit("CSV"))
            .when(F.col("event_type") == "view", F.lit("txt"))
            .otherwise(F.lit("csv")))
    key = F.concat(F.lit("raw/"), F.col("event_type"), F.lit("+"), F.col("user_id"),
                   F.lit("%20"), F.col("event_id"), F.lit("."), ext)
    rec = F.format_string('{"s3":{"bucket":{"name":"zone"},"object":{"key":"%s"}}}', key)
    extra = F.format_string('{"s3":{"bucket":{"name":"zone"},"object":{"key":"raw/%s.json"}}}',
                            F.col("event_id"))
    body = (F.when(F.col("event_type") == "error",
                   F.format_string('{"detail":"event %s"}', F.col("event_id")))
             .when(F.col("event_type") == "purchase",
                   F.concat(F.lit('{"Records":['), rec, F.lit(","), extra, F.lit("]}")))
             .otherwise(F.concat(F.lit('{"Records":['), rec, F.lit("]}"))))
    return events.select("event_id", body.alias("body"))


def q_notification_routing(spark, sf_dir):
    msgs = notification_messages(_t(spark, sf_dir, "events"))
    return route_notifications(msgs, "body").select("event_id", "record", "bucket", "key",
                                                    "status", "message")


def q_format_gate(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    ext = (F.when(F.col("event_type") == "click", F.lit("CSV"))
            .when(F.col("event_type") == "view", F.lit("txt"))
            .when(F.col("event_type") == "error", F.lit("tar.gz"))
            .otherwise(F.lit("csv")))
    key = F.concat(F.lit("raw/"), F.col("event_type"), F.lit("/"), F.col("event_id"),
                   F.lit("."), ext)
    keys = ev.select("event_id", key.alias("key"))
    return keys.select("event_id", "key", extension(F.col("key")).alias("ext"),
                       is_csv(F.col("key")).alias("eligible"))


def q_stream_ingest(spark, sf_dir):
    zone = scratch_dir(spark, "stream")
    land_csv(_t(spark, sf_dir, "orders").repartition(4), f"{zone}/raw", "orders",
             double_format=MONEY)
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_stream(spark, f"{zone}/raw", cfg, f"{zone}/_checkpoint")
    return _under(tgt.current(spark, cfg.target), "raw/orders/")


def _under(df, prefix):
    """Part files have random names: their key's fixed part is compared."""
    return df.withColumn("source_file", F.when(F.startswith("source_file", F.lit(prefix)),
                                               F.lit(prefix)))


def q_stream_notifications(spark, sf_dir):
    zone = scratch_dir(spark, "notify")
    land_csv(_t(spark, sf_dir, "customer").repartition(3), f"{zone}/raw", "customer",
             double_format=MONEY)
    landed = inventory(spark, f"{zone}/raw", root=zone)
    keys = landed.select(F.col("key")).unionByName(
        landed.select(F.concat(F.col("key"), F.lit(".done")).alias("key")))
    msg = F.format_string('{"Records":[{"s3":{"bucket":{"name":"zone"},'
                          '"object":{"key":"%s"}}}]}', F.col("key"))
    keys.select(msg.alias("value")).write.mode("overwrite").text(f"{zone}/inbox")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_notifications(spark, stream_messages(spark, f"{zone}/inbox"), cfg,
                      f"{zone}/_checkpoint", zone_for=zone)
    return _under(tgt.current(spark, cfg.target), "raw/customer/")


def q_stream_redelivery(spark, sf_dir):
    """Events delivered twice load once, events of a file put again load again."""
    zone = scratch_dir(spark, "redelivery")
    land_csv(_t(spark, sf_dir, "customer"), f"{zone}/raw", "customer", double_format=MONEY)
    keys = inventory(spark, f"{zone}/raw", root=zone).select("key")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    for time in ("01:00:00", "01:00:00", "02:00:00", "01:00:00"):
        msg = F.format_string('{"Records":[{"eventTime":"2024-01-01T' + time + 'Z","s3":{'
                              '"bucket":{"name":"zone"},"object":{"key":"%s"}}}]}', F.col("key"))
        keys.select(msg.alias("value")).write.mode("append").text(f"{zone}/inbox")
        run_notifications(spark, stream_messages(spark, f"{zone}/inbox"), cfg,
                          f"{zone}/_checkpoint", zone_for=zone)
    loads = F.lit(len(tgt.batch_ids(spark, cfg.target))).cast("long")
    return _under(tgt.current(spark, cfg.target), "raw/customer/").select(
        "*", loads.alias("loads"))


def q_raw_inventory(spark, sf_dir):
    zone = scratch_dir(spark, "inventory")
    for name in ("region", "nation"):
        land_csv(_t(spark, sf_dir, name).coalesce(1), f"{zone}/raw", f"{name} 100%.csv")
    files_ = inventory(spark, f"{zone}/raw", root=zone)
    # The second part of a key is the landed folder, the third a part's random name.
    return files_.groupBy("ext", "eligible",
                          F.split("key", "/")[1].alias("folder")).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"),
        F.sum("size_mb").alias("size_mb"), F.count("modified").alias("dated"))


def _events_text(spark, sf_dir, *columns):
    return to_text(_t(spark, sf_dir, "events").select(F.col("event_id").alias("id"), *columns))


def q_load_malformed_audit(spark, sf_dir):
    """Purchases carry a field more than the header."""
    zone = scratch_dir(spark, "malformed")
    ev = _events_text(spark, sf_dir, "event_type")
    extra = F.when(F.col("event_type") == "purchase", F.lit(",EXTRA")).otherwise("")
    lines = ev.select(F.concat("id", F.lit(","), "event_type", extra).alias("id,event_type"))
    lines.write.option("header", True).option("sep", "|").csv(f"{zone}/raw/events.csv")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_load(spark, f"{zone}/raw/events.csv", cfg, key="raw/events.csv")
    return read_audit(spark, cfg.target).select("read", "null_rejected", "duplicates", "written",
                                                "malformed", "status")


def q_replayed_stream(spark, sf_dir):
    """An epoch run again after a crash between its load and its checkpoint."""
    zone = scratch_dir(spark, "replay")
    land_csv(_events_text(spark, sf_dir, "user_id", "event_type").drop("id"), f"{zone}/raw", "events")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_stream(spark, f"{zone}/raw", cfg, f"{zone}/_checkpoint")
    for name in ("0", ".0.crc"):
        files.delete(spark, f"{zone}/_checkpoint/commits/{name}")
    run_stream(spark, f"{zone}/raw", cfg, f"{zone}/_checkpoint")
    counted = F.lit(len(tgt.batch_ids(spark, cfg.target))).cast("long").alias("loads")
    return _under(tgt.current(spark, cfg.target), "raw/events/").select("*", counted)


def q_stream_mixed_headers(spark, sf_dir):
    """One micro-batch of files with a key column and files without one."""
    zone = scratch_dir(spark, "mixed")
    cust = to_text(_t(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    land_csv(cust.withColumnRenamed("c_custkey", "id"), f"{zone}/raw", "customer")
    land_csv(_t(spark, sf_dir, "supplier").select("s_name", "s_nationkey"), f"{zone}/raw", "supplier")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_stream(spark, f"{zone}/raw", cfg, f"{zone}/_checkpoint")
    return tgt.current(spark, cfg.target).select("id", "c_name", "s_name", "s_nationkey")


def q_stream_arrival_order(spark, sf_dir):
    """Files that share keys in one micro-batch: the later ones win."""
    zone = scratch_dir(spark, "arrival")
    ev = _t(spark, sf_dir, "events")
    split = F.lit(SPLIT).cast("timestamp")
    for name, part in (("z_first", ev.where(F.col("ts") < split)),
                       ("a_second", ev.where(F.col("ts") >= split))):
        latest = dedup(part, ["user_id"], order_by=["ts", "event_id"])
        text = to_text(latest, MONEY).withColumnRenamed("user_id", "id")
        land_csv(text, f"{zone}/raw", name)  # the second half's files arrive later
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_stream(spark, f"{zone}/raw", cfg, f"{zone}/_checkpoint")
    return tgt.current(spark, cfg.target).drop("source_file", "timestamp")


def _by_folder(audit):
    """Counts per arrived file, added up over each landed folder's part files."""
    counts = ("read", "null_rejected", "duplicates", "written", "malformed")
    return audit.where("status <> 'EMPTY'").groupBy(
        F.split("source_file", "/")[1].alias("folder"), "status").agg(
        *[F.sum(c).alias(c) for c in counts])


def q_stream_file_audit(spark, sf_dir):
    """Counts per arrived file: files that share keys, within and between them."""
    zone = scratch_dir(spark, "files")
    ev = _t(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 != 0, F.col("user_id")).alias("id"), "event_id", "value")
    for k in range(3):  # a later folder's rows win
        land_csv(ev.where(F.col("event_id") % 3 == k), f"{zone}/raw", f"part{k}")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_stream(spark, f"{zone}/raw", cfg, f"{zone}/_checkpoint")
    return _by_folder(read_file_audit(spark, cfg.target))


def q_stream_live_counts(spark, sf_dir):
    """A1, A2 of a running stream: sums of its progress rows, a file a micro-batch."""
    zone = scratch_dir(spark, "live")
    ev = _t(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 != 0, F.col("user_id")).alias("id"), "event_id")
    land_csv(ev.repartition(3, "id"), f"{zone}/raw", "events")
    live = LiveCounts(spark)
    try:
        run_stream(spark, f"{zone}/raw", LoadConfig(target=f"{zone}/target", ts=TS),
                   f"{zone}/_checkpoint", max_files_per_trigger=1, live=live)
    finally:
        live.close()
    return live.frame().agg(*[F.sum(c).alias(c) for c in (
        "files", "read", "null_rejected", "duplicates", "written", "malformed")])


def q_stream_quarantine(spark, sf_dir):
    """Purchases arrive in files with a row of more fields than Spark's reader takes;
    the other events' files load all the same."""
    zone = scratch_dir(spark, "quarantine")
    ev = _events_text(spark, sf_dir, "event_type")
    broken = ev.where(F.col("event_type") == "purchase")
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # of each file
    extra = F.when(first, F.repeat(F.lit(","), 25_000)).otherwise("")
    (broken.select(F.concat("id", F.lit(","), "event_type", extra).alias("id,event_type"))
     .write.option("header", True).option("sep", "|").csv(f"{zone}/raw/broken"))
    land_csv(ev.where(F.col("event_type") != "purchase"), f"{zone}/raw", "good")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_stream(spark, f"{zone}/raw", cfg, f"{zone}/_checkpoint")
    audit = _by_folder(read_file_audit(spark, cfg.target))
    return audit.select("folder", "status", "read", "written")


def q_overlapping_loads(spark, sf_dir):
    """P5: two loads of one target at the same time; both count."""
    from concurrent.futures import ThreadPoolExecutor

    zone = scratch_dir(spark, "overlap")
    ev = _events_text(spark, sf_dir, "user_id", "event_type")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    raw = [land_csv(ev.where(F.col("id").cast("long") % 2 == k), f"{zone}/raw", f"half{k}.csv")
           for k in range(2)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: run_load(spark, raw[k], cfg, key=f"raw/half{k}.csv"), range(2)))
    loads = F.lit(len(tgt.batch_ids(spark, cfg.target))).cast("long")
    return tgt.current(spark, cfg.target).select("*", loads.alias("loads"))


def q_load_time(spark, sf_dir):
    """T1 by the clock: one time for all rows, between the load's begin and end."""
    zone = scratch_dir(spark, "time")
    raw = land_csv(_t(spark, sf_dir, "customer"), f"{zone}/raw", "customer.csv",
                   double_format=MONEY)
    begin = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    cfg = LoadConfig(target=f"{zone}/target")
    run_load(spark, raw, cfg, key="raw/customer.csv")
    end = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    at = F.col("timestamp").cast("timestamp")
    return tgt.current(spark, cfg.target).agg(
        F.count("*").alias("rows"), F.count_distinct("timestamp").alias("load_times"),
        F.count_if(at.between(F.lit(begin), F.lit(end))).alias("within"))


def q_empty_load_audit(spark, sf_dir):
    """A file with a header and no row (S3): none of the orders is chosen."""
    zone = scratch_dir(spark, "empty")
    none = to_text(_t(spark, sf_dir, "orders"), MONEY).where(F.col("o_orderkey").isNull())
    land_csv(none, f"{zone}/raw", "orders.csv")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    run_load(spark, f"{zone}/raw/orders.csv", cfg, key="raw/orders.csv")
    return read_audit(spark, cfg.target).select("read", "written", "status", "message")


def q_failed_load_audit(spark, sf_dir):
    """A load that can't run (A4) beside one that does, on a table kept (K1)."""
    zone = scratch_dir(spark, "failed")
    nation = to_text(_t(spark, sf_dir, "nation"))
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    for name, df in (("nation", nation), ("bad", nation.withColumnRenamed("n_name", "timestamp"))):
        raw = land_csv(df, f"{zone}/raw", f"{name}.csv")
        try:
            run_load(spark, raw, cfg, key=f"raw/{name}.csv")
        except ColumnCollisionError:
            pass  # its record is what is asked for
    return read_audit(spark, cfg.target).select("source_file", "read", "written", "status")


def q_bounded_write(spark, sf_dir):
    """K3: the load's files are as many as asked for."""
    zone = scratch_dir(spark, "bounded")
    raw = land_csv(_t(spark, sf_dir, "customer").repartition(5), f"{zone}/raw", "customer.csv",
                   double_format=MONEY)
    cfg = LoadConfig(target=f"{zone}/target", ts=TS, write_partitions=3)
    run_load(spark, raw, cfg, key="raw/customer.csv")
    runs = files.child_dirs(spark, f"{cfg.target}/log")
    parts = sum(n.endswith(".parquet") for r in runs
                for n in files.child_files(spark, f"{cfg.target}/log/{r}"))
    return tgt.current(spark, cfg.target).select("*", F.lit(parts).cast("long").alias("files"))


def q_redistribute(spark, sf_dir):
    """rows of one key share a partition, and none is lost."""
    out = redistribute(_t(spark, sf_dir, "lineitem"), 7, "l_orderkey")
    parts = out.select("l_orderkey", F.spark_partition_id().alias("p"))
    return parts.groupBy("l_orderkey").agg(F.count("*").alias("rows"),
                                           F.count_distinct("p").alias("partitions"))


def q_drop_and_reload(spark, sf_dir):
    """K4: a dropped table starts anew."""
    zone = scratch_dir(spark, "drop")
    cfg = LoadConfig(target=f"{zone}/target", ts=TS)
    for name in ("nation", "region"):
        tgt.drop_target(spark, cfg.target)
        run_load(spark, land_csv(_t(spark, sf_dir, name), f"{zone}/raw", f"{name}.csv"), cfg,
                 key=f"raw/{name}.csv")
    return tgt.current(spark, cfg.target)


# ------------------------------------------------------------ contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the one-write load plan over ``orders`` at sf0.001."""
    configure(spark)
    return q_ingest_orders(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {
        "row_hash_content": q_row_hash_content,
        "row_hash_as_coded": q_row_hash_as_coded,
        "metadata_columns": q_metadata_columns,
        "required_not_null": q_required_not_null,
        "required_rejects": q_required_rejects,
        "dedup_exact": q_dedup_exact,
        "dedup_latest": q_dedup_latest,
        "apply_mapping": q_apply_mapping,
        "schema_profile": q_schema_profile,
        "load_audit": q_load_audit,
        "ingest_orders": q_ingest_orders,
        "ingest_hot_key": q_ingest_hot_key,
        "dedup_conversations": q_dedup_conversations,
        "ingest_csv_roundtrip": q_ingest_csv_roundtrip,
        "ingest_documents_csv": q_ingest_documents_csv,
        "ingest_pages_csv": q_ingest_pages_csv,
        "ingest_split_scan": q_ingest_split_scan,
        "load_run_audit": q_load_run_audit,
        "upsert_two_loads": q_upsert_two_loads,
        "upsert_compacted": q_upsert_compacted,
        "read_by_key": q_read_by_key,
        "schema_drift": q_schema_drift,
        "items_long": q_items_long,
        "notification_routing": q_notification_routing,
        "format_gate": q_format_gate,
        "stream_ingest": q_stream_ingest,
        "stream_notifications": q_stream_notifications,
        "stream_redelivery": q_stream_redelivery,
        "raw_inventory": q_raw_inventory,
        "load_malformed_audit": q_load_malformed_audit,
        "replayed_stream": q_replayed_stream,
        "stream_mixed_headers": q_stream_mixed_headers,
        "stream_arrival_order": q_stream_arrival_order,
        "stream_file_audit": q_stream_file_audit,
        "stream_live_counts": q_stream_live_counts,
        "stream_quarantine": q_stream_quarantine,
        "overlapping_loads": q_overlapping_loads,
        "load_time": q_load_time,
        "empty_load_audit": q_empty_load_audit,
        "failed_load_audit": q_failed_load_audit,
        "bounded_write": q_bounded_write,
        "redistribute": q_redistribute,
        "drop_and_reload": q_drop_and_reload,
    }
    return own | (_llm.QUERIES if _llm else {})


# ---------------------------------------------------------------- oracle

def _enc(col: str) -> str:
    """SQL twin of the content profile's field encoding."""
    return f"coalesce(replace(replace(CAST({col} AS VARCHAR), '\\', '\\\\'), '_', '\\_'), '\\N')"


def _content_id(cols: list[str]) -> str:
    return "'record-' || md5(concat_ws('_', " + ", ".join(_enc(c) for c in cols) + "))"


def _money(col: str) -> str:
    return f"CAST(CAST({col} AS DECIMAL(18,2)) AS VARCHAR)"


def _txt(col: str) -> str:
    return f"CAST({col} AS VARCHAR)"


_ORDERS_TEXT = f"""SELECT {_txt('o_orderkey')} AS o_orderkey, {_txt('o_custkey')} AS o_custkey,
       o_orderstatus, {_money('o_totalprice')} AS o_totalprice,
       {_txt('o_orderdate')} AS o_orderdate, o_orderpriority FROM orders"""
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]
_CUSTOMER_TEXT = f"""SELECT {_txt('c_custkey')} AS c_custkey, c_name,
       {_txt('c_nationkey')} AS c_nationkey, {_money('c_acctbal')} AS c_acctbal,
       c_mktsegment FROM customer"""
_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_DOC_ID = _content_id(["text", "lang", "source"])
_DOCS_TEXT = ("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, "
              "CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
_PAGES_TEXT = "SELECT CAST(page_id AS VARCHAR) AS page_id, url, html FROM pages"


def _ingested(text_sql: str, cols: list[str], source: str | None) -> str:
    src = f", '{source}' AS source_file" if source else ""
    return (f"SELECT DISTINCT {_content_id(cols)} AS id, '{TS}' AS timestamp{src}, "
            + ", ".join(cols) + f" FROM ({text_sql}) t")


_EVENTS_LOADED = f"""
WITH l AS (SELECT *, CASE WHEN ts < TIMESTAMP '{SPLIT}' THEN 1 ELSE 2 END AS load
           FROM events)
SELECT {_txt('user_id')} AS id, '{TS}' AS timestamp,
       'raw/events_' || load || '.csv' AS source_file,
       {_txt('event_id')} AS event_id, {_txt('ts')} AS ts, event_type,
       {_money('value')} AS value, props
FROM l
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY load DESC, ts DESC, event_id DESC) = 1
"""

_ROUTING = """
WITH e AS (
  SELECT event_id, event_type,
         'raw/' || event_type || ' ' || user_id || ' ' || event_id || '.' ||
         CASE event_type WHEN 'click' THEN 'CSV' WHEN 'view' THEN 'txt' ELSE 'csv' END AS k
  FROM events)
SELECT event_id, 0 AS record, 'zone' AS bucket, k AS key,
       CASE WHEN lower(k) LIKE '%.csv' THEN 'LOAD' ELSE 'SKIPPED_FORMAT' END AS status,
       CASE WHEN lower(k) LIKE '%.csv' THEN NULL ELSE 'not a csv key' END AS message
FROM e WHERE event_type <> 'error'
UNION ALL
SELECT event_id, 1, 'zone', 'raw/' || event_id || '.json', 'SKIPPED_FORMAT', 'not a csv key'
FROM e WHERE event_type = 'purchase'
UNION ALL
SELECT event_id, NULL, NULL, NULL, 'INVALID', 'no records in message' FROM e WHERE event_type = 'error'
"""

_FORMAT_GATE = """
WITH k AS (
  SELECT event_id, 'raw/' || event_type || '/' || event_id || '.' ||
         CASE event_type WHEN 'click' THEN 'CSV' WHEN 'view' THEN 'txt'
                         WHEN 'error' THEN 'tar.gz' ELSE 'csv' END AS key
  FROM events)
SELECT event_id, key, lower(string_split(key, '.')[-1]) AS ext,
       lower(key) LIKE '%.csv' AS eligible
FROM k
"""


_LI_TEXT = ", ".join(
    _money(c) + f" AS {c}" if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    else f"{_txt(c)} AS {c}" for c in _LI_COLS)
_HOT_KEY = f"""
WITH t AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'hot'
              ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS id,
         {_LI_TEXT}
  FROM lineitem)
SELECT id, '{TS}' AS timestamp, 'raw/lineitem.csv' AS source_file, {", ".join(_LI_COLS)}
FROM t
QUALIFY row_number() OVER (
  PARTITION BY id
  ORDER BY l_orderkey DESC, l_linenumber DESC, id DESC,
           {", ".join(c + " DESC NULLS LAST" for c in _LI_COLS)}) = 1
"""


def _csv_bytes(table: str, columns: list[str]) -> str:
    """Files, bytes and size of a table landed as one CSV file (no value of
    these columns needs a quote)."""
    size = (f"CAST({len(','.join(columns)) + 1} + sum("
            + " + ".join(f"octet_length(encode({_txt(c)})) + 1" for c in columns) + ") AS BIGINT)")
    return (f"SELECT 'csv' AS ext, true AS eligible, '{table} 100%.csv' AS folder, 1 AS files, "
            f"{size} AS bytes, {size} / 1048576 AS size_mb, 1 AS dated FROM {table}")


_INVENTORY = (_csv_bytes("region", ["r_regionkey", "r_name"]) + " UNION ALL "
              + _csv_bytes("nation", ["n_nationkey", "n_name", "n_regionkey"]))


def oracle_sql() -> dict[str, str]:
    own = {
        "row_hash_content": f"SELECT {_DOC_ID} AS id, text, lang, source FROM documents",
        "row_hash_as_coded": (
            "SELECT 'record-' || md5(concat_ws('_', n_nationkey, n_name, n_regionkey, "
            f"'{TS}', 'raw/nation.csv')) AS id, n_nationkey, n_name, n_regionkey FROM nation"),
        "metadata_columns": (
            f"SELECT r_regionkey, r_name, '{TS}' AS ingestion_timestamp, "
            "'raw/region.csv' AS source_file FROM region"),
        "required_not_null": (
            "SELECT event_id, user_id, nullif(event_type, 'error') AS id FROM events "
            "WHERE nullif(event_type, 'error') IS NOT NULL"),
        "required_rejects": (
            "SELECT count(nullif(event_type, 'error')) AS kept, "
            "count(*) - count(nullif(event_type, 'error')) AS rejected FROM events"),
        "dedup_exact": f"SELECT DISTINCT {_DOC_ID} AS id, text, lang, source FROM documents",
        "dedup_latest": (
            "SELECT user_id, event_id, CAST(ts AS VARCHAR) AS ts, event_type, value, props "
            "FROM events QUALIFY row_number() OVER "
            "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"),
        "apply_mapping": (
            f"SELECT {_txt('o_orderkey')} AS id, '{TS}' AS timestamp, "
            "'raw/orders.csv' AS source_file, " + ", ".join(_ORDER_COLS[1:])
            + f" FROM ({_ORDERS_TEXT}) t"),
        "schema_profile": (
            "SELECT CAST(ordinal_position AS INTEGER) AS ordinal, column_name AS name, "
            "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
            "WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' "
            "WHEN 'TIMESTAMP' THEN 'timestamp' ELSE lower(data_type) END AS type, "
            "is_nullable = 'YES' AS nullable "
            "FROM information_schema.columns WHERE table_name = 'customer'"),
        "load_audit": (
            "SELECT count(*) AS read, count(*) - count(conv_id) AS null_rejected, "
            "count(conv_id) - count(DISTINCT conv_id) AS duplicates, "
            "count(DISTINCT conv_id) AS written FROM conversations"),
        "ingest_orders": _ingested(_ORDERS_TEXT, _ORDER_COLS, "raw/orders.csv"),
        "ingest_hot_key": _HOT_KEY,
        "dedup_conversations": (
            "SELECT * FROM conversations QUALIFY row_number() OVER "
            "(PARTITION BY conv_id ORDER BY turn DESC) = 1"),
        "ingest_csv_roundtrip": _ingested(_CUSTOMER_TEXT, _CUSTOMER_COLS, "raw/customer.csv"),
        "ingest_documents_csv": _ingested(
            _DOCS_TEXT, ["doc_id", "text", "lang", "source", "n_chars"], "raw/documents.csv"),
        "ingest_split_scan": _ingested(
            _DOCS_TEXT, ["doc_id", "text", "lang", "source", "n_chars"], "raw/documents.csv"),
        "ingest_pages_csv": _ingested(_PAGES_TEXT, ["page_id", "url", "html"], "raw/pages.csv"),
        "load_run_audit": (
            "SELECT count(*) AS read, count(*) FILTER (WHERE event_type = 'error') "
            "AS null_rejected, count(*) FILTER (WHERE event_type <> 'error') - "
            "count(DISTINCT event_type) FILTER (WHERE event_type <> 'error') AS duplicates, "
            "count(DISTINCT event_type) FILTER (WHERE event_type <> 'error') AS written, "
            "'SUCCESS' AS status FROM events"),
        "upsert_two_loads": _EVENTS_LOADED,
        "upsert_compacted": _EVENTS_LOADED,
        "read_by_key": f"SELECT * FROM ({_EVENTS_LOADED}) WHERE CAST(id AS BIGINT) % 7 = 0",
        "schema_drift": "SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier",
        "items_long": (
            f"UNPIVOT (SELECT {_txt('s_suppkey')} AS id, s_name, "
            f"{_txt('s_nationkey')} AS s_nationkey, {_money('s_acctbal')} AS s_acctbal "
            "FROM supplier) ON s_name, s_nationkey, s_acctbal "
            "INTO NAME attribute VALUE value"),
        "notification_routing": _ROUTING,
        "format_gate": _FORMAT_GATE,
        "stream_ingest": _ingested(_ORDERS_TEXT, _ORDER_COLS, "raw/orders/"),
        "stream_notifications": _ingested(_CUSTOMER_TEXT, _CUSTOMER_COLS, "raw/customer/"),
        "stream_redelivery": (
            _ingested(_CUSTOMER_TEXT, _CUSTOMER_COLS, "raw/customer/").replace(
                " FROM (", ", 2 AS loads FROM (", 1)),
        "raw_inventory": _INVENTORY,
        "load_malformed_audit": (
            "SELECT count(*) AS read, 0 AS null_rejected, 0 AS duplicates, count(*) AS written, "
            "count(*) FILTER (WHERE event_type = 'purchase') AS malformed, "
            "'SUCCESS' AS status FROM events"),
        "replayed_stream": (
            _ingested("SELECT CAST(user_id AS VARCHAR) AS user_id, event_type FROM events",
                      ["user_id", "event_type"], "raw/events/").replace(
                          " FROM (", ", 1 AS loads FROM (", 1)),
        "stream_mixed_headers": (
            f"SELECT {_txt('c_custkey')} AS id, c_name, NULL AS s_name, NULL AS s_nationkey "
            "FROM customer UNION ALL "
            f"SELECT DISTINCT {_content_id(['s_name', 's_nationkey'])}, NULL, s_name, "
            f"{_txt('s_nationkey')} FROM supplier"),
        "stream_arrival_order": (
            f"SELECT * EXCLUDE (timestamp, source_file) FROM ({_EVENTS_LOADED})"),
        "stream_file_audit": (
            "WITH e AS (SELECT event_id % 3 AS f, CASE WHEN event_id % 10 <> 0 THEN user_id END "
            "AS id FROM events), "
            "last AS (SELECT id, max(f) AS f FROM e WHERE id IS NOT NULL GROUP BY id), "
            "kept AS (SELECT f, count(*) AS n FROM last GROUP BY f) "
            "SELECT 'part' || e.f AS folder, 'SUCCESS' AS status, count(*) AS read, "
            "count(*) - count(id) AS null_rejected, count(id) - coalesce(any_value(n), 0) "
            "AS duplicates, coalesce(any_value(n), 0) AS written, 0 AS malformed "
            "FROM e LEFT JOIN kept ON e.f = kept.f GROUP BY e.f"),
        "stream_live_counts": (
            "WITH e AS (SELECT CASE WHEN event_id % 10 <> 0 THEN user_id END AS id FROM events) "
            "SELECT 3 AS files, count(*) AS read, count(*) - count(id) AS null_rejected, "
            "count(id) - count(DISTINCT id) AS duplicates, count(DISTINCT id) AS written, "
            "0 AS malformed FROM e"),
        "stream_quarantine": (
            "SELECT 'good' AS folder, 'SUCCESS' AS status, count(*) AS read, count(*) AS written "
            "FROM events WHERE event_type <> 'purchase' UNION ALL "
            "SELECT DISTINCT 'broken', 'FAILED', 0, 0 FROM events WHERE event_type = 'purchase'"),
        "overlapping_loads": (
            f"SELECT {_txt('event_id')} AS id, '{TS}' AS timestamp, "
            "'raw/half' || event_id % 2 || '.csv' AS source_file, "
            f"{_txt('user_id')} AS user_id, event_type, 2 AS loads FROM events"),
        "load_time": ("SELECT count(*) AS rows, 1 AS load_times, count(*) AS within "
                      "FROM (SELECT DISTINCT * FROM customer)"),
        "empty_load_audit": (
            "SELECT count(*) AS read, count(*) AS written, 'EMPTY' AS status, "
            "'no records in source' AS message FROM orders WHERE o_orderkey IS NULL"),
        "failed_load_audit": (
            "SELECT 'raw/nation.csv' AS source_file, count(*) AS read, count(*) AS written, "
            "'SUCCESS' AS status FROM nation "
            "UNION ALL SELECT 'raw/bad.csv', 0, 0, 'FAILED'"),
        "bounded_write": (
            _ingested(_CUSTOMER_TEXT, _CUSTOMER_COLS, "raw/customer.csv").replace(
                " FROM (", ", 3 AS files FROM (", 1)),
        "redistribute": (
            "SELECT l_orderkey, count(*) AS rows, 1 AS partitions FROM lineitem GROUP BY 1"),
        "drop_and_reload": _ingested(
            f"SELECT {_txt('r_regionkey')} AS r_regionkey, r_name FROM region",
            ["r_regionkey", "r_name"], "raw/region.csv"),
    }
    return own | (_llm.ORACLES if _llm else {})
