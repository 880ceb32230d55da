"""Target lifecycle (K1-K5) and load properties (audit identity,
idempotent reload, order independence, observed = recounted)."""

import random

import pytest
from pyspark.sql import functions as F

from quayside.operators.audit import SUCCESS, LoadCounts, AuditMismatchError, read_audit
from quayside.plans import files
from quayside.plans import target as tgt
from quayside.plans.load import LoadConfig, run_load
from quayside.sources.csv import land_csv

TS = "2024-03-01 12:00:00"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_ensure_and_drop(spark, tmp_path):
    t = str(tmp_path / "t")
    assert tgt.ensure_target(spark, t) is True
    assert tgt.ensure_target(spark, t) is False
    assert tgt.current(spark, t).count() == 0
    assert tgt.drop_target(spark, t) is True
    assert tgt.drop_target(spark, t) is False
    assert not files.exists(spark, t)


def test_loads_never_overwrite_each_other(spark, tmp_path):
    t = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    assert [tgt.upsert(df, t), tgt.upsert(df, t)] == [1, 2]
    assert tgt.current(spark, t).count() == 2
    assert tgt.batch_ids(spark, t) == [1, 2]


def test_overlapping_loads_both_count(spark, tmp_path):
    """Two loads that write at the same time, the first to begin ending last."""
    t = str(tmp_path / "t")
    one, two = tgt.new_run(), tgt.new_run()
    tgt.write_run(spark.createDataFrame([("1", "a")], "id string, v string"), t, one)
    tgt.write_run(spark.createDataFrame([("1", "b"), ("2", "b")], "id string, v string"), t, two)
    assert tgt.current(spark, t).count() == 0  # nothing counts before its commit
    assert tgt.commit(spark, t, two) == 1 and tgt.compact(spark, t) == 1
    assert tgt.commit(spark, t, one) == 2
    assert rows(tgt.current(spark, t), "id", "v") == [("1", "a"), ("2", "b")]


def test_commit_numbers_are_taken_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    t = str(tmp_path / "t")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: tgt.commit(spark, t, tgt.new_run(), rows=False), range(24)))
    assert sorted(got) == list(range(1, 25))


def test_failed_load_leaves_the_others(spark, zone):
    root, write = zone
    cfg = LoadConfig(target=f"{root}/t", ts=TS)
    run_load(spark, write("a.csv", "id,v\n1,a\n"), cfg, key="raw/a.csv")
    with pytest.raises(Exception):
        run_load(spark, write("b.csv", "id,timestamp\n2,b\n"), cfg, key="raw/b.csv")
    assert rows(tgt.current(spark, cfg.target), "id", "v") == [("1", "a")]
    assert len(files.child_dirs(spark, f"{cfg.target}/log")) == 1


def test_another_key_is_refused(spark, tmp_path):
    t = str(tmp_path / "t")
    tgt.ensure_target(spark, t, "id")
    with pytest.raises(tgt.KeyMismatchError):
        tgt.ensure_target(spark, t, "other")


def test_write_partitions_bound_the_write_alone(spark, tmp_path):
    t = str(tmp_path / "t")
    df = spark.range(1000, numPartitions=8).select(F.col("id").cast("string").alias("id"))
    path = tgt.write_run(df.distinct(), t, tgt.new_run(), write_partitions=2)
    assert len([n for n in files.child_files(spark, path) if n.endswith(".parquet")]) == 2


def test_compaction_and_later_loads(spark, tmp_path):
    t = str(tmp_path / "t")
    tgt.upsert(spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string"), t)
    tgt.upsert(spark.createDataFrame([("2", "c")], "id string, v string"), t)
    before = rows(tgt.current(spark, t), "id", "v")
    assert tgt.compact(spark, t) == 2
    assert tgt.snapshot_version(spark, t) == 2
    assert rows(tgt.current(spark, t), "id", "v") == before == [("1", "a"), ("2", "c")]
    tgt.upsert(spark.createDataFrame([("1", "z", "new")], "id string, v string, w string"), t)
    assert rows(tgt.current(spark, t), "id", "v", "w") == [("1", "z", "new"), ("2", "c", None)]


def test_counts_must_add_up():
    LoadCounts(10, 2, 3, 5).check()
    with pytest.raises(AuditMismatchError):
        LoadCounts(10, 2, 3, 4).check()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_audit_identity_and_recount(spark, tmp_path, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice([None, "", *map(str, range(40))]), str(rnd.randrange(5)))
            for _ in range(300)]
    df = spark.createDataFrame(data, "id string, v string")
    zone = str(tmp_path)
    raw = land_csv(df, f"{zone}/raw", "r.csv")
    r = run_load(spark, raw, LoadConfig(target=f"{zone}/t", ts=TS), key="raw/r.csv")
    ids = [d[0] for d in data]
    nonnull = [i for i in ids if i]  # empty text reads as null
    expect = LoadCounts(len(ids), len(ids) - len(nonnull), len(nonnull) - len(set(nonnull)),
                        len(set(nonnull)))
    assert r.counts == expect
    assert tgt.current(spark, f"{zone}/t").count() == expect.written
    a = read_audit(spark, f"{zone}/t").first()
    assert (a.read, a.null_rejected, a.duplicates, a.written, a.status) == \
        (expect.read, expect.null_rejected, expect.duplicates, expect.written, SUCCESS)


def test_content_reload_is_idempotent(spark, tmp_path):
    zone = str(tmp_path)
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    raw = land_csv(df, f"{zone}/raw", "c.csv", double_format="decimal(18,2)")
    cfg = LoadConfig(target=f"{zone}/t", ts=TS)
    run_load(spark, raw, cfg, key="raw/c.csv")
    first = rows(tgt.current(spark, cfg.target), "id", "c_name")
    run_load(spark, raw, cfg.with_(ts="2024-04-01 00:00:00"), key="raw/c.csv")
    assert rows(tgt.current(spark, cfg.target), "id", "c_name") == first
    assert tgt.current(spark, cfg.target).select(F.max("timestamp")).first()[0] == \
        "2024-04-01 00:00:00"


def test_permuted_input_same_result(spark, tmp_path):
    zone = str(tmp_path)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("user_id").cast("string").alias("id"), "event_id", "event_type")
    a = land_csv(ev.orderBy("event_id"), f"{zone}/raw", "a.csv")
    b = land_csv(ev.orderBy(F.desc("event_id")).repartition(3), f"{zone}/raw", "b.csv")
    cfg_a = LoadConfig(target=f"{zone}/ta", ts=TS)
    cfg_b = LoadConfig(target=f"{zone}/tb", ts=TS)
    run_load(spark, a, cfg_a, key="raw/x.csv")
    run_load(spark, b, cfg_b, key="raw/x.csv")
    cols = ("id", "event_id", "event_type")
    assert rows(tgt.current(spark, cfg_a.target), *cols) == \
        rows(tgt.current(spark, cfg_b.target), *cols)


@pytest.mark.parametrize("bad", [dict(target=""), dict(target="t", profile="x"),
                                 dict(target="t", keep="middle"),
                                 dict(target="t", on_collision="ignore"),
                                 dict(target="t", write_partitions=0)])
def test_config_refuses_bad_settings(bad):
    with pytest.raises(ValueError):
        LoadConfig(**bad)


def test_compact_every(spark, zone):
    root, write = zone
    cfg = LoadConfig(target=f"{root}/t", ts=TS, compact_every=2)
    for i in range(3):
        p = write(f"f{i}.csv", f"id,v\n{i},a\n1,v{i}\n")
        run_load(spark, p, cfg, key=f"raw/f{i}.csv")
    assert tgt.snapshot_version(spark, cfg.target) == 2
    assert rows(tgt.current(spark, cfg.target), "id", "v") == \
        [("0", "a"), ("1", "v2"), ("2", "a")]


def test_compaction_rewrites_only_touched_buckets(spark, tmp_path):
    t = str(tmp_path / "t")
    base = spark.range(200).select(F.col("id").cast("string").alias("id"),
                                   F.lit("a").alias("v"))
    tgt.upsert(base, t)
    assert tgt.compact(spark, t, buckets=8) == 1
    first = tgt._manifest(spark, t)["live"]
    assert len(first) == 8
    tgt.upsert(spark.createDataFrame([("7", "b")], "id string, v string"), t)
    plan = tgt.current(spark, t)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan  # seven buckets pass by the join
    assert tgt.compact(spark, t) == 2
    second = tgt._manifest(spark, t)["live"]
    assert sum(first[b] != second[b] for b in first) == 1  # one bucket rewritten
    cur = tgt.current(spark, t)
    assert cur.count() == 200
    assert cur.where("v = 'b'").select("id").collect() == [("7",)]


def test_untouched_buckets_are_not_shuffled(spark, tmp_path):
    t = str(tmp_path / "t")
    base = spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("v"))
    tgt.upsert(base, t)
    tgt.compact(spark, t, buckets=16)
    tgt.upsert(spark.createDataFrame([("7", "b")], "id string, v string"), t)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        cur = tgt.current(spark, t)
        cur.collect()
        plan = cur._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The join's two sides are shuffled; the other branch is a bare scan.
    assert plan.count("Exchange hashpartitioning") <= 4 and cur.count() == 400
    last = plan.split("Union")[1].split("\n")
    scans = [i for i, x in enumerate(last) if "FileScan" in x]
    shuffles = [i for i, x in enumerate(last) if "Exchange" in x]
    assert scans[0] < min(shuffles)


def test_buckets_grow_with_the_table(spark, tmp_path, monkeypatch):
    t = str(tmp_path / "t")
    monkeypatch.setattr(tgt, "BUCKET_TARGET_BYTES", 1000)
    tgt.upsert(spark.createDataFrame([("1", "a")], "id string, v string"), t)
    assert tgt.compact(spark, t) == 1
    few = tgt._manifest(spark, t)["buckets"]
    many = spark.range(5000).select(F.col("id").cast("string").alias("id"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("v"))
    tgt.upsert(many, t)
    before = rows(tgt.current(spark, t), "id", "v")
    assert tgt.compact(spark, t) == 2
    manifest = tgt._manifest(spark, t)
    assert manifest["buckets"] >= 64 > few
    assert all(x[1] < 20 * tgt.BUCKET_TARGET_BYTES for x in manifest["live"].values())
    assert rows(tgt.current(spark, t), "id", "v") == before


def test_unfinished_compaction_is_invisible(spark, tmp_path):
    t = str(tmp_path / "t")
    tgt.upsert(spark.createDataFrame([("1", "a")], "id string, v string"), t)
    tgt.compact(spark, t)
    tgt.upsert(spark.createDataFrame([("1", "b")], "id string, v string"), t)
    # A snapshot folder written, its record not: as if a compaction died.
    spark.createDataFrame([("1", "zzz")], "id string, v string").write \
        .parquet(f"{t}/snapshot/_run=dead/_bucket=0")
    assert [tuple(r) for r in tgt.current(spark, t).collect()] == [("1", "b")]
    assert tgt.compact(spark, t) == 2
    assert [tuple(r) for r in tgt.current(spark, t).collect()] == [("1", "b")]


def test_layout_columns_are_reserved(spark, tmp_path):
    df = spark.createDataFrame([("1", 1)], "id string, _bucket int")
    with pytest.raises(ValueError):
        tgt.upsert(df, str(tmp_path / "t"))


def test_stage_counts_derive_from_the_audit():
    c = LoadCounts(read=10, null_rejected=2, duplicates=3, written=5).check()
    assert (c.after_null_filter, c.after_dedup, c.ready, c.mapped) == (8, 5, 5, 5)


def test_bucket_count_follows_table_size():
    assert tgt.choose_buckets(0) == 1
    assert tgt.choose_buckets(tgt.BUCKET_TARGET_BYTES) == 1
    assert tgt.choose_buckets(10 * tgt.BUCKET_TARGET_BYTES) == 16
    assert tgt.choose_buckets(100 * 2 ** 40) == tgt.MAX_BUCKETS


def keyed_table(spark, t, n=400, buckets=16):
    base = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("v"))
    tgt.upsert(base, t)
    tgt.compact(spark, t, buckets=buckets)


def test_read_keys_reads_only_their_buckets(spark, tmp_path):
    t = str(tmp_path / "t")
    keyed_table(spark, t)
    got = tgt.read_keys(spark, t, ["7", "13", "absent", None])
    assert rows(got, "id", "v") == [("13", "a"), ("7", "a")]
    folders = {f.split("_bucket=")[1].split("/")[0] for f in got.inputFiles()}
    assert 1 <= len(folders) <= 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(id" in plan and "Exchange" not in plan


def test_read_keys_of_a_frame_and_of_newer_loads(spark, tmp_path):
    t = str(tmp_path / "t")
    keyed_table(spark, t)
    newer = [("7", "b", "x"), ("900", "b", None)]
    tgt.upsert(spark.createDataFrame(newer, "id string, v string, w string"), t)
    tgt.upsert(spark.createDataFrame([("7", "c")], "id string, v string"), t)
    asked = spark.createDataFrame([(k, 1) for k in ("7", "900", "8", "7", None)],
                                  "id string, n int")
    for keys in (asked, ["7", "900", "8", "7"]):
        assert rows(tgt.read_keys(spark, t, keys), "id", "v") == [
            ("7", "c"), ("8", "a"), ("900", "b")]
    everything = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    assert rows(tgt.read_keys(spark, t, everything), "id", "v") == rows(
        tgt.current(spark, t), "id", "v")


def test_read_keys_of_nothing(spark, tmp_path):
    t = str(tmp_path / "t")
    assert tgt.read_keys(spark, t, ["1"]).count() == 0
    tgt.upsert(spark.createDataFrame([("1", "a")], "id string, v string"), t)
    assert tgt.read_keys(spark, t, []).count() == 0
    tgt.compact(spark, t)
    assert tgt.read_keys(spark, t, []).columns == ["id", "v"]
    assert tgt.read_keys(spark, t, ["2"]).count() == 0


def test_snapshot_files_have_bloom_filters_on_the_key(spark, tmp_path):
    t = str(tmp_path / "t")
    keyed_table(spark, t, buckets=1)
    base = spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("v"))
    base.coalesce(1).write.parquet(str(tmp_path / "plain"))

    def filter_bytes(folder):
        import pathlib
        return sum(p.stat().st_size for p in pathlib.Path(folder).rglob("*.parquet"))

    assert filter_bytes(f"{t}/snapshot") > filter_bytes(tmp_path / "plain") + 300
