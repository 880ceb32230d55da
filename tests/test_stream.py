"""S4, P2, P3, P5 on Structured Streaming (FIXTURES X11, X15, X16)."""

import os

from quayside.plans import target as tgt
from quayside.plans.load import LoadConfig, run_load
from quayside.streaming.files import run_stream
from quayside.streaming.notifications import run_notifications, stream_messages

TS = "2024-03-01 12:00:00"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_discovery_picks_csv_any_case_and_subfolders(spark, zone, tmp_path):
    root, write = zone
    write("UP.CSV", "id,v\n1,a\n")
    write("n.txt", "id,v\n2,b\n")
    write("sub/c.csv", "id,w\n3,c\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    res = run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"))
    assert sum(r.counts.written for r in res) == 2
    cur = tgt.current(spark, cfg.target)
    assert rows(cur, "id", "v", "w", "source_file") == [
        ("1", "a", None, "raw/UP.CSV"), ("3", None, "c", "raw/sub/c.csv")]


def test_restart_loads_only_new_files(spark, zone, tmp_path):
    root, write = zone
    write("a.csv", "id,v\n1,a\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    ckpt = str(tmp_path / "ckpt")
    first = run_stream(spark, f"{root}/raw", cfg, ckpt)
    again = run_stream(spark, f"{root}/raw", cfg, ckpt)
    assert [r.counts.written for r in first] == [1] and again == []
    write("b.csv", "id,v\n2,b\n")
    third = run_stream(spark, f"{root}/raw", cfg, ckpt)
    assert [r.counts.written for r in third] == [1]
    assert rows(tgt.current(spark, cfg.target), "id") == [("1",), ("2",)]


def test_overwritten_path_is_not_seen_again_by_discovery(spark, zone, tmp_path):
    """The file source remembers paths; notifications load again."""
    root, write = zone
    p = write("same.csv", "id,v\n1,a\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    ckpt = str(tmp_path / "ckpt")
    run_stream(spark, f"{root}/raw", cfg, ckpt)
    write("same.csv", "id,v\n1,b\n2,c\n")
    os.utime(p)
    assert run_stream(spark, f"{root}/raw", cfg, ckpt) == []
    assert rows(tgt.current(spark, cfg.target), "id", "v") == [("1", "a")]


def test_notifications_load_every_event(spark, zone, tmp_path):
    root, write = zone
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    rec = '{"s3":{"bucket":{"name":"b"},"object":{"key":"%s"}}}'
    write("same file.csv", "id,v\n1,a\n")
    (inbox / "m1.json").write_text(
        '{"Records":[%s,%s]}\n{"nothing":1}\n' % (rec % "raw/same+file.csv", rec % "raw/x.txt"))
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    ckpt = str(tmp_path / "ckpt")
    routing = str(tmp_path / "routing")
    res = run_notifications(spark, stream_messages(spark, str(inbox)), cfg, ckpt, root,
                            routing_dir=routing)
    assert [r.counts.written for r in res] == [1]
    statuses = sorted(r["status"] for r in spark.read.parquet(routing).collect())
    assert statuses == ["INVALID", "LOAD", "SKIPPED_FORMAT"]
    write("same file.csv", "id,v\n1,b\n2,c\n")
    (inbox / "m2.json").write_text('{"Records":[%s]}\n' % (rec % "raw/same%20file.csv"))
    res2 = run_notifications(spark, stream_messages(spark, str(inbox)), cfg, ckpt, root)
    assert [r.counts.written for r in res2] == [2]
    assert rows(tgt.current(spark, cfg.target), "id", "v", "source_file") == [
        ("1", "b", "raw/same file.csv"), ("2", "c", "raw/same file.csv")]


def test_stream_result_equals_batch_result(spark, zone, tmp_path):
    root, write = zone
    write("a.csv", "name,city\nann,x\nbob,y\n")
    write("b.csv", "name,city\nann,x\ncid,z\n")
    s_cfg = LoadConfig(target=f"{root}/stream_target", ts=TS)
    run_stream(spark, f"{root}/raw", s_cfg, str(tmp_path / "ckpt"))
    b_cfg = LoadConfig(target=f"{root}/batch_target", ts=TS)
    run_load(spark, [f"{root}/raw/a.csv", f"{root}/raw/b.csv"], b_cfg, root=root)
    cols = ("id", "name", "city")
    assert rows(tgt.current(spark, s_cfg.target), *cols) == \
        rows(tgt.current(spark, b_cfg.target), *cols)
    assert tgt.current(spark, b_cfg.target).count() == 3


def test_replayed_epoch_is_not_loaded_twice(spark, zone, tmp_path):
    """An epoch re-run after a failure before its commit is skipped."""
    root, write = zone
    write("a.csv", "id,v\n1,a\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    ckpt = tmp_path / "ckpt"
    first = run_stream(spark, f"{root}/raw", cfg, str(ckpt))
    assert len(first) == 1 and tgt.batch_ids(spark, cfg.target) == [1]
    # As if the driver died after the load, before committing epoch 0.
    for name in ("0", ".0.crc"):
        (ckpt / "commits" / name).unlink(missing_ok=True)
    replay = run_stream(spark, f"{root}/raw", cfg, str(ckpt))
    assert replay == []
    assert tgt.batch_ids(spark, cfg.target) == [1]
    assert rows(tgt.current(spark, cfg.target), "id", "v") == [("1", "a")]


def test_missing_and_empty_files_in_a_batch(spark, zone, tmp_path):
    root, write = zone
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    rec = '{"s3":{"bucket":{"name":"b"},"object":{"key":"%s"}}}'
    write("full.csv", "id,v\n1,a\n")
    write("empty.csv", "")
    (inbox / "m.json").write_text('{"Records":[%s,%s,%s]}\n' % (
        rec % "raw/full.csv", rec % "raw/empty.csv", rec % "raw/gone.csv"))
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    res = run_notifications(spark, stream_messages(spark, str(inbox)), cfg,
                            str(tmp_path / "ckpt"), root)
    assert [(r.counts.written, r.message) for r in res] == [(1, "1 notified file(s) missing")]
    from quayside.operators.audit import read_audit
    failed = read_audit(spark, cfg.target).where("status = 'FAILED'").collect()
    assert [r["source_file"].endswith("raw/gone.csv") for r in failed] == [True]
    assert rows(tgt.current(spark, cfg.target), "id", "v") == [("1", "a")]


def test_running_stream_picks_up_new_arrivals(spark, zone, tmp_path):
    import time

    from quayside.streaming.files import start_stream

    root, write = zone
    write("first.csv", "id,v\n1,a\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    query, results = start_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"),
                                  available_now=False, processing_time="1 second")
    try:
        deadline = time.time() + 60
        while len(results) < 1 and time.time() < deadline:
            time.sleep(0.5)
        write("second.csv", "id,v\n2,b\n")
        while len(results) < 2 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    assert [r.counts.written for r in results] == [1, 1]
    assert rows(tgt.current(spark, cfg.target), "id", "v") == [("1", "a"), ("2", "b")]


def test_one_load_per_arrival(spark, zone, tmp_path):
    """max_files_per_trigger=1 gives the original's one load per file."""
    root, write = zone
    write("a.csv", "id,v\n1,a\n")
    write("b.csv", "id,v\n2,b\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    res = run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"), max_files_per_trigger=1)
    assert [r.counts.written for r in res] == [1, 1]
    assert tgt.batch_ids(spark, cfg.target) == [1, 2]


def test_backlog_drains_in_bounded_batches(spark, zone, tmp_path):
    root, write = zone
    for i in range(5):
        write(f"f{i}.csv", f"id,v\n{i},x\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    res = run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"), max_files_per_trigger=2)
    assert [r.counts.written for r in res] == [2, 2, 1]
    assert tgt.current(spark, cfg.target).count() == 5


def test_crash_between_write_and_audit_is_replayed_once(spark, zone, tmp_path):
    """Committed but not audited: the replay adds nothing, even where the row
    hash holds the load time."""
    import glob

    root, write = zone
    write("a.csv", "name\nann\nbob\n")
    cfg = LoadConfig(target=f"{root}/target", profile="as_coded")
    ckpt = tmp_path / "ckpt"
    run_stream(spark, f"{root}/raw", cfg, str(ckpt))
    for name in glob.glob(f"{root}/target/_audit/*") + glob.glob(f"{ckpt}/commits/*") + \
            glob.glob(f"{ckpt}/commits/.*"):
        os.remove(name)
    assert run_stream(spark, f"{root}/raw", cfg, str(ckpt)) == []
    assert tgt.current(spark, cfg.target).count() == 2


def test_crash_before_commit_is_replayed(spark, zone, tmp_path):
    root, write = zone
    write("a.csv", "id,v\n1,a\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    ckpt = tmp_path / "ckpt"
    run_stream(spark, f"{root}/raw", cfg, str(ckpt))
    for name in (f"{root}/target/_commits/1.json", f"{root}/target/_commits/.1.json.crc",
                 ckpt / "commits" / "0", ckpt / "commits" / ".0.crc"):
        os.remove(name)
    assert len(run_stream(spark, f"{root}/raw", cfg, str(ckpt))) == 1
    assert rows(tgt.current(spark, cfg.target), "id", "v") == [("1", "a")]


def test_each_file_keeps_its_own_header_rules(spark, zone, tmp_path):
    """Files with and without a key column in one batch load as they do alone."""
    root, write = zone
    write("a.csv", "id,name\n1,ann\n2,bob\n")
    write("b.csv", "name,city\ncid,x\ndee,y\n")
    for n in (None, 1):
        cfg = LoadConfig(target=f"{root}/target{n}", ts=TS)
        run_stream(spark, f"{root}/raw", cfg, str(tmp_path / f"ckpt{n}"), max_files_per_trigger=n)
    alone = LoadConfig(target=f"{root}/alone", ts=TS)
    for name in ("a.csv", "b.csv"):
        run_load(spark, f"{root}/raw/{name}", alone, key=f"raw/{name}")
    want = rows(tgt.current(spark, alone.target), "id", "name", "city", "source_file")
    assert len(want) == 4 and all(r[0] for r in want)
    for n in (None, 1):
        assert sorted(want, key=str) == sorted(
            rows(tgt.current(spark, f"{root}/target{n}"), "id", "name", "city", "source_file"),
            key=str)


def test_the_later_file_wins_whatever_the_batch(spark, zone, tmp_path):
    root, write = zone
    old, new = write("z.csv", "id,v\n1,zzz\n"), write("a.csv", "id,v\n1,aaa\n")
    os.utime(old, (1_700_000_000, 1_700_000_000))
    os.utime(new, (1_700_000_100, 1_700_000_100))
    for n in (None, 1):
        for keep in ("last", "first"):
            cfg = LoadConfig(target=f"{root}/t{n}{keep}", ts=TS, keep=keep)
            run_stream(spark, f"{root}/raw", cfg, str(tmp_path / f"ck{n}{keep}"),
                       max_files_per_trigger=n)
            assert rows(tgt.current(spark, cfg.target), "v") == [("aaa",)]


def test_a_bad_header_fails_alone(spark, zone, tmp_path):
    from quayside.operators.audit import read_audit

    root, write = zone
    write("good.csv", "id,v\n1,a\n")
    write("bad.csv", "id,timestamp\n2,b\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"))
    assert rows(tgt.current(spark, cfg.target), "id", "v") == [("1", "a")]
    audit = [(r["status"], r["source_file"]) for r in read_audit(spark, cfg.target).collect()]
    failed = [x for x in audit if x[0] == "FAILED"]
    assert len(audit) == 2 and len(failed) == 1 and failed[0][1].endswith("bad.csv")
