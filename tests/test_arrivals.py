"""A3 per arrived file, and A4 for files that can't be read among files that can."""

import os

import pytest

from quayside.operators.audit import (AuditMismatchError, FileCounts, LoadCounts, file_counts,
                                      read_audit, read_file_audit)
from quayside.plans import target as tgt
from quayside.plans.load import LoadConfig, run_load
from quayside.plans.quarantine import is_read_error, reason, unreadable
from quayside.streaming.files import run_stream
from quayside.streaming.notifications import run_notifications, stream_messages
from quayside.streaming.progress import LiveCounts

TS = "2024-03-01 12:00:00"
TOO_WIDE = "id,v\n1,x\n2" + "," * 25_000 + "\n"


def audit_rows(spark, target, *columns):
    columns = columns or ("source_file", "read", "null_rejected", "duplicates", "written",
                          "malformed", "status")
    return sorted(tuple(r) for r in read_file_audit(spark, target).select(*columns).collect())


def test_counts_per_file_add_up_to_the_batch(spark, zone, tmp_path):
    root, write = zone
    first = write("a b.csv", "id,v\n1,x\n1,y\n2,z\n,none\n")
    write("sub/+.csv", "id,v\n2,later\n3,w,too many\n,no\n,no\n")
    write("names.csv", "name\nann\nann\nbob\n")
    write("only header.csv", "id,v\n")
    write("nothing.csv", "")  # Spark's scans, discovery among them, pass files of no bytes over
    os.utime(first, (1_000_000, 1_000_000))
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    [result] = run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"))
    assert audit_rows(spark, cfg.target) == [
        ("raw/a b.csv", 4, 1, 2, 1, 0, "SUCCESS"), ("raw/names.csv", 3, 0, 1, 2, 0, "SUCCESS"),
        ("raw/only header.csv", 0, 0, 0, 0, 0, "EMPTY"),
        ("raw/sub/+.csv", 4, 2, 0, 2, 1, "SUCCESS")]
    assert result.counts == LoadCounts(11, 3, 3, 5, 1)
    # The batch's own record stays one row.
    assert [r["written"] for r in read_audit(spark, cfg.target).collect()] == [5]


def test_a_batch_of_empty_files_is_recorded_once(spark, zone, tmp_path):
    root, write = zone
    write("none.csv", "id,v\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    [result] = run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"))
    assert result.status == "EMPTY"
    assert audit_rows(spark, cfg.target, "source_file", "status") == [("raw/none.csv", "EMPTY")]
    assert run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt")) == []


def test_no_file_audit_for_loads_of_a_key(spark, zone):
    root, write = zone
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    run_load(spark, write("a.csv", "id\n1\n"), cfg, key="raw/a.csv")
    assert read_file_audit(spark, cfg.target).count() == 0


def test_a_mapping_without_the_file_column_still_loads(spark, zone, tmp_path):
    root, write = zone
    write("a.csv", "id,v\n1,x\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS,
                     mappings=(("id", "string", "id", "string"), ("v", "string", "w", "string")))
    [result] = run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"))
    assert result.counts.written == 1
    assert read_file_audit(spark, cfg.target).count() == 0


def test_file_counts_must_add_up():
    files = [{"source_file": "f", "read": 3, "null_rejected": 1, "malformed": 0}]
    assert file_counts(files, {"f": 1}, LoadCounts(3, 1, 1, 1)) == [
        FileCounts("f", LoadCounts(3, 1, 1, 1))]
    for written, total in (({"f": 3}, LoadCounts(3, 1, 0, 2)), ({"f": 1}, LoadCounts(4, 1, 2, 1))):
        with pytest.raises(AuditMismatchError):
            file_counts(files, written, total)


@pytest.mark.parametrize("bad", [[], ["f3"], ["f0", "f6"], [f"f{i}" for i in range(7)]])
def test_unreadable_finds_the_files_that_fail(bad):
    asked = []

    def read(paths):
        asked.append(list(paths))
        for p in paths:
            if p in bad:
                raise RuntimeError(f"job failed: [FAILED_READ_FILE.NO_HINT] file {p}\nmore")

    found = unreadable([f"f{i}" for i in range(7)], read)
    assert found == {p: f"FAILED_READ_FILE.NO_HINT] file {p}" for p in bad}
    assert len(asked) <= 1 + 6 * max(len(bad), 1)
    assert unreadable([], read) == {}


def test_other_errors_are_not_quarantined():
    def read(paths):
        raise ValueError("something else")

    with pytest.raises(ValueError):
        unreadable(["a", "b"], read)
    assert not is_read_error(ValueError("x")) and reason(ValueError("x\ny")) == "x"


def test_a_broken_file_stops_no_other(spark, zone, tmp_path):
    root, write = zone
    write("bad.csv", TOO_WIDE)
    for i in range(4):
        write(f"good{i}.csv", f"id,v\n{i},x\n{i + 1},y\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    [result] = run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"))
    assert result.counts.read == 8 and result.counts.written == 5
    assert sorted(r["id"] for r in tgt.current(spark, cfg.target).collect()) == list("01234")
    states = audit_rows(spark, cfg.target, "source_file", "status")
    assert states == [("raw/bad.csv", "FAILED")] + [
        (f"raw/good{i}.csv", "SUCCESS") for i in range(4)]
    failed = read_audit(spark, cfg.target).where("status = 'FAILED'").collect()
    assert len(failed) == 1 and "FAILED_READ_FILE" in failed[0]["message"]


def test_only_broken_files_and_their_replay(spark, zone, tmp_path):
    """The epoch is done with: run again, it refuses nothing twice."""
    root, write = zone
    write("bad.csv", TOO_WIDE)
    write("worse.csv", TOO_WIDE)
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    ckpt = tmp_path / "ckpt"
    for _ in range(2):
        assert run_stream(spark, f"{root}/raw", cfg, str(ckpt)) == []
        assert audit_rows(spark, cfg.target, "source_file", "status") == [
            ("raw/bad.csv", "FAILED"), ("raw/worse.csv", "FAILED")]
        for name in ("0", ".0.crc"):
            (ckpt / "commits" / name).unlink(missing_ok=True)
    write("good.csv", "id,v\n1,x\n")
    [result] = run_stream(spark, f"{root}/raw", cfg, str(ckpt))
    assert result.counts.written == 1


def test_broken_files_in_the_split_scan(spark, zone, tmp_path):
    root, write = zone
    write("bad.csv", TOO_WIDE)
    write("good.csv", 'id,v\n7,"x\ny"\n')
    cfg = LoadConfig(target=f"{root}/target", ts=TS, split_over=0)
    [result] = run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "ckpt"))
    assert result.counts.written == 1
    assert audit_rows(spark, cfg.target, "source_file", "status") == [
        ("raw/bad.csv", "FAILED"), ("raw/good.csv", "SUCCESS")]


def test_notified_files_have_a_row_each(spark, zone, tmp_path):
    root, write = zone
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    write("a.csv", "id,v\n1,x\n")
    write("bad.csv", TOO_WIDE)
    rec = '{"s3":{"bucket":{"name":"b"},"object":{"key":"raw/%s.csv"}}}'
    (inbox / "m.json").write_text('{"Records":[%s]}\n' % ",".join(
        rec % n for n in ("a", "bad", "gone")))
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    run_notifications(spark, stream_messages(spark, str(inbox)), cfg, str(tmp_path / "c"), root)
    assert audit_rows(spark, cfg.target, "source_file", "status") == [
        ("raw/a.csv", "SUCCESS"), ("raw/bad.csv", "FAILED"), ("raw/gone.csv", "FAILED")]


def put(inbox, name, *events):
    rec = ('{"eventTime":"%s","s3":{"bucket":{"name":"b"},"object":{"key":"raw/%s"}}}')
    (inbox / name).write_text('{"Records":[%s]}\n' % ",".join(rec % (t, k) for k, t in events))


def test_redelivered_events_load_once(spark, zone, tmp_path):
    root, write = zone
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    cfg = LoadConfig(target=f"{root}/target", ts=TS)

    def run():
        return [r.counts.written for r in run_notifications(
            spark, stream_messages(spark, str(inbox)), cfg, str(tmp_path / "c"), root,
            routing_dir=str(tmp_path / "routing"))]

    write("a.csv", "id,v\n1,x\n")
    put(inbox, "1.json", ("a.csv", "2024-01-01T10:00:00.000Z"))
    put(inbox, "2.json", ("a.csv", "2024-01-01T10:00:00.000Z"))
    assert run() == [1]
    put(inbox, "3.json", ("a.csv", "2024-01-01T10:00:00Z"))  # delivered again
    assert run() == []
    write("a.csv", "id,v\n1,y\n2,z\n")
    # Put again twice, and an older event that comes late: the file is loaded once.
    put(inbox, "4.json", ("a.csv", "2024-01-01T12:00:00Z"), ("a.csv", "2024-01-01T11:00:00Z"))
    assert run() == [2]
    assert audit_rows(spark, cfg.target, "source_file", "status", "written") == [
        ("raw/a.csv", "SUCCESS", 1), ("raw/a.csv", "SUCCESS", 2), ("raw/a.csv", "SUPERSEDED", 0)]
    assert sorted((r["id"], r["v"]) for r in tgt.current(spark, cfg.target).collect()) == [
        ("1", "y"), ("2", "z")]
    assert spark.read.parquet(str(tmp_path / "routing")).count() == 3


def test_events_without_a_time_are_never_redeliveries(spark, zone, tmp_path):
    root, write = zone
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    write("a.csv", "id,v\n1,x\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    for i, time in enumerate(("", "no time")):
        put(inbox, f"{i}.json", ("a.csv", time), ("b.txt", time))
        loads = run_notifications(spark, stream_messages(spark, str(inbox)), cfg,
                                  str(tmp_path / "c"), root)
        assert [r.counts.written for r in loads] == [1]


def test_live_counts_add_up_to_the_audit(spark, zone, tmp_path):
    root, write = zone
    for i in range(3):
        write(f"f{i}.csv", f"id,v\n{i},x\n{i},y\n,no\n1,z\n")
    cfg = LoadConfig(target=f"{root}/target", ts=TS)
    seen = []
    live = LiveCounts(spark, on_row=seen.append, keep=2)
    try:
        run_stream(spark, f"{root}/raw", cfg, str(tmp_path / "c"), max_files_per_trigger=1,
                   live=live)
        # Another query's progress isn't counted.
        run_stream(spark, f"{root}/raw", cfg.with_(target=f"{root}/other"), str(tmp_path / "d"))
    finally:
        live.close()
    rows = [r for r in seen if r["files"]]
    assert [r["files"] for r in rows] == [1, 1, 1] and len(live.rows) == 2
    audit = read_audit(spark, cfg.target).collect()
    for name in ("read", "null_rejected", "duplicates", "written", "malformed"):
        assert sum(r[name] for r in rows) == sum(a[name] for a in audit) == live.totals[name]
    assert live.totals["bytes"] == sum(os.path.getsize(f"{root}/raw/f{i}.csv") for i in range(3))
    assert live.frame().count() == 2
