"""S1 over large quoted files: split scan against the one-task read, and header discovery."""

import random
import uuid

import pytest

from quayside.plans import target as tgt
from quayside.plans.load import LoadConfig, run_load
from quayside.sources import csv as csvmod
from quayside.sources import split_scan as ss
from quayside.sources.lines import Quoting, first_records

OPTIONS = {"escape": '"', "multi_line": True}
LINES = [  # line, state at its start, state at its end
    (b"a,b", False, False), (b'"a', False, True), (b'a"b,c', False, False),
    (b'a,"b""c', False, True), (b'a,"b"",c', False, True), (b'"a","b', False, True),
    (b'x"', True, False), (b'x""', True, True), (b'x","y', True, True), (b'"a"b"c,d', False, False),
    (b'5",6', False, False), (b'"""', False, True), (b'""', False, False), (b"", True, True)]


@pytest.mark.parametrize("line, inside, after", LINES)
def test_quoting(line, inside, after):
    assert Quoting(",", '"').inside_after(line, inside) is after


def random_csv(seed, rows=300):
    rng = random.Random(seed)
    end = rng.choice(["\n", "\n", "\r\n"])

    def field():
        kind = rng.random()
        if kind < 0.35:
            return "".join(rng.choices("abcé 1", k=rng.randint(0, 6)))
        if seed % 3 == 0 and kind < 0.45:  # quotes where they shouldn't be
            return rng.choice(['5"', 'a"b', '"x"y', '"x" ', '"p"q"r', '""z'])
        body = rng.choices(["x", "y", ",", '""', "\n", " ", "\r\n", "é"], k=rng.randint(0, 14))
        return '"' + "".join(body) + '"'

    lines = ["a," + ('b "q"' if seed % 3 == 0 else "b") + rng.choice([",c", ',"c\nd"'])]
    for _ in range(rng.randint(0, rows)):
        lines.append(",".join(field() for _ in range(
            3 if rng.random() < 0.95 else rng.randint(1, 5))))
        if rng.random() < 0.05:
            lines.append("")
    return end.join(lines) + (end if rng.random() < 0.5 else "")


def both(spark, path, split_bytes, **more):
    """Rows of the one-task read and of the split scan, with a flag for ragged ones."""
    schema = csvmod.with_ragged(csvmod.read_csv(spark, path, **OPTIONS).schema)
    one = csvmod.csv_reader(spark, schema=schema, **OPTIONS).option(
        "columnNameOfCorruptRecord", csvmod.RAGGED_COLUMN).load(path)
    split, left = ss.split_scan(spark, [path], schema, OPTIONS, csvmod.RAGGED_COLUMN, "f", "t",
                                split_bytes=split_bytes, **more)

    def rows(df):
        return sorted(((*r[:-1], r[-1] is not None) for r in df.collect()), key=repr)

    columns = [f"`{c}`" for c in one.columns]
    return rows(one), None if split is None else rows(split.select(*columns)), left


@pytest.mark.parametrize("seed", range(8))
def test_equals_the_one_task_read(spark, zone, seed):
    _root, write = zone
    path = write(f"r {seed}%.csv", random_csv(seed))
    one, split, left = both(spark, path, random.Random(seed).choice([400, 1500, 6000]))
    assert split == one or (split is None and left)


def test_a_large_file_is_read_by_many_tasks(spark, zone):
    _root, write = zone
    body = "".join(f'{i},"line {i}\nnext ""{i}"", and more",{i % 7}\n' for i in range(20_000))
    path = write("large.csv", "id,v,w\n" + body)
    schema = csvmod.with_ragged(csvmod.read_csv(spark, path).schema)
    scan, left = ss.split_scan(spark, [path], schema, OPTIONS, csvmod.RAGGED_COLUMN, "f", "t",
                               split_bytes=50_000)
    assert left == [] and scan.rdd.getNumPartitions() > 10
    assert scan.count() == 20_000
    got = {r["id"]: r["v"] for r in scan.where("w = 3").collect()}
    assert got["10"] == 'line 10\nnext "10", and more'
    assert scan.where(f"{csvmod.RAGGED_COLUMN} IS NOT NULL").count() == 0


@pytest.mark.parametrize("text", [
    "a,b\r1,2\r3,4\r",                            # carriage returns alone
    'a,b\n1,"' + "long " * 3000 + '"\n2,x\n',     # a record longer than a kept piece
    'a,b\n1,x\n2,"open to the end\nof the file',  # ends inside a field
    "﻿a,b\n1,x\n", '"' + "h" * 3000 + '\nx",b\n1,2\n'])
def test_files_left_to_one_task(spark, zone, text):
    _root, write = zone
    path = write("odd.csv", text)
    one, split, left = both(spark, path, 800, limit=2000)
    assert (split is None and len(left) == 1) or split == one
    rows = [r for df, _ in csvmod.scan_groups(spark, [path], **OPTIONS) for r in df.collect()]
    assert len(rows) == len(one)


def test_options_that_move_borders_are_not_split():
    assert ss.can_split(OPTIONS) and ss.can_split({"sep": ";"})
    for options in ({"escape": "\\"}, {"multi_line": False}, {"sep": "||"}, {"mode": "FAILFAST"},
                    {"quote": "é", "escape": "é"}):
        assert not ss.can_split(options)


def test_load_through_the_split_scan(spark, zone, monkeypatch):
    root, write = zone
    text = "id,v\n" + "".join(f'{i % 900},"x\n{i}"\n' for i in range(1000))
    write("big.csv", text)
    write("small.csv", "id,v\n5000,y\n")
    plain = LoadConfig(target=f"{root}/plain", ts="2024-01-01 00:00:00", order_by=("v",))
    want = run_load(spark, f"{root}/raw", plain).counts
    monkeypatch.setattr(csvmod, "SPLIT_BYTES", 2000)
    split = plain.with_(target=f"{root}/split")
    assert run_load(spark, f"{root}/raw", split, root=root).counts == want
    rows = [sorted(tuple(r) for r in tgt.current(spark, c.target).select("id", "v").collect())
            for c in (plain, split)]
    assert rows[0] == rows[1] and len(rows[0]) == 901
    assert {r[0] for r in tgt.current(spark, split.target).select("source_file").collect()} == {
        "raw/big.csv", "raw/small.csv"}


def jobs_of(spark, action):
    sc, group = spark.sparkContext, f"counted-{uuid.uuid4().hex}"
    sc.setJobGroup(group, group)
    try:
        action()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_header_jobs_do_not_follow_the_files(spark, zone):
    _root, write = zone
    counts = []
    for n in (40, 120):  # both beyond the number from which Spark lists files in a job
        paths = [write(f"{n}/f{i}.csv", f'id,"v\n{n}"\n{i},x\n') for i in range(n)]
        sizes = {p: 20 for p in paths}
        counts.append(jobs_of(spark, lambda: csvmod.header_groups(spark, paths, sizes, **OPTIONS)))
    assert counts[0] == counts[1] <= 3


def test_first_records_of_large_and_small_files(spark, zone, monkeypatch):
    _root, write = zone
    texts = {"a.csv": "\n\r\nid,v\r\n1,2\r\n", "b.csv": "", "c.csv": "﻿x,y\n",
             "d [1].csv": '"a\nb",c\n1,2', "e.csv": '"open\nto the end', "f.csv": "\n\n"}
    sizes = {write(name, t): 10 for name, t in texts.items()}
    want = {"a.csv": "id,v", "c.csv": "x,y", "d%20%5B1%5D.csv": '"a\nb",c',
            "e.csv": '"open\nto the end'}
    for bound in (100, 5):
        monkeypatch.setattr("quayside.sources.lines.ALONE_BYTES", bound)
        found = first_records(spark, sizes, ",", '"')
        assert {p.rsplit("/", 1)[1]: r for p, r in found.items()} == want


def test_splits_have_a_size_at_most_whatever_the_session_says(spark, tmp_path, monkeypatch):
    p = tmp_path / "a.csv"
    p.write_text("id,v\n" + "".join(f"{i},x\n" for i in range(40_000)))
    schema = csvmod.with_ragged(csvmod.read_csv(spark, str(p), **OPTIONS).schema)

    def scan():
        found, left = ss.split_scan(spark, [str(p)], schema, OPTIONS, csvmod.RAGGED_COLUMN, "f", "t")
        assert left == []
        return found

    few = scan().rdd.getNumPartitions()
    monkeypatch.setattr(ss, "MOST_SPLIT_BYTES", 20_000)
    many = scan()
    assert many.rdd.getNumPartitions() > few + 5 and many.count() == 40_000
