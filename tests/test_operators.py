"""Operators one by one, on in-line rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quayside.functions.hashing import hash_columns, row_hash
from quayside.functions.paths import check_format, decode_key, extension, is_csv, uri_path
from quayside.operators.audit import count_load
from quayside.operators.columns import (ColumnCollisionError, add_metadata, apply_mapping,
                                        ensure_id, schema_profile)
from quayside.operators.quality import dedup, redistribute, require_not_null
from quayside.plans import target as tgt
from quayside.sources.csv import inventory, land_csv, read_csv
from quayside.sources.notify import route_notifications

TS = "2024-03-01 12:00:00"


def md5(s):
    return "record-" + hashlib.md5(s.encode()).hexdigest()


def test_as_coded_hash_matches_plain_concat(spark):
    df = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    got = df.select(row_hash(["x", "y", "z"], "as_coded")).first()[0]
    assert got == md5("a_b")  # null skipped, as concat_ws does


def test_content_hash_encodes_nulls_and_separators(spark):
    df = spark.createDataFrame([("a_b", "c", None), ("a", "b_c", None), ("a\\", None, "x")],
                               "x string, y string, z string")
    got = [r[0] for r in df.select(row_hash(["x", "y", "z"], "content")).collect()]
    assert got == [md5("a\\_b_c_\\N"), md5("a_b\\_c_\\N"), md5("a\\\\_\\N_x")]
    assert len(set(got)) == 3


def test_hash_columns_by_profile(spark):
    df = spark.createDataFrame([("1", "2", "3", "4")],
                               "a string, `b.c` string, ingestion_timestamp string, source_file string")
    assert hash_columns(df, "as_coded") == ["a", "ingestion_timestamp", "source_file"]
    assert hash_columns(df, "content") == ["a", "b.c"]
    with pytest.raises(ValueError):
        hash_columns(df, "other")


def test_as_coded_time_and_file_enter_the_hash(spark):
    """As coded, the same row loaded twice gets two ids; content gets one."""
    df = spark.createDataFrame([("x",)], "a string")
    one = ensure_id(add_metadata(df, "raw/a.csv", "2024-01-01 00:00:00"), "as_coded")
    two = ensure_id(add_metadata(df, "raw/a.csv", "2024-01-02 00:00:00"), "as_coded")
    assert one.first()["id"] != two.first()["id"]
    assert one.first()["id"] == md5("x_2024-01-01 00:00:00_raw/a.csv")
    c1 = ensure_id(add_metadata(df, "raw/a.csv", "2024-01-01 00:00:00"), "content")
    c2 = ensure_id(add_metadata(df, "raw/b.csv", "2024-01-02 00:00:00"), "content")
    assert c1.first()["id"] == c2.first()["id"] == md5("x")


def test_metadata_per_row_source(spark, zone):
    root, write = zone
    write("a.csv", "x\n1\n")
    write("sub/b c+d.csv", "x\n2\n")
    df = read_csv(spark, f"{root}/raw", recursive=True)
    got = sorted(tuple(r) for r in add_metadata(df, None, TS, root=root)
                 .select("x", "source_file").collect())
    assert got == [("1", "raw/a.csv"), ("2", "raw/sub/b c+d.csv")]


def test_collision_policies(spark):
    df = spark.createDataFrame([("1", "t")], "a string, Timestamp string")
    with pytest.raises(ColumnCollisionError):
        add_metadata(df, "k", TS)
    assert add_metadata(df, "k", TS, on_collision="suffix").columns == \
        ["a", "Timestamp_source", "ingestion_timestamp", "source_file"]
    assert add_metadata(df, "k", TS, on_collision="overwrite").columns == \
        ["a", "ingestion_timestamp", "source_file"]


def test_mapping_default_and_explicit(spark):
    df = add_metadata(spark.createDataFrame([("1", "v")], "id string, `a.b` string"), "k", TS)
    out = apply_mapping(df)
    assert out.columns == ["id", "timestamp", "source_file", "a.b"]
    assert tuple(out.first()) == ("1", TS, "k", "v")
    custom = apply_mapping(df, [("a.b", "string", "ab", "string"), ("gone", "string", "g", "string")])
    assert custom.columns == ["ab"]
    with pytest.raises(ColumnCollisionError):
        apply_mapping(df, [("id", "string", "x", "string"), ("a.b", "string", "x", "string")])


def test_schema_profile(spark):
    df = spark.createDataFrame([(1, "a")], "n long, s string")
    assert [tuple(r) for r in schema_profile(df).collect()] == [(1, "n", "bigint", True),
                                                                 (2, "s", "string", True)]


def test_require_not_null(spark):
    df = spark.createDataFrame([("1", "a"), (None, "b"), ("3", None)], "id string, v string")
    kept, rejected = require_not_null(df, ["ID", "missing"])
    assert kept.count() == 2 and rejected.count() == 1
    kept2, rejected2 = require_not_null(df, ["id", "v"])
    assert kept2.count() == 1 and rejected2.count() == 2


def test_dedup_survivor_ignores_input_order(spark):
    data = [("k", 1, "a"), ("k", 3, "b"), ("k", 3, "c"), ("j", 2, "d")]
    df = spark.createDataFrame(data, "k string, o int, v string")
    rev = spark.createDataFrame(list(reversed(data)), "k string, o int, v string").repartition(3)
    for frame in (df, rev):
        assert sorted(tuple(r) for r in dedup(frame, ["k"], ["o"]).collect()) == \
            [("j", 2, "d"), ("k", 3, "c")]
        assert sorted(tuple(r) for r in dedup(frame, ["k"], ["o"], keep="first").collect()) == \
            [("j", 2, "d"), ("k", 1, "a")]
    assert dedup(df, ["k"]).count() == 2


def test_dedup_plan_has_one_exchange_with_partial_aggregate(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_max" in plan


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key holding most rows reaches the shuffle as one row per task."""
    n = 20000
    df = spark.range(n).select(F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id"))
                               .alias("k"), F.col("id").alias("v")).repartition(4)
    out = dedup(df, ["k"], ["v"])
    assert out.where("k = 0").first()["v"] == max(i for i in range(n) if i % 10 < 7)
    assert out.count() == 1 + n * 3 // 10


def test_count_load(spark):
    df = spark.createDataFrame([("1",), ("1",), (None,), ("2",), (None,)], "k string")
    assert tuple(count_load(df, "k").first()) == (5, 2, 1, 2)


def test_redistribute(spark):
    df = spark.createDataFrame([("1",), ("2",)], "id string")
    assert redistribute(df, 3).rdd.getNumPartitions() == 3


def test_paths(spark):
    assert check_format("raw/a.b.CSV") == "csv"
    df = spark.createDataFrame([("raw/a.b.CSV",), ("raw/x",), ("raw/y.txt",)], "k string")
    assert [tuple(r) for r in df.select(extension(F.col("k")), is_csv(F.col("k"))).collect()] == \
        [("csv", True), ("raw/x", False), ("txt", False)]


def test_decode_key_like_form_decoding(spark):
    from urllib.parse import unquote_plus
    keys = ["raw/a+b%20c.csv", "raw/100%.csv", "raw/%zz+x.csv", "raw/%C3%A9t%C3%A9.csv",
            "raw/plain.csv", "raw/50%+off%2.csv"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(decode_key(F.col("k"))).collect()]
    assert got == [unquote_plus(k) for k in keys]


def test_uri_path(spark):
    df = spark.createDataFrame([("file:/tmp/a%20b+c.csv",), ("s3a://bkt/raw/x.csv",)], "p string")
    assert [r[0] for r in df.select(uri_path(F.col("p"))).collect()] == \
        ["/tmp/a b+c.csv", "/raw/x.csv"]


def test_route_notifications(spark):
    rec = '{"s3":{"bucket":{"name":"bkt"},"object":{"key":"%s"}}}'
    msgs = [
        (1, '{"Records":[%s,%s]}' % (rec % "raw/a+b%20c.csv", rec % "raw/x.txt")),
        (2, '{"Records":[%s]}' % (rec % "raw/100%.CSV")),
        (3, '{"other": 1}'),
        (4, '{"Records": []}'),
        (5, 'not json'),
    ]
    df = spark.createDataFrame(msgs, "m int, body string")
    got = sorted(tuple(r) for r in route_notifications(df).select(
        "m", "record", "bucket", "key", "status").collect())
    assert got == [
        (1, 0, "bkt", "raw/a b c.csv", "LOAD"),
        (1, 1, "bkt", "raw/x.txt", "SKIPPED_FORMAT"),
        (2, 0, "bkt", "raw/100%.CSV", "LOAD"),
        (3, None, None, None, "INVALID"),
        (4, None, None, None, "INVALID"),
        (5, None, None, None, "INVALID"),
    ]


def test_inventory_lists_without_reading(spark, zone):
    root, write = zone
    write("a.csv", "x\n1\n")
    write("b.TXT", "hello")
    write("sub/c.Csv", "x\n")
    got = sorted(tuple(r) for r in inventory(spark, f"{root}/raw", root).select(
        "key", "ext", "bytes", "eligible").collect())
    assert got == [("raw/a.csv", "csv", 4, True), ("raw/b.TXT", "txt", 5, False),
                   ("raw/sub/c.Csv", "csv", 2, True)]
    assert "content" not in inventory(spark, f"{root}/raw", root)._jdf.queryExecution() \
        .executedPlan().toString().split("ReadSchema")[1].split("\n")[0]


def test_land_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'q"uote, and\nbreak', 1.5e7), (2, None, None)],
                               "n long, t string, d double")
    path = land_csv(df, str(tmp_path / "raw"), "t.csv", double_format="decimal(18,2)")
    back = sorted(tuple(r) for r in read_csv(spark, path).collect())
    assert back == [("1", 'q"uote, and\nbreak', "15000000.00"), ("2", None, None)]


def test_items(spark):
    df = spark.createDataFrame([("1", "a", None), ("2", None, "y")], "id string, p string, q string")
    got = sorted(tuple(r) for r in tgt.items_long(df).collect())
    assert got == [("1", "p", "a"), ("2", "q", "y")]
    items = {r["id"]: r["attrs"] for r in tgt.to_items(df).collect()}
    assert items == {"1": {"p": "a"}, "2": {"q": "y"}}


def test_merge_schemas(spark):
    a = spark.createDataFrame([("1", "x")], "id string, a string")
    b = spark.createDataFrame([("2", "y")], "id string, b string")
    m = tgt.merge_schemas([a, b])
    assert m.columns == ["id", "a", "b"]
    assert sorted(tuple(r) for r in m.collect()) == [("1", "x", None), ("2", None, "y")]


def test_header_groups(spark, zone, monkeypatch):
    import quayside.sources.csv as csvmod

    root, write = zone
    a1 = write("a1.csv", "id,v\n1,x\n")
    a2 = write("a2.csv", "id,v\n2,y\n")
    b = write("b.csv", "v,id,w\nz,3,q\n")
    ml = write("ml.csv", '"i\nd",v\n4,t\n')  # a header name with a line break
    empty = write("empty.csv", "")

    def names(groups):
        return sorted((tuple(s.fieldNames()), len(ps)) for s, ps in groups)

    got = names(csvmod.header_groups(spark, [a1, a2, b, ml, empty]))
    # The empty file holds no rows; file scans leave it out.
    assert got == [(("i\nd", "v"), 1), (("id", "v"), 2), (("v", "id", "w"), 1)]
    groups = csvmod.scan_groups(spark, [a1, a2, b])
    got = [tuple(r[c] if c in df.columns else None for c in ("id", "v", "w"))
           for df, _files in groups for r in df.collect()]
    assert sorted(got) == [("1", "x", None), ("2", "y", None), ("3", "z", "q")]
    assert csvmod.scan_groups(spark, [empty, write("e2.csv", "")]) == []


def test_spread_only_large_single_task_scans(spark, zone):
    from quayside.operators.quality import spread

    root, write = zone
    p = write("one.csv", "id,v\n" + "".join(f"{i},x\n" for i in range(2000)))
    df = read_csv(spark, p)
    assert df.rdd.getNumPartitions() == 1
    # Small for the default bytes of a partition: left as it is.
    assert spread(df) is df
    spread_df = spread(df, bytes_per_partition=4000)
    plan = spread_df._jdf.queryExecution().executedPlan().toString()
    assert "monotonically_increasing_id" in plan or "_nondeterministic" in plan
    assert spread_df.rdd.getNumPartitions() >= 1
    assert sorted(r[0] for r in spread_df.select("id").collect()) == \
        sorted(str(i) for i in range(2000))


def test_a_file_read_by_one_task_is_spread_by_its_bytes(spark, zone):
    from quayside.operators.quality import spread

    root, write = zone
    p = write("narrow.csv", "id,v\n" + "".join(f"{i % 997},{i:07}\n" for i in range(1_500_000)))
    df = read_csv(spark, p)
    assert df.rdd.getNumPartitions() == 1
    sizes = spread(df).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 1_500_000
    # The dedup sorts a task's rows: about 8 MB of the file.
    assert max(r["count"] for r in sizes) < 1_000_000
