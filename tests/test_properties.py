"""Property tests: content keys, key decoding and load counts on random input."""

import hashlib
from urllib.parse import unquote_plus

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions.hashing import row_hash
from quayside.functions.paths import decode_key
from quayside.operators.audit import count_load
from quayside.operators.quality import dedup_rows

SETTINGS = settings(max_examples=20, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# Values built from the characters the encoding has to keep apart.
value = st.one_of(st.none(), st.text(alphabet=["a", "_", "\\", "N", "é"], max_size=4))
row = st.tuples(value, value, value)


def model_key(r):
    """Plain-Python statement of the content profile."""
    def enc(v):
        if v is None:
            return "\\N"
        return v.replace("\\", "\\\\").replace("_", "\\_")
    return "record-" + hashlib.md5("_".join(enc(v) for v in r).encode()).hexdigest()


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_content_key_is_the_model_and_injective(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [(tuple(r[:3]), r[3]) for r in
           df.select("a", "b", "c", row_hash(["a", "b", "c"]).alias("id")).collect()]
    for r, k in got:
        assert k == model_key(r)
    assert len({k for _, k in got}) == len({r for r, _ in got})


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_dedup_rows_equals_python_distinct(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string")
    out = dedup_rows(df, with_copies=True).collect()
    assert sorted((tuple(r[:3]) for r in out), key=repr) == \
        sorted(set(rows), key=repr)
    assert sum(r["__qs_copies"] for r in out) == len(rows)
    assert all(r["id"] == model_key(tuple(r[:3])) for r in out)


key_text = st.text(alphabet=["a", "+", "%", "2", "0", "C", "3", "A", "9", "g", "/", "é", " "],
                   max_size=10)


@SETTINGS
@given(keys=st.lists(key_text, min_size=1, max_size=30))
def test_decode_key_matches_form_decoding(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(decode_key(F.col("k"))).collect()]
    assert got == [unquote_plus(k) for k in keys]


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.sampled_from("abcdef")), min_size=0, max_size=60))
def test_load_counts_add_up(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    read, null_rejected, duplicates, written = count_load(df, "k").first()
    present = [k for k in keys if k is not None]
    assert (read, null_rejected, written) == (len(keys), len(keys) - len(present),
                                             len(set(present)))
    assert read == null_rejected + duplicates + written


def _model_survivors(rows, keep):
    """Per key, the last (or first) row by (order, then the row itself);
    a null sorts before any value, as in Spark's ordering."""
    def sort_key(r):
        return tuple((v is not None, v if v is not None else "") for v in (r[1],) + r)
    out = {}
    for r in rows:
        cur = out.get(r[0])
        if cur is None:
            out[r[0]] = r
        elif keep == "last" and sort_key(r) > sort_key(cur):
            out[r[0]] = r
        elif keep == "first" and sort_key(r) < sort_key(cur):
            out[r[0]] = r
    return sorted(out.values(), key=repr)


survivor_row = st.tuples(st.sampled_from(["k1", "k2", "k3"]),
                         st.one_of(st.none(), st.sampled_from(["1", "2", "3"])),
                         st.one_of(st.none(), st.text(alphabet=["a", "b"], max_size=2)))


@SETTINGS
@given(rows=st.lists(survivor_row, min_size=1, max_size=30),
       keep=st.sampled_from(["first", "last"]))
def test_dedup_survivor_matches_the_model(spark, rows, keep):
    from quayside.operators.quality import dedup

    df = spark.createDataFrame(rows, "k string, o string, v string")
    got = sorted((tuple(r) for r in dedup(df, ["k"], ["o"], keep=keep).collect()), key=repr)
    assert got == _model_survivors(rows, keep)
