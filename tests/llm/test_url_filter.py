import random

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import bloom, url_filter

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
         ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at])
    path = rest[at:]
    end = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return host, path[:end]


def brute(url, rules, default="allow"):
    host, path = split(url)
    fits = [(len(h), len(p), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, default)


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns(
        {c: F.lit("own") for c in ("host", "path", "rule", "verdict", "key_host")})
    df = url_filter.judge(pages, spark.createDataFrame(
        rules, "host string, path string, verdict string"), **options)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect()}


def test_given_rules(spark):
    urls = ["http://Example.COM/en/x?q#f", "https://www.example.com/en/1", "http://a.net/es/",
            "http://a.net/es", "x", None, "", "http://", "http://net/fr/1#a/b", "http://com",
            "http://b.example.com", "http://ÀB.com/?x://y", "a://b://c.com/en/", "http://x.com\n/a",
            "http://www.example.com/en/1", "http://.com/", "http://a..net/es/y"] + \
           ["http://hot.net/es/same"] * 50
    got = judged(spark, urls, RULES)
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_random_rules_with_a_full_filter(spark):
    rng = random.Random(1)
    hosts = ["a", "b.a", "c.b.a", "d", "a.d"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/é"]
    rules = list({(rng.choice(hosts), rng.choice(paths)): None for _ in range(12)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    urls = [f"s://{rng.choice(['', 'q.', 'c.'])}{rng.choice(hosts)}{rng.choice(paths)}"
            f"{rng.choice(['', '?a', '#', 'z'])}" for _ in range(300)]
    for bound in (32, 1 << 20):
        got = judged(spark, urls, rules, max_filter_bytes=bound)
        assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://a.com/"], []) == {0: ("a.com", "/", None, "allow")}
    assert judged(spark, [], RULES) == {}


def test_filter_has_no_false_negatives():
    rng = np.random.default_rng(1)
    keys = rng.integers(-2 ** 63, 2 ** 63 - 1, 5000)
    table = bloom.build_filter([keys[:3000], keys[3000:]], 5000, 16, 1 << 20)
    assert bloom.may_hold(table, keys).all()
    others = rng.integers(-2 ** 63, 2 ** 63 - 1, 20_000)
    assert bloom.may_hold(table, others).mean() < 0.02


def test_key_filter(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    table = bloom.key_filter(keys, 20_000, most=1 << 20)
    values = np.array([r["key"] for r in keys.collect()])
    assert bloom.may_hold(table, values).all() and len(table) * 32 <= 1 << 20
