"""URL rules behind a blocked Bloom filter.

Method. The listed keys (canonical host and path, no scheme) enter a blocked
Bloom filter: a key's hash names one block of eight 32-bit words and one bit
in each, so a test touches one cache line. Every url's candidate keys (each
parent domain with each listed path length) are tested; possible hits go on to
an exact hash join with the rules, which removes the false positives. The
longest rule that fits wins.

At scale. The filter takes ``bits_per_key`` bits a rule but never more than
``max_filter_bytes``, so what is broadcast has a bound; a fuller filter lets more
candidates through to the join and changes no result. Urls are judged once per
distinct host and path. The join is left to the optimiser (hash or sort-merge,
skew split at run time); no group is collected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.bloom import build_filter, may_hold
from quayside.llm.frames import ascii_lower

def host_and_path(url):
    """Canonical host and path columns of a url column. Null or no ``://``:
    both empty."""
    url = F.coalesce(url, F.lit(""))
    after = F.when(F.contains(url, F.lit("://")),
                   F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = ascii_lower(F.regexp_extract(after, r"^([^/?#]*)", 1))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def judge(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", bits_per_key: int = 16,
          max_filter_bytes: int = 64 << 20) -> DataFrame:
    """Judge every url. ``rules`` has ``host, path, verdict``: a rule fits its
    host and all subdomains where the url's path starts with its path; of those
    that fit the longest wins (by host, then path).

    Returns ``page_id, host, path, rule, verdict``, one row per row of ``pages``.
    A null, empty or malformed url has empty host and path, no rule and the
    ``default`` verdict; a null id stays null; repeated rows are returned as
    often as they occur; with no rules every verdict is the default; an empty
    table gives an empty table. Repeated rules count once (the smaller verdict
    wins). Other columns are ignored.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = (pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"),
                         path.alias("path")))
    rules = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
             .groupBy("host", "path").agg(F.min("verdict").alias("verdict")))
    # Path lengths: as many as there are lengths of a url's path, not of rules.
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    if not lengths:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    hashed = rules.select(F.xxhash64("host", "path").alias("h"))
    listed = (np.array([r["h"] for r in part], dtype=np.int64)
              for part in _chunks(hashed.toLocalIterator()))
    bloom = spark.sparkContext.broadcast(
        build_filter(listed, rules.count(), bits_per_key, max_filter_bytes))

    @F.pandas_udf("boolean")
    def possible(h: pd.Series) -> pd.Series:
        return pd.Series(may_hold(bloom.value, h.to_numpy()))

    distinct = urls.where(F.col("host") != "").select("host", "path").distinct()
    parts = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(parts)),
                          lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))
    sizes = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path"))
    keys = (distinct.select("host", "path", F.explode(domains).alias("key_host"))
            .select("host", "path", "key_host", F.explode(sizes).alias("size"))
            .select("host", "path", "key_host",
                    F.expr("substring(path, 1, size)").alias("key_path")))
    maybe = keys.where(possible(F.xxhash64("key_host", "key_path")))
    exact = rules.select(F.col("host").alias("key_host"), F.col("path").alias("key_path"),
                         "verdict")
    fits = maybe.join(exact, ["key_host", "key_path"])
    longest = F.max(F.struct(F.length("key_host").alias("a"), F.length("key_path").alias("b"),
                             F.concat("key_host", "key_path").alias("rule"), "verdict"))
    best = (fits.groupBy("host", "path").agg(longest.alias("best"))
            .select("host", "path", "best.rule", F.col("best.verdict").alias("by_rule")))
    return (urls.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("by_rule", F.lit(default)).alias("verdict")))


def _chunks(rows, size: int = 100_000):
    part = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part
