"""The registered query set against its DuckDB oracles at sf0.001."""


import re

import __spark_entry__ as entry_mod
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns[:3] == ["id", "timestamp", "source_file"]
    assert df.count() > 0


def own(names):
    """The library's own queries (the training-data ones have their tests)."""
    return {n for n in names if not re.match(r"op\d+_|pipeline$", n)}


def test_every_query_has_an_oracle():
    assert own(entry_mod.queries()) == own(entry_mod.oracle_sql())


def test_queries_match_oracle(spark):
    res = compare(spark, SF, names=sorted(own(entry_mod.queries())), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad
