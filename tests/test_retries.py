"""Observed load counts stay exact when tasks fail and are retried.

Runs in its own Spark process (``local[2,3]``: up to three attempts per
task), with tasks of the writing stage failing on their first attempt.
"""

import json
import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent('''
    import json, sys, tempfile
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType
    from quayside.session import get_session
    from quayside.plans.load import LoadConfig, prepare
    from quayside.operators.audit import LoadCounts
    from quayside.sources.csv import land_csv, read_csv

    spark = get_session("local[2,3]", app_name="retries", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("OFF")
    root = tempfile.mkdtemp(prefix="qs-retry-")
    rows = [(None if i % 7 == 0 else str(i % 50), str(i)) for i in range(2000)]
    raw = land_csv(spark.createDataFrame(rows, "id string, v string").repartition(3),
                   root + "/raw", "r.csv")
    df = read_csv(spark, raw)
    mapped, obs = prepare(df, LoadConfig(target=root + "/t", ts="2024-01-01"), source="raw/r.csv")

    @F.udf(StringType())
    def flaky(v):
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("injected failure")
        return v

    mapped.withColumn("v", flaky("v")).write.parquet(root + "/out")
    got = LoadCounts.from_metrics(obs.get)
    written = spark.read.parquet(root + "/out").count()
    print(json.dumps(dict(read=got.read, null=got.null_rejected, dup=got.duplicates,
                          written=got.written, recount=written)))
''')


def test_retried_tasks_are_counted_once():
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], capture_output=True,
                         text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    got = json.loads(out.stdout.strip().splitlines()[-1])
    nulls = sum(1 for i in range(2000) if i % 7 == 0)
    assert got == dict(read=2000, null=nulls, dup=2000 - nulls - 50, written=50, recount=50)
