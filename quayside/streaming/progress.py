"""Counts of a running stream, as it reports them (A1, A2).

A streaming-query listener joins what Spark observes of each micro-batch (files and
bytes that arrived) with the counts of the load that the micro-batch made. There is
one row a micro-batch; their sums are those of the audit.
"""

from __future__ import annotations

import threading
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quayside.operators.audit import LoadCounts

ARRIVALS = "arrivals"
PROGRESS_SCHEMA = ("query string, epoch long, files long, bytes long, read long, "
                   "null_rejected long, duplicates long, written long, malformed long, "
                   "seconds double")


def observe_arrivals(files: DataFrame) -> DataFrame:
    """A discovery stream that reports its files and bytes with each micro-batch."""
    return files.observe(ARRIVALS, F.count(F.lit(1)).alias("files"),
                         F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


class LiveCounts(StreamingQueryListener):
    """Progress rows of the first stream started after it was made. ``on_row`` is called with each row
    (a dict) as it comes; ``rows`` keeps the last ``keep`` of them, and ``totals`` the
    sums of all."""

    def __init__(self, spark: SparkSession, on_row=None, keep: int = 10_000):
        self.spark, self.on_row, self.keep = spark, on_row, keep
        self.rows: list[dict] = []
        self.totals: dict[str, int] = {}
        self._loads: dict[int, LoadCounts] = {}
        self._ended = threading.Event()
        self._run: str | None = None
        spark.streams.addListener(self)

    def loaded(self, epoch: int, counts: LoadCounts) -> None:
        """A micro-batch's load has ended; its progress comes next."""
        self._loads[epoch] = counts

    def onQueryStarted(self, event) -> None:
        if self._run is None:
            self._run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) != self._run:
            return
        arrived = progress.observedMetrics.get(ARRIVALS)
        if arrived is None:
            return
        counts = self._loads.pop(progress.batchId, LoadCounts())
        row = {"query": str(progress.id), "epoch": int(progress.batchId),
               "files": int(arrived["files"]), "bytes": int(arrived["bytes"]),
               **asdict(counts), "seconds": progress.batchDuration / 1000}
        self.rows = [*self.rows[-self.keep + 1:], row]
        for name, value in row.items():
            if isinstance(value, int) and name != "epoch":
                self.totals[name] = self.totals.get(name, 0) + value
        if self.on_row:
            self.on_row(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run:
            self._ended.set()

    def wait(self, seconds: float = 60) -> None:
        """Until the last progress of a query that has ended is in."""
        if not self._ended.wait(seconds):
            raise TimeoutError("the query's last progress hasn't come")

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    def frame(self) -> DataFrame:
        names = [f.split(" ")[0] for f in PROGRESS_SCHEMA.split(", ")]
        return self.spark.createDataFrame([tuple(r[n] for n in names) for r in self.rows],
                                          PROGRESS_SCHEMA)
