"""Load counts and the audit record: A1-A4.

All four counts of a load come from one place, the per-key group sizes the
dedup aggregate already computes:

* ``read``          sum of group sizes
* ``null_rejected`` size of the null-key group
* ``duplicates``    sum of (size - 1) over the other groups
* ``written``       number of the other groups

so ``read = null_rejected + duplicates + written`` holds by construction
(D14). In a load they are gathered by an ``Observation`` placed after the
shuffle, in the stage that writes, which Spark counts once per partition
even when tasks are retried or run speculatively.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.functions.hashing import quoted
from quayside.operators.quality import COPIES, FILE_GROUP, GROUP, RAGGED, REJECTED

AUDIT_SCHEMA = ("batch_id long, source_file string, target string, read long, "
                "null_rejected long, duplicates long, written long, malformed long, "
                "status string, message string, source_schema string")

FILE_AUDIT_SCHEMA = ("batch_id long, source_file string, read long, null_rejected long, "
                     "duplicates long, written long, malformed long, status string, "
                     "message string")

SUCCESS = "SUCCESS"
EMPTY = "EMPTY"
FAILED = "FAILED"


class AuditMismatchError(RuntimeError):
    """The counts of a load do not add up."""


@dataclass(frozen=True)
class LoadCounts:
    read: int = 0
    null_rejected: int = 0
    duplicates: int = 0
    written: int = 0
    malformed: int = 0  # rows read whose number of fields isn't the header's

    # The stage counts the original job prints, derived (A1, A2).
    @property
    def after_null_filter(self) -> int:
        return self.read - self.null_rejected

    @property
    def after_dedup(self) -> int:
        return self.after_null_filter - self.duplicates

    @property
    def ready(self) -> int:
        return self.after_dedup

    @property
    def mapped(self) -> int:
        return self.written

    def check(self) -> "LoadCounts":
        if self.read != self.null_rejected + self.duplicates + self.written or min(
                self.null_rejected, self.duplicates, self.written) < 0:
            raise AuditMismatchError(f"counts do not add up: {self}")
        return self

    @classmethod
    def from_metrics(cls, metrics: dict) -> "LoadCounts":
        return cls(**{k: int(metrics.get(k) or 0) for k in asdict(cls())})


def load_metrics(group: str = GROUP, copies: str = COPIES, ragged: str | None = None,
                 file_group: str | None = None) -> list[Column]:
    """A1 + A2 as aggregate expressions over a ``dedup_counted`` frame;
    ``ragged`` names its count of malformed rows, ``file_group`` the groups that
    count files: they come out as ``files``, a list of one entry a file."""
    of_key = F.col(file_group).isNull() if file_group else F.lit(True)
    k, n = quoted(group), F.when(of_key, F.col(copies))
    bad = F.when(of_key, F.col(ragged)) if ragged else F.lit(0)
    more = [F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias("malformed")] if ragged else []
    if file_group:
        entry = F.struct(F.col(file_group).alias("source_file"), F.col(copies).alias("read"),
                         F.col(REJECTED).alias("null_rejected"),
                         (F.col(ragged) if ragged else F.lit(0)).cast("long").alias("malformed"))
        more.append(F.collect_list(F.when(~of_key, entry)).alias("files"))
    return [
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("read"),
        F.coalesce(F.sum(F.when(k.isNull(), n)), F.lit(0)).cast("long").alias("null_rejected"),
        F.coalesce(F.sum(F.when(k.isNotNull(), n - 1)), F.lit(0)).cast("long").alias("duplicates"),
        F.count_if(k.isNotNull()).cast("long").alias("written"),
        *more,
    ]


def observe_load(counted: DataFrame, name: str | None = None
                 ) -> tuple[DataFrame, Observation]:
    """Attach the load counts to a ``dedup_counted`` frame, then drop the
    rejected group, the files' groups and the helper columns. The counts fill in
    when the frame is written."""
    obs = Observation(name) if name else Observation()
    ragged, file_group = (c if c in counted.columns else None for c in (RAGGED, FILE_GROUP))
    observed = counted.observe(obs, *load_metrics(ragged=ragged, file_group=file_group))
    kept = observed.filter(F.col(GROUP).isNotNull()).drop(GROUP, COPIES, RAGGED, FILE_GROUP,
                                                          REJECTED)
    return kept, obs


@dataclass(frozen=True)
class FileCounts:
    """One arrived file's part in a load (A3)."""
    source_file: str
    counts: LoadCounts
    status: str = SUCCESS
    message: str | None = None


def file_counts(files: Sequence, written: dict[str, int], total: LoadCounts
                ) -> list[FileCounts]:
    """Counts per file from a load's ``files`` metric and the rows written of each file;
    checked to add up, in each file and over all of them."""
    out = []
    for f in sorted(files, key=lambda f: f["source_file"]):
        kept = written.get(f["source_file"], 0)
        out.append(FileCounts(f["source_file"], LoadCounts(
            f["read"], f["null_rejected"], f["read"] - f["null_rejected"] - kept, kept,
            f["malformed"]).check()))
    for name in asdict(total):
        if sum(getattr(f.counts, name) for f in out) != getattr(total, name):
            raise AuditMismatchError(f"{name} of the files differs from the load's: {total}")
    return out


def count_load(df: DataFrame, key: str) -> DataFrame:
    """The four counts of loading ``df`` keyed by ``key``, as one row."""
    sizes = df.groupBy(quoted(key).alias(GROUP)).agg(F.count(F.lit(1)).alias(COPIES))
    return sizes.agg(*load_metrics())


def audit_record(batch_id: int, source: str, target: str, counts: LoadCounts,
                 status: str, message: str | None = None,
                 source_schema: str | None = None) -> dict:
    """A3: the summary of a load as a record (A4 uses status ``FAILED``);
    ``source_schema`` is the scanned schema as ``name type`` pairs (T9)."""
    return {"batch_id": int(batch_id), "source_file": source, "target": target,
            "read": counts.read, "null_rejected": counts.null_rejected,
            "duplicates": counts.duplicates, "written": counts.written,
            "malformed": counts.malformed, "status": status, "message": message, "source_schema": source_schema}


def audit_path(target: str) -> str:
    return f"{target.rstrip('/')}/_audit"


def write_audit(spark: SparkSession, record: dict, target: str) -> None:
    """Store the audit record of one load.

    One small JSON file, written from the driver through the cluster's file
    system: a control record, so no Spark job is started for it.
    """
    import json

    from quayside.plans.files import write_text
    path = f"{audit_path(target)}/batch-{int(record['batch_id'])}.json"
    write_text(spark, path, json.dumps(record) + "\n")


def read_audit(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).json(f"{audit_path(target)}/batch-*.json")


def write_file_audit(spark: SparkSession, batch_id: int, files: Sequence[FileCounts],
                     target: str) -> None:
    """Store a load's counts per arrived file: one control file, a line a file."""
    import json

    from quayside.plans.files import write_text
    lines = [json.dumps({"batch_id": int(batch_id), "source_file": f.source_file,
                         **asdict(f.counts), "status": f.status, "message": f.message})
             for f in files]
    write_text(spark, f"{audit_path(target)}/files-{int(batch_id)}.json", "\n".join(lines) + "\n")


def read_file_audit(spark: SparkSession, target: str) -> DataFrame:
    """A row per arrived file of the loads that discovered their files."""
    from quayside.plans.files import child_files
    names = [n for n in child_files(spark, audit_path(target)) if n.startswith("files-")]
    if not names:
        return spark.createDataFrame([], FILE_AUDIT_SCHEMA)
    return spark.read.schema(FILE_AUDIT_SCHEMA).json(f"{audit_path(target)}/files-*.json")
