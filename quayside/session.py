"""Session settings and the shared scratch location.

Every load runs in UTC (the load time enters text and, in the ``as_coded``
profile, the row hash), with adaptive execution on so shuffle partition
counts follow the data instead of a fixed number.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a load relies on; applied by ``get_session`` and checked by
# ``configure``.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "quayside",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the load defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only where it is unset (local runs, tests) a
    folder of our own is made and registered.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or _runtime_conf(spark)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quayside-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _runtime_conf(spark: SparkSession) -> str | None:
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookup never fails in classic mode
        return None


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    from quayside.plans.files import mkdirs

    root = checkpoint_root(spark)
    path = f"{root}/quayside-scratch/{label}-{uuid.uuid4().hex[:12]}"
    mkdirs(spark, path)  # through the cluster's file system, whatever its scheme
    return path
