"""Driver-side path checks through the cluster's Hadoop file system.

Only names and existence cross to the driver here; no data does.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write (or replace) one small file; for control records only."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> bool:
    """Remove ``path`` and everything under it; false if it was absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    return bool(fs.delete(p, True))


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (none if absent)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` (one summary call; 0 if absent)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    return int(fs.getContentSummary(p).getLength())


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path`` (none if absent)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Integer values of ``column=<n>`` folders under ``path``."""
    prefix = column + "="
    out = []
    for name in child_dirs(spark, path):
        if name.startswith(prefix):
            try:
                out.append(int(name[len(prefix):]))
            except ValueError:
                continue
    return sorted(out)


def total_size(spark: SparkSession, uris: list[str]) -> int:
    """Bytes of the given files, named by URI as ``DataFrame.inputFiles``
    gives them (a metadata call per file)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for uri in uris:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        total += int(p.getFileSystem(conf).getFileStatus(p).getLen())
    return total


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write one small control file only if there is none of that name; false
    when another writer was first.

    A distributed file system creates exclusively by itself. Hadoop's local one looks
    first and creates then, so there the operating system's exclusive create is used."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    real = fs.resolvePath(p.getParent()).toUri()
    if real.getScheme() == "file":
        try:
            open(f"{real.getPath()}/{p.getName()}", "x").close()
        except FileExistsError:
            return False
        write_text(spark, path, text)  # the name is ours
        return True
    try:
        out = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small control file's text."""
    fs, p = _fs(spark, path)
    size = int(fs.getFileStatus(p).getLen())
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(size)).decode("utf-8")
    finally:
        stream.close()
