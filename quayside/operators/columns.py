"""Derived columns and mapping: T1-T3, T6-T9."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.hashing import hash_columns, quoted, row_hash, sql_name
from quayside.functions.paths import relative_key

# Working and target names of the columns a load adds.
KEY = "id"
LOAD_TIME = "ingestion_timestamp"
SOURCE_FILE = "source_file"
TARGET_TIME = "timestamp"

COLLISION_POLICIES = ("error", "suffix", "overwrite")
# Working column while the source is attached; a name no file header uses.
_SOURCE = "__qs_source"


class ColumnCollisionError(ValueError):
    """A source column has the name of a column the load adds."""


def find_column(df: DataFrame, name: str) -> str | None:
    """The actual name of ``name`` in ``df``, matched without case."""
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    return None


def resolve_collisions(df: DataFrame, reserved: Sequence[str],
                       on_collision: str = "error") -> DataFrame:
    """Deal with source columns that carry a reserved name.

    ``error`` raises :class:`ColumnCollisionError` before anything runs;
    ``suffix`` renames the source column to ``<name>_source``;
    ``overwrite`` drops it so the load's value takes its place.
    """
    if on_collision not in COLLISION_POLICIES:
        raise ValueError(f"on_collision must be one of {COLLISION_POLICIES}")
    clashes = [c for c in df.columns if c.lower() in {r.lower() for r in reserved}]
    if not clashes:
        return df
    if on_collision == "error":
        raise ColumnCollisionError(
            f"source columns {clashes} collide with load columns {list(reserved)}")
    if on_collision == "overwrite":
        return df.drop(*clashes)
    renames = {c: f"{c}_source" for c in clashes}
    return df.withColumnsRenamed(renames)


def load_time(ts: dt.datetime | str | None = None) -> Column:
    """T1 value: the execution's time, or a fixed ``ts`` (tests, replays)."""
    if ts is None:
        return F.current_timestamp()
    return F.lit(ts).cast("timestamp")


def add_metadata(df: DataFrame, source: str | None = None, ts=None, *,
                 root: str | None = None, on_collision: str = "error",
                 time_name: str = TARGET_TIME, source_column: str | None = None) -> DataFrame:
    """T1 + T2: add ``ingestion_timestamp`` and ``source_file``.

    ``source`` is the key of the one file loaded. Otherwise every row names
    its own file: from ``source_column`` when the frame carries one (it is
    consumed), else from the scan's ``_metadata.file_path`` (call this
    straight on the file read), less ``root`` when given.
    """
    data = [c for c in df.columns if c != source_column]
    if source is not None:
        source_col = F.lit(source)
    else:
        path = F.col(source_column) if source_column else F.col("_metadata.file_path")
        source_col = relative_key(path, root) if root else path
    df = df.select(*[quoted(c) for c in data], source_col.alias(_SOURCE))
    df = resolve_collisions(df, (LOAD_TIME, SOURCE_FILE, time_name), on_collision)
    return df.select(*[quoted(c) for c in df.columns if c != _SOURCE],
                     load_time(ts).alias(LOAD_TIME), F.col(_SOURCE).alias(SOURCE_FILE))


def ensure_id(df: DataFrame, profile: str = "content", key: str = KEY,
              ignore: Sequence[str] = ()) -> DataFrame:
    """T3 + T4: keep the file's key column or derive a row-hash key.

    The key is looked up without case (D4): a header ``ID`` is the key and
    is renamed ``id``. Without one, ``id`` is the row hash of the profile's
    columns (T5), less working columns in ``ignore``.
    """
    existing = find_column(df, key)
    if existing is not None:
        return df if existing == key else df.withColumnRenamed(existing, key)
    data = [c for c in hash_columns(df, profile) if c not in ignore]
    return df.withColumn(key, row_hash(data, profile))


def default_mappings(df: DataFrame, key: str = KEY,
                     time_name: str = TARGET_TIME) -> list[tuple[str, str, str, str]]:
    """Three fixed entries, then every other column string -> string."""
    # The three entries every mapping begins with.
    fixed = [(key, "string", key, "string"),
             (LOAD_TIME, "timestamp", time_name, "string"),
             (SOURCE_FILE, "string", SOURCE_FILE, "string")]
    taken = {key, LOAD_TIME, SOURCE_FILE}
    rest = [(c, "string", c, "string") for c in df.columns if c not in taken]
    return fixed + rest


def apply_mapping(df: DataFrame, mappings: Sequence[tuple] | None = None, *,
                  key: str = KEY, time_name: str = TARGET_TIME) -> DataFrame:
    """Select each mapped column, cast to its target type, rename.

    Entries are ``(source, source_type, target, target_type)``; a source
    missing from ``df`` is left out, as are columns without an entry.
    Names are always quoted, so dotted names stay single columns (D16).
    """
    if mappings is None:
        mappings = default_mappings(df, key, time_name)
    present = set(df.columns)
    targets = [m[2] for m in mappings if m[0] in present]
    dupes = {t for t in targets if targets.count(t) > 1}
    if dupes:
        raise ColumnCollisionError(f"mapping writes {sorted(dupes)} more than once")
    # One projection of casts, given as SQL text in a single call.
    return df.selectExpr(*[f"CAST({sql_name(src)} AS {ttype}) AS {sql_name(tgt)}"
                           for src, _stype, tgt, ttype in mappings if src in present])


def schema_profile(df: DataFrame) -> DataFrame:
    """The schema as rows (ordinal, name, type, nullable)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, name string, type string, nullable boolean")
