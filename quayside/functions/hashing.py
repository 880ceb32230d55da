"""Row-hash keys (T4, T5) as built-in column expressions.

Two profiles decide which columns enter the hash and how values are joined:

``as_coded``
    Every current column whose name has no ``.`` (metadata included), values
    joined with ``_`` by ``concat_ws``. Nulls are skipped and ``_`` inside a
    value is not escaped, so ``(a, null, b)`` and ``(a, b, null)`` collide, as
    do ``(a_b, c)`` and ``(a, b_c)``. Kept for exact compatibility.
``content`` (default)
    Source columns only (load time and file name stay out, so reloading the
    same rows gives the same keys); dotted names included. Every value is
    encoded before joining: ``\\`` -> ``\\\\``, ``_`` -> ``\\_``, null ->
    ``\\N``. The joined text is then unambiguous.

The key is ``'record-' || md5(joined)`` in both profiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values the key format depends on.
KEY_PREFIX = "record"
KEY_SEPARATOR = "-"
FIELD_SEPARATOR = "_"
NULL_MARKER = "\\N"

PROFILES = ("content", "as_coded")
METADATA_COLUMNS = ("ingestion_timestamp", "source_file")


def quoted(name: str) -> Column:
    """Reference a column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_profile(profile: str) -> str:
    if profile not in PROFILES:
        raise ValueError(f"unknown hash profile {profile!r}; expected one of {PROFILES}")
    return profile


def hash_columns(df: DataFrame, profile: str = "content",
                 metadata: Sequence[str] = METADATA_COLUMNS) -> list[str]:
    """Names of the columns that enter the row hash (T5)."""
    check_profile(profile)
    if profile == "as_coded":
        return [c for c in df.columns if "." not in c]
    meta = {m.lower() for m in metadata}
    return [c for c in df.columns if c.lower() not in meta]


def sql_name(name: str) -> str:
    """A column name quoted for SQL text, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A SQL expression for the text ``value``, with each backslash spelled
    ``char(92)`` so no escape rules are involved."""
    if "'" in value:
        raise ValueError("quote characters are not supported here")
    pieces = value.split("\\")
    if len(pieces) == 1:
        return f"'{value}'"
    return "concat(" + ", char(92), ".join(f"'{p}'" for p in pieces) + ")"


def _encode_sql(name: str) -> str:
    text = f"CAST({sql_name(name)} AS STRING)"
    escaped = (f"replace(replace({text}, {sql_text(chr(92))}, {sql_text(chr(92) * 2)}), "
               f"{sql_text(FIELD_SEPARATOR)}, {sql_text(chr(92) + FIELD_SEPARATOR)})")
    return f"coalesce({escaped}, {sql_text(NULL_MARKER)})"


def encode_field(name: str) -> Column:
    """Escape one value for the ``content`` profile; null becomes ``\\N``."""
    return F.expr(_encode_sql(name))


def row_hash(columns: Sequence[str], profile: str = "content") -> Column:
    """The ``record-<md5>`` key over ``columns`` (T4).

    Built as one SQL expression: the same built-in functions
    (``concat_ws``, ``md5``, ``replace``), made in a single call.
    """
    check_profile(profile)
    if profile == "as_coded":
        parts = [sql_name(c) for c in columns]
    else:
        parts = [_encode_sql(c) for c in columns]
    joined = f"concat_ws({sql_text(FIELD_SEPARATOR)}, {', '.join(parts)})"
    return F.expr(f"concat_ws({sql_text(KEY_SEPARATOR)}, {sql_text(KEY_PREFIX)}, "
                  f"CAST(md5({joined}) AS STRING))")
