"""Key and path expressions: extension, suffix test, key decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The only accepted format, and the raw-zone prefix.
ACCEPTED_EXTENSION = "csv"
RAW_PREFIX = "raw/"
# Matches every file name ending in .csv, whatever the case.
CSV_GLOB = "*.[cC][sS][vV]"


class UnsupportedFormatError(ValueError):
    """Raised when a key's extension is not ``csv``."""


def extension_of(key: str) -> str:
    """Text after the last ``.``, lower-cased; the whole key if it has none."""
    return key.split(".")[-1].lower()


def check_format(key: str) -> str:
    """Driver-side gate for a single load."""
    ext = extension_of(key)
    if ext != ACCEPTED_EXTENSION:
        raise UnsupportedFormatError(f"not a CSV file: {key!r} ends in {ext!r}")
    return ext


def extension(col: Column) -> Column:
    """Column form of :func:`extension_of`."""
    return F.lower(F.element_at(F.split(col, r"\."), -1))


def is_csv(col: Column) -> Column:
    """Case-insensitive ``.csv`` suffix test."""
    return F.lower(col).endswith("." + ACCEPTED_EXTENSION)


def decode_key(col: Column) -> Column:
    """Decode a notification key the way form decoding does.

    ``+`` becomes a space and ``%XX`` a byte; a ``%`` not followed by two hex
    digits stays as it is (``100%.csv`` is kept). The lone ``%`` is first
    rewritten to ``%25`` so the decoder never fails on it.
    """
    protected = F.regexp_replace(col, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(protected), col)


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


def uri_path(col: Column) -> Column:
    """The decoded path part of a file URI such as ``_metadata.file_path``.

    File URIs escape a space as ``%20`` but leave ``+`` alone, so ``+`` is
    protected before decoding.
    """
    bare = F.regexp_replace(col, _SCHEME, "")
    return F.url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))


def plain_path(path: str) -> str:
    """Python twin of :func:`uri_path` for a root given by the caller."""
    import re
    return re.sub(_SCHEME, "", path).rstrip("/")


def literal_path(path: str) -> str:
    """A path as a pattern that matches itself alone: Spark's readers take
    brackets, braces, stars and question marks for patterns."""
    import re
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def relative_key(path_col: Column, root: str, uri: bool = True) -> Column:
    """A file URI (or, without ``uri``, a plain path) less the zone root, as a
    key like ``raw/x.csv``."""
    base = plain_path(root) + "/"
    full = uri_path(path_col) if uri else F.regexp_replace(path_col, _SCHEME, "")
    return F.when(full.startswith(base), F.right(full, F.length(full) - F.lit(len(base)))).otherwise(full)
