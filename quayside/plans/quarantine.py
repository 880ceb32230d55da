"""Which files of a batch can't be read.

One unreadable file fails the Spark job that reads it among others. The batch is
halved until every file that fails by itself stands alone; the rest is read in as
many jobs as there are halves without one. Only errors of reading count: any other,
and one that doesn't come again, is left to the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

# How Spark names errors that come from a file.
READ_ERRORS = ("FAILED_READ_FILE", "PATH_NOT_FOUND", "TextParsingException",
               "MALFORMED_CSV_RECORD")
REASON_CHARS = 500


def is_read_error(exc: BaseException) -> bool:
    return any(name in str(exc) for name in READ_ERRORS)


def reason(exc: BaseException) -> str:
    """The part of the error that names the file, at most ``REASON_CHARS`` characters."""
    text = str(exc)
    found = [text.index(name) for name in READ_ERRORS if name in text]
    return text[min(found, default=0):][:REASON_CHARS].split("\n")[0]


def unreadable(paths: Sequence[str], read: Callable[[Sequence[str]], object]) -> dict[str, str]:
    """The files that make ``read`` fail by themselves, each with the reason."""
    paths = list(paths)
    if not paths:
        return {}
    try:
        read(paths)
        return {}
    except Exception as exc:
        if not is_read_error(exc):
            raise
        if len(paths) == 1:
            return {paths[0]: reason(exc)}
    half = len(paths) // 2
    return unreadable(paths[:half], read) | unreadable(paths[half:], read)
