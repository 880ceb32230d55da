"""Quoted CSV read line by line: where records begin, and what each file's first one is.

Spark's text source splits a file at line ends and tells each line's file and
split. Whether a line begins a record depends on the quotes before it, of which
one bit is all that passes from line to line: inside a quoted field or not. Hence
a split maps that bit at its start to the bit at its end, whatever came before,
and the splits' maps compose to the state of each (a prefix scan).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.paths import literal_path

PATH, START, ARRIVAL, LINE = "path", "start", "arrival", "line"
# Files beyond this are looked at by a task of their own that stops after the first
# record; smaller ones are read through, many to a task.
ALONE_BYTES = 32 * 1024 * 1024
_UNSPLIT = 1 << 50  # every file a partition of its own


class Quoting:
    """The quotes of a dialect in which a quote inside a quoted field is doubled. A
    quote opens a field only as its first character; what follows a closing quote, up
    to the separator, is text."""

    def __init__(self, sep: str, quote: str):
        s, q = re.escape(sep.encode()), re.escape(quote.encode())
        body = b"(?:[^%b]++|%b%b)*+" % (q, q, q)
        rest = b"[^%b]*+" % s
        self.quote = quote.encode()
        self._body = re.compile(body)
        self._closed = re.compile(q + rest)
        # Whole fields and their separators, then a field that doesn't close.
        self._opens = re.compile(b"(?:(?:%b%b%b%b|[^%b%b]%b)?+%b)*+%b%b"
                                 % (q, body, q, rest, s, q, rest, s, q, body), re.DOTALL)

    def inside_after(self, line: bytes, inside: bool) -> bool:
        """Whether the line's end is inside a quoted field, given its start's state."""
        if self.quote not in line:
            return inside
        at = 0
        if inside:
            at = self._body.match(line).end()
            if at == len(line):
                return True
            at = self._closed.match(line, at).end()
            if at == len(line):
                return False
            at += 1
        return self._opens.fullmatch(line, at) is not None


class Records:
    """Gathers the lines of one split into records.

    ``feed`` takes a batch's lines and the places of those with quotes; it returns the
    mask of lines that are records of their own and the joined records of several
    lines. With ``inside`` the split begins in a record of the split before: its lines
    up to the first record are ``head``. ``limit`` bounds what is held of a record:
    beyond it ``long`` is set and its text is let go."""

    def __init__(self, quoting: Quoting, inside: bool = False, limit: int | None = None):
        self.quoting, self.inside, self.limit = quoting, inside, limit
        self.head: bytes | None = None
        self.in_head = inside
        self.open: list[bytes] = []
        self.held = 0
        self.long = self.head_long = False

    def _hold(self, lines: Iterable[bytes]) -> None:
        if self.long:
            return
        for line in lines:
            self.open.append(line)
            self.held += len(line)
        if self.limit is not None and self.held > self.limit:
            self.open, self.long = [], True

    def _close(self, out: list[bytes]) -> None:
        text = self.text
        if self.in_head:
            self.head, self.head_long, self.in_head = text, self.long, False
        elif not self.long:
            out.append(text)
        self.open, self.held, self.long = [], 0, False

    def feed(self, lines: Sequence[bytes], quoted: Sequence[int]) -> tuple[np.ndarray, list[bytes]]:
        single, out, at = np.ones(len(lines), bool), [], 0
        for j in quoted:
            after = self.quoting.inside_after(lines[j], self.inside)
            if self.inside:
                single[at:j + 1] = False
                self._hold(lines[at:j + 1])
                if not after:
                    self._close(out)
            elif after:
                single[j] = False
                self._hold([lines[j]])
            self.inside, at = after, j + 1
        if self.inside:
            single[at:] = False
            self._hold(lines[at:])
        return single, out

    @property
    def text(self) -> bytes:
        return b"\n".join(self.open)

    @property
    def tail(self) -> bytes | None:
        """The record that the split's end cuts, if it began in this split."""
        return self.text if self.inside and not self.in_head and not self.long else None


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every line with its file and its split's start; a line ends at ``\\n`` alone."""
    return (spark.read.option("lineSep", "\n").text([literal_path(p) for p in paths])
            .select(F.col("_metadata.file_path").alias(PATH),
                    F.col("_metadata.file_block_start").alias(START),
                    F.unix_micros("_metadata.file_modification_time").alias(ARRIVAL),
                    F.col("value").alias(LINE)))


class Run(NamedTuple):
    """Lines of one split, which is named by its file, its start and the arrival."""
    split: tuple[str, int, int]
    rows: pa.RecordBatch


def runs(batch: pa.RecordBatch) -> Iterator[Run]:
    """A batch cut where the file or the split changes."""
    if not batch.num_rows:
        return
    starts = batch.column(START).to_numpy(zero_copy_only=False)
    files = pc.dictionary_encode(batch.column(PATH)).indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        split = (batch.column(PATH)[a].as_py(), int(starts[a]), batch.column(ARRIVAL)[a].as_py())
        yield Run(split, batch.slice(a, b - a))


def lines_of(batch: pa.RecordBatch, quote: bytes) -> tuple[list[bytes], list[int]]:
    """A run's lines as bytes, and the places of those with a quote."""
    column = batch.column(LINE).cast(pa.binary())
    with_quote = pc.match_substring(column, quote)
    return column.to_pylist(), np.flatnonzero(
        with_quote.to_numpy(zero_copy_only=False)).tolist()


def scan_session(spark: SparkSession, **settings) -> SparkSession:
    """A session of the same cluster with ``spark``'s settings and scan settings of its
    own (``spark.sql.files.*``), so that the caller's stay as they are."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in settings.items():
        session.conf.set(f"spark.sql.files.{key}", str(value))
    return session


def first_records(spark: SparkSession, sizes: dict[str, int], sep: str, quote: str,
                  doubled: bool = True) -> dict[str, str]:
    """The first record of each file, by the file's URI, in one Spark job whatever the
    number of files. ``sizes`` names the files and their bytes. Files without a record
    are left out. Without ``doubled`` (another escape than the quote) the first line
    that isn't empty is taken."""
    quoting = Quoting(sep, quote)
    small = [p for p, size in sizes.items() if size <= ALONE_BYTES]
    large = [p for p, size in sizes.items() if size > ALONE_BYTES]
    parts = [(text_lines(spark, small), False)] if small else []
    if large:
        alone = scan_session(spark, maxPartitionBytes=_UNSPLIT, openCostInBytes=_UNSPLIT)
        parts.append((text_lines(alone, large), True))

    def found(stop: bool):
        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, reader, done = None, None, True
            for batch in batches:
                for (path, start, _time), rows in runs(batch):
                    if path != now:
                        if not done and reader.tail is not None:
                            yield _row(now, reader.tail)
                        now, reader, done = path, Records(quoting), start > 0
                    got = None if done else _first(reader, rows, doubled)
                    if got is not None:
                        done = True
                        yield _row(path, got)
                        if stop:
                            return
            if not done and reader.tail is not None:  # the file ends inside its header
                yield _row(now, reader.tail)
        return look

    frames = [lines.mapInArrow(found(stop), "path string, record string")
              for lines, stop in parts]
    if not frames:
        return {}
    both = frames[0] if len(frames) == 1 else frames[0].union(frames[1])
    return {r["path"]: r["record"] for r in both.collect()}


def _first(reader: Records, rows: pa.RecordBatch, doubled: bool) -> bytes | None:
    lines, quoted = lines_of(rows, reader.quoting.quote)
    if not doubled:
        return next((x for x in lines if x.strip(b"\r")), None)
    marks = set(quoted)
    for i, line in enumerate(lines):
        single, out = reader.feed([line], [0] if i in marks else [])
        if out:
            return out[0]
        if single[0] and line.strip(b"\r"):
            return line
    return None


def _row(path: str, record: bytes) -> pa.RecordBatch:
    text = record.decode("utf-8", "replace").removeprefix("\ufeff").removesuffix("\r")
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([text])],
                                      names=["path", "record"])
