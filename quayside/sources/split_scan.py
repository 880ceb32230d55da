"""Split scan of multi-line CSV (S1): one quoted file read by many tasks.

Spark's own multi-line reader gives a whole file to one task. Here the file's splits
are looked at twice. First every split finds, for both states it may begin in, the
state it ends in, and the pieces of records at its two edges; those few pieces are
written to the shared scratch folder. The states compose from split to split. Then
every split gives out the records that lie whole in it, while a record that a border
cuts is put together from the pieces on both sides. Records are parsed by Spark's own
CSV parser (``from_csv``), so values, nulls and malformed rows come out as in the
one-task read.

The driver holds one small row a split, as Spark's scan planning does itself. Some
files are left to the one-task read: those with a piece beyond ``PIECE_BYTES``, with
carriage returns alone for line ends or a byte-order mark, whose header reaches past
the first split, or which end inside a quoted field. Both looks must see the same
splits; a scan that meets another one (the cluster's size changed between them) fails
rather than guess.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.functions.hashing import sql_name
from quayside.session import scratch_dir
from quayside.sources.lines import (ARRIVAL, LINE, PATH, START, Quoting, Records, lines_of, runs,
                                    scan_session, text_lines)

# Files beyond this are worth reading in splits.
SPLIT_BYTES = 64 * 1024 * 1024
# A split's size at most, unless the caller names one: the dedup sorts a split's rows in
# one task, and narrow rows take about 40 times their bytes in the file.
MOST_SPLIT_BYTES = 16 * 1024 * 1024
PIECE_BYTES = 4 * 1024 * 1024
# Reader settings that don't move a record's borders.
_HARMLESS = {"sep", "quote", "escape", "multi_line", "nullvalue", "emptyvalue", "nanvalue",
             "maxcharspercolumn", "maxcolumns"}
_BOM = b"\xef\xbb\xbf"
_ROW = "__qs_row"

_EDGES = pa.schema([
    (PATH, pa.string()), (START, pa.int64()), (ARRIVAL, pa.int64()), ("odd", pa.bool_()),
    ("crlf", pa.bool_()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_()),
    ("tail_outside", pa.binary()), ("head_inside", pa.binary()), ("tail_inside", pa.binary()),
    ("lost_outside", pa.bool_()), ("lost_inside", pa.bool_())])
_EDGES_DDL = ("path string, start long, arrival long, odd boolean, crlf boolean, "
              "from_outside boolean, from_inside boolean, tail_outside binary, "
              "head_inside binary, tail_inside binary, lost_outside boolean, "
              "lost_inside boolean")
_RECORDS = pa.schema([(PATH, pa.string()), (ARRIVAL, pa.int64()), ("record", pa.string())])


class SplitsChangedError(RuntimeError):
    """The second look at a file met a split that the first hasn't seen."""


def can_split(options: dict) -> bool:
    """Whether these reader settings leave record borders to quotes and line ends."""
    quote, sep = options.get("quote", '"'), options.get("sep", ",")
    return (options.get("multi_line", True) and options.get("escape", '"') == quote
            and len(quote) == len(sep) == 1 and (quote + sep).isascii()
            and {k.lower() for k in options} <= _HARMLESS)


class _Split:
    """First look at one split: read as if it began outside and inside of a field."""

    def __init__(self, quoting: Quoting, first: bytes, limit: int):
        self.outside = Records(quoting, False, limit)
        self.inside = Records(quoting, True, limit)
        self.first, self.has_record = first, False

    def feed(self, lines: list[bytes], quoted: list[int]) -> None:
        single, joined = self.outside.feed(lines, quoted)
        self.inside.feed(lines, quoted)
        self.has_record = self.has_record or bool(joined) or _first_line(lines, single) is not None

    def row(self, path: str, start: int, arrival: int) -> pa.RecordBatch:
        out, inn = self.outside, self.inside
        head, head_lost = (inn.text, inn.long) if inn.in_head else (inn.head, inn.head_long)
        # A bare carriage return before the first line feed ends lines for Spark; a first
        # split without a whole record holds no more than a part of the header.
        odd = start == 0 and (b"\r" in self.first.removesuffix(b"\r") or not self.has_record
                              or self.first.startswith(_BOM))
        values = [path, start, arrival, odd, start == 0 and self.first.endswith(b"\r"),
                  out.inside, inn.inside, out.tail, None if head_lost else head, inn.tail,
                  out.long, inn.long or head_lost]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, _EDGES)], schema=_EDGES)


def _edges(quoting: Quoting, limit: int):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = split = None
        for batch in batches:
            for run in runs(batch):
                lines, quoted = lines_of(run.rows, quoting.quote)
                if run.split != now:
                    if now:
                        yield split.row(*now)
                    now, split = run.split, _Split(quoting, lines[0], limit)
                split.feed(lines, quoted)
        if now:
            yield split.row(*now)
    return look


def _first_line(lines: list[bytes], single) -> int | None:
    """Place of the first line that is a record of its own, if none of several lines
    begins before it."""
    for i, line in enumerate(lines):
        if not single[i]:
            return None
        if line.strip(b"\r"):
            return i
    return None


def _whole(quoting: Quoting, states: dict, crlf: set[str]):
    """Second look: the records that lie whole in a split, less each file's first."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = reader = None
        header = False
        for batch in batches:
            for run in runs(batch):
                path, start, arrival = run.split
                if path in states and states[path] is None:
                    continue  # left to the one-task read
                if run.split != now:
                    now, header = run.split, start == 0
                    reader = Records(quoting, _state(states, path, start))
                lines, quoted = lines_of(run.rows, quoting.quote)
                single, joined = reader.feed(lines, quoted)
                if header:  # the file's first record
                    at = _first_line(lines, single)
                    if at is not None:
                        single[at], header = False, False
                    elif joined:
                        joined, header = joined[1:], False
                records = _trimmed(run.rows.column(LINE).cast(pa.binary()).filter(
                    pa.array(single)), path in crlf)
                if joined:
                    records = pa.concat_arrays([records, _trimmed(
                        pa.array(joined, pa.binary()), path in crlf)])
                if len(records):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(records), pa.string()),
                         pa.array([arrival] * len(records), pa.int64()), _text(records)],
                        schema=_RECORDS)
    return look


def _state(states: dict, path: str, start: int) -> bool:
    starts, inside = states.get(path, ([], []))
    at = bisect_left(starts, start)
    if at == len(starts) or starts[at] != start:
        raise SplitsChangedError(f"{path}: no split began at {start} at the first look")
    return inside[at]


def _trimmed(records: pa.Array, crlf: bool) -> pa.Array:
    """Without the carriage returns of CRLF line ends, which Spark's reader drops inside
    quotes too where the file's lines end so, and without empty lines."""
    if crlf:
        records = pc.replace_substring(pc.replace_substring_regex(records, "\\r\\z", ""),
                                       b"\r\n", b"\n")
    return records.filter(pc.greater(pc.binary_length(records), 0))


def _text(records: pa.Array) -> pa.Array:
    """As text; bytes that aren't UTF-8 become replacement characters."""
    try:
        return records.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([r.decode("utf-8", "replace") for r in records.to_pylist()], pa.string())


def _compose(rows) -> dict[str, tuple[list[int], list[bool]] | None]:
    """From the splits' maps: per file, where its splits begin and whether each begins
    inside a field; None for files to be read by one task."""
    found: dict[str, tuple[list[int], list[bool]]] = {}
    left: set[str] = set()
    for r in sorted(rows, key=lambda r: (r[PATH], r[START])):
        starts, inside = found.setdefault(r[PATH], ([], [False]))
        if r["odd"] or r["lost_inside" if inside[-1] else "lost_outside"]:
            left.add(r[PATH])
        starts.append(r[START])
        inside.append(r["from_inside"] if inside[-1] else r["from_outside"])
    # The last state is that of the file's end.
    return {p: None if p in left or s[1][-1] else s for p, s in found.items()}


def _cut_records(spark: SparkSession, edges: DataFrame, states: dict) -> DataFrame:
    """Records that a split's border cuts: each begins with the tail of a split and goes
    on through the heads of the next ones."""
    known = [(p, start, inside) for p, s in states.items() if s for start, inside in zip(*s)]
    begins = spark.createDataFrame(known, "path string, start long, inside boolean")
    pieces = edges.join(begins, [PATH, START]).select(
        PATH, START, ARRIVAL, F.explode(F.array(
            F.struct(F.lit(0).alias("tail"), F.when(F.col("inside"), F.col("head_inside"))
                     .alias("text")),
            F.struct(F.lit(1).alias("tail"), F.when(F.col("inside"), F.col("tail_inside"))
                     .otherwise(F.col("tail_outside")).alias("text")))).alias("p"))
    pieces = pieces.select(PATH, START, ARRIVAL, "p.*").where("text IS NOT NULL")
    in_order = Window.partitionBy(PATH).orderBy(START, "tail")
    chained = pieces.withColumn("chain", F.sum("tail").over(in_order))
    joined = chained.groupBy(PATH, "chain").agg(
        F.max(ARRIVAL).alias(ARRIVAL),
        F.sort_array(F.collect_list(F.struct(START, "tail", "text"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: F.make_valid_utf8(
        p["text"].cast("string"))), "\n")
    ends = edges.where("crlf").select(PATH, "crlf")
    # As in ``_trimmed``: a line feed after the record's end completes its last CRLF.
    plain = F.rtrim(F.replace(F.concat("record", F.lit("\n")), F.lit("\r\n"), F.lit("\n")),
                    F.lit("\n"))
    return (joined.select(PATH, ARRIVAL, text.alias("record")).join(ends, PATH, "left")
            .select(PATH, ARRIVAL, F.when(F.col("crlf"), plain)
                    .otherwise(F.col("record")).alias("record")))


def _session_split(spark: SparkSession) -> int:
    """The session's bytes of a scan partition."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(
        "spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def split_scan(spark: SparkSession, paths: Sequence[str], schema: StructType, options: dict,
               ragged: str, file_column: str, arrival_column: str, limit: int = PIECE_BYTES,
               split_bytes: int | None = None) -> tuple[DataFrame | None, list[str]]:
    """The rows of files with this header, read in splits: the columns of ``schema``
    (``ragged`` among them: the text of rows with another number of fields), each row's
    file and its arrival. Also returns the files to be read by one task, as URIs.
    ``split_bytes`` is the size of a split, by default the session's, at most
    ``MOST_SPLIT_BYTES``."""
    quoting = Quoting(options.get("sep", ","), options.get("quote", '"'))
    folder = f"{scratch_dir(spark, 'split-scan')}/edges"
    fixed = {"minPartitionNum": spark.sparkContext.defaultParallelism}
    split_bytes = split_bytes or min(MOST_SPLIT_BYTES, _session_split(spark))
    fixed |= {"maxPartitionBytes": split_bytes, "openCostInBytes": split_bytes // 8}
    lines = text_lines(scan_session(spark, **fixed), paths)
    lines.mapInArrow(_edges(quoting, limit), _EDGES_DDL).write.parquet(folder)
    edges = spark.read.schema(_EDGES_DDL).parquet(folder)
    small = edges.drop("tail_outside", "head_inside", "tail_inside").collect()
    states = _compose(small)
    left = sorted(p for p, s in states.items() if s is None)
    if len(left) == len(states):
        return None, left
    crlf = {r[PATH] for r in small if r["crlf"]}
    records = lines.mapInArrow(_whole(quoting, states, crlf),
                               "path string, arrival long, record string")
    records = records.unionByName(_cut_records(spark, edges, states))
    parse = {"sep": options.get("sep", ","), "quote": quoting.quote.decode(),
             "escape": quoting.quote.decode(), "lineSep": "\n", "multiLine": "true",
             "mode": "PERMISSIVE", "columnNameOfCorruptRecord": ragged}
    parse |= {k: str(v) for k, v in options.items()
              if k not in ("sep", "quote", "escape", "multi_line")}
    ddl = ", ".join(f"{sql_name(f.name)} string" for f in schema.fields)
    rows = records.select(F.from_csv("record", ddl, parse).alias(_ROW),
                          F.col(PATH).alias(file_column),
                          F.timestamp_micros(ARRIVAL).alias(arrival_column))
    return rows.select(f"{_ROW}.*", file_column, arrival_column), left
