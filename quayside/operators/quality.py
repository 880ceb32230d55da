"""Required columns, dedup and distribution: F1-F3.

Dedup is an aggregate, never a window over whole groups: every map task
first reduces each key to one candidate (partial aggregation), so a key
holding a third of all rows still sends only one row per task through the
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.hashing import quoted
from quayside.operators.columns import find_column

# Working columns of the dedup; names no file header uses.
COPIES = "__qs_copies"
GROUP = "__qs_key"
RAGGED = "__qs_malformed"
# Groups that count one file's rows, and their number of rejected rows.
FILE_GROUP = "__qs_file_group"
REJECTED = "__qs_rejected"
_WINNER = "__qs_winner"
_COUNTS_FILE = "__qs_counts_file"


def require_not_null(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """split into rows with every required column set, and the rest.

    Required columns missing from ``df`` are ignored (matched without case).
    """
    present = [find_column(df, c) for c in columns]
    present = [c for c in present if c is not None]
    if not present:
        return df, df.limit(0)
    cond = F.lit(True)
    for c in present:
        cond = cond & quoted(c).isNotNull()
    return df.filter(cond), df.filter(~cond)


def _pick(keep: str):
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    return F.max if keep == "last" else F.min


def _packed(columns: Sequence[str], order_by: Sequence) -> Column:
    """A row as one value: the order first, then its other values; a column is
    carried once."""
    first = [c for c in order_by if isinstance(c, str) and c in columns]
    order = [(c if isinstance(c, Column) else quoted(c)).alias(f"_o{i}")
             for i, c in enumerate(order_by)]
    rest = [quoted(c).alias(f"_c{i}") for i, c in enumerate(columns) if c not in first]
    return F.struct(*order, *rest, F.lit(0).alias("_end"))


def _winner(columns: Sequence[str], order_by: Sequence, keep: str) -> Column:
    """The surviving row of a group."""
    return _pick(keep)(_packed(columns, order_by))


def _unpacked(columns: Sequence[str], order_by: Sequence) -> list[Column]:
    """The columns of a ``_packed`` row, in order."""
    at = {c: f"_o{i}" for i, c in reversed(list(enumerate(order_by))) if isinstance(c, str)}
    return [F.col(f"{_WINNER}.{at.get(c, f'_c{i}')}").alias(c) for i, c in enumerate(columns)]


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
          keep: str = "last") -> DataFrame:
    """one row per key.

    With ``order_by`` the survivor is the last (or first) row in that order;
    ties, and the case without an order, are settled by the row's own
    values, so the survivor never depends on input order (D7).
    """
    keys, order = list(keys), list(order_by or [])
    others = [c for c in df.columns if c not in keys]
    out = (df.groupBy(*[quoted(k) for k in keys])
             .agg(_winner(others, order, keep).alias(_WINNER)))
    by_name = dict(zip(others, _unpacked(others, order)))
    return out.select(*[by_name.get(c, quoted(c)) for c in df.columns])


def dedup_rows(df: DataFrame, key: str = "id", with_copies: bool = False,
               ragged: str | None = None) -> DataFrame:
    """F2 for content keys: one row per distinct row, keyed by its content
    hash (profile ``content``) in ``key``; with ``with_copies`` also the
    number of copies in ``__qs_copies`` (``COPIES``).

    Equal content keys are exactly equal rows (the encoding is injective),
    so grouping by the columns themselves gives the same rows as a dedup by
    key. Grouping keys are plain columns, which plans as a code-generated
    hash aggregate with map-side combine, and the hash is computed once per
    distinct row, after the shuffle.
    """
    from quayside.functions.hashing import row_hash

    cols = [c for c in df.columns if c != ragged]
    counts = [F.count(F.lit(1)).alias(COPIES)] + _ragged(ragged)
    groups = df.groupBy(*[quoted(c) for c in cols]).agg(*counts)
    out = [quoted(c) for c in cols] + [row_hash(cols, "content").alias(key)]
    return groups.select(*out, *([COPIES] if with_copies else []), *([RAGGED] if ragged else []))


def _ragged(column: str | None) -> list[Column]:
    """The group's number of rows with the wrong number of fields."""
    return [F.count(F.col(column)).alias(RAGGED)] if column else []


def dedup_counted(df: DataFrame, key: str, order_by: Sequence[str] | None = None,
                  keep: str = "last", valid: Column | None = None,
                  arrival: str | None = None, ragged: str | None = None,
                  per_file: str | None = None) -> DataFrame:
    """F2 for a load: one row per key plus ``GROUP`` (the group key, null for
    rejected rows) and ``COPIES`` (the group size).

    ``arrival`` names the time at which a row's file arrived: a later file's row
    wins whatever ``keep`` says of rows of one file. ``ragged`` names the text of
    malformed rows, counted in ``RAGGED``. Both columns are consumed.

    Rows with a null key, or failing ``valid`` (the F1 test), form one
    group; the caller counts it as rejected and drops it. Counting inside
    the aggregate puts every load count after the shuffle, where retried
    tasks are counted once.

    ``per_file`` names the file column of a load of several files. The same
    aggregate then has one more group for each file, named in ``FILE_GROUP`` (null
    for the keys' groups), with the file's rows in ``COPIES``, ``RAGGED`` and
    ``REJECTED``. A map task sends one narrow row for each file it reads.
    """
    group = quoted(key) if valid is None else F.when(valid, quoted(key))
    columns = [c for c in df.columns if c not in (arrival, ragged)]
    order = list(order_by or [])
    if arrival:
        time = F.unix_micros(quoted(arrival))
        order.insert(0, time if keep == "last" else -time)
    if per_file is None:
        return (df.groupBy(group.alias(GROUP))
                  .agg(_winner(columns, order, keep).alias(_WINNER),
                       F.count(F.lit(1)).alias(COPIES), *_ragged(ragged))
                  .select(*_unpacked(columns, order), GROUP, COPIES,
                          *([RAGGED] if ragged else [])))
    # Every row counts twice: for its key, with its values, and for its file, without.
    counts_file = F.col(_COUNTS_FILE)
    twice = df.withColumn(_COUNTS_FILE, F.explode(F.array(F.lit(False), F.lit(True))))
    slim = twice.select(
        F.when(~counts_file, group).alias(GROUP),
        F.when(counts_file, quoted(per_file)).alias(FILE_GROUP),
        F.when(~counts_file, _packed(columns, order)).alias(_WINNER),
        (counts_file & group.isNull()).alias(REJECTED),
        *([quoted(ragged)] if ragged else []))
    return (slim.groupBy(GROUP, FILE_GROUP)
                .agg(_pick(keep)(_WINNER).alias(_WINNER), F.count(F.lit(1)).alias(COPIES),
                     F.count_if(REJECTED).alias(REJECTED), *_ragged(ragged))
                .select(*_unpacked(columns, order), GROUP, FILE_GROUP, COPIES, REJECTED,
                        *([RAGGED] if ragged else [])))


# The dedup sorts a task's rows, each twice where files are counted: narrow rows take
# about 40 times their bytes in the file.
SPREAD_BYTES = 8 * 1024 * 1024


def spread(df: DataFrame, min_partitions: int | None = None,
           bytes_per_partition: int = SPREAD_BYTES) -> DataFrame:
    """Spread a file scan whose partitions are far larger than ``bytes_per_partition``.

    A multi-line CSV file is read by one task; without this the hashing and
    the map-side aggregation of a large file would stay in that task. Rows
    are hash-partitioned on their position in the scan, which spreads them
    evenly whatever their content (a hot value cannot land in one task) and
    needs no sort, unlike a round-robin repartition. The number of partitions
    follows the files' bytes. Scans with enough partitions, or with one for
    every core, are left alone.
    """
    from quayside.plans.files import total_size

    have = df.rdd.getNumPartitions()
    if not min_partitions and have >= df.sparkSession.sparkContext.defaultParallelism:
        return df  # every core has work; files' sizes needn't be asked for
    want = min_partitions or -(-total_size(df.sparkSession, df.inputFiles())
                               // bytes_per_partition)
    if have >= want or not min_partitions and want < 2:
        return df
    return df.repartition(want, F.monotonically_increasing_id()).select(
        *[quoted(c) for c in df.columns])


def redistribute(df: DataFrame, n: int | None = None, key: str | None = "id") -> DataFrame:
    """hash-partition on ``key`` (``n`` parts, or as AQE decides).

    Off in a load by default: the dedup shuffle already partitions by key.
    """
    if key is None:
        return df.repartition(n) if n else df.repartition()
    return df.repartition(n, quoted(key)) if n else df.repartition(quoted(key))
