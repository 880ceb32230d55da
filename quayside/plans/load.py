"""A whole load as one lazy plan with one write: P1 and P4.

    check format -> ensure target -> scan per header -> (empty?) -> load time,
    source, key per header -> dedup with group sizes (the one shuffle)
    -> observe counts -> drop rejected -> mapping -> write run -> commit -> audit

The counts are read from the observation once the write has succeeded, and
checked to add up before the run is committed.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.hashing import check_profile, quoted
from quayside.functions.paths import (CSV_GLOB, UnsupportedFormatError, check_format,
                                      literal_path)
from quayside.operators.audit import (EMPTY, FAILED, SUCCESS, FileCounts, LoadCounts,
                                      audit_record, file_counts, observe_load, write_audit,
                                      write_file_audit)
from quayside.operators.columns import (COLLISION_POLICIES, KEY, LOAD_TIME, SOURCE_FILE,
                                        TARGET_TIME, ColumnCollisionError, add_metadata,
                                        apply_mapping, ensure_id, find_column, load_time,
                                        resolve_collisions)
from quayside.operators.quality import (COPIES, GROUP, RAGGED, dedup_counted, dedup_rows,
                                        spread)
from quayside.plans import files
from quayside.plans import target as tgt
from quayside.sources.csv import (ARRIVAL_COLUMN, DEFAULT_ESCAPE, FILE_COLUMN, RAGGED_COLUMN,
                                  is_empty, list_files, scan_groups)

# Whether a row's own file gives it all that the load requires; consumed by the dedup.
_VALID = "__qs_valid"
_WORKING = (FILE_COLUMN, ARRIVAL_COLUMN, RAGGED_COLUMN, _VALID)

log = logging.getLogger("quayside.load")


@dataclass(frozen=True)
class LoadConfig:
    """Everything a load takes besides the input."""
    target: str
    key: str = KEY
    profile: str = "content"
    required: tuple[str, ...] = (KEY,)
    order_by: tuple[str, ...] | None = None
    keep: str = "last"
    ts: object = None
    on_collision: str = "error"
    time_name: str = TARGET_TIME
    mappings: tuple | None = None
    escape: str = DEFAULT_ESCAPE
    multi_line: bool = True
    same_header: bool = False
    split_over: int | None = None    # bytes beyond which a multi-line file is read in splits
    split_bytes: int | None = None   # and the size of those; default: the session's, 16 MB at most
    write_partitions: int | None = None
    compact_every: int | None = None
    csv_options: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        # A load refuses to start on a missing or unknown setting.
        if not self.target:
            raise ValueError("LoadConfig.target is required")
        if not self.key:
            raise ValueError("LoadConfig.key is required")
        check_profile(self.profile)
        if self.keep not in ("first", "last"):
            raise ValueError("LoadConfig.keep must be 'first' or 'last'")
        if self.on_collision not in COLLISION_POLICIES:
            raise ValueError(f"LoadConfig.on_collision must be one of {COLLISION_POLICIES}")
        if self.write_partitions is not None and self.write_partitions < 1:
            raise ValueError("LoadConfig.write_partitions must be positive")
        if self.compact_every is not None and self.compact_every < 1:
            raise ValueError("LoadConfig.compact_every must be positive")

    def with_(self, **changes) -> "LoadConfig":
        return replace(self, **changes)


@dataclass(frozen=True)
class LoadResult:
    batch_id: int
    source: str
    target: str
    counts: LoadCounts
    status: str
    message: str | None = None
    source_schema: str | None = None


def prepare(df: DataFrame | Sequence[DataFrame], config: LoadConfig, source: str | None = None,
            root: str | None = None, source_column: str | None = None,
            per_file: bool = False):
    """The lazy load plan over a scanned frame, or over one frame per header.

    Returns ``(mapped_frame, observation)``; nothing runs until the frame
    is written.

    Key, row hash, required columns and name collisions are settled for each
    header by its own columns, as if each file were loaded alone; the frames are
    then stacked by name. Of rows with one key that of the file that arrived
    last stays; ``order_by`` decides within a file.

    When the key is the content hash of one file's rows (profile
    ``content``, no key column in the file, one literal source, nothing else
    required), rows with equal keys are exactly the rows with equal values,
    so the dedup groups by the source columns themselves: a hash aggregate
    with map-side combine, the key computed once per distinct row after it.
    Otherwise the dedup picks a survivor per key (sort aggregate, also
    combined map-side). ``per_file`` also counts each file's rows in it.
    """
    frames = [df] if isinstance(df, DataFrame) else list(df)
    if source is not None:
        # One key names the whole load: per-row file and arrival are not data.
        frames = [f.drop(ARRIVAL_COLUMN, *([source_column] if source_column else []))
                  for f in frames]
        source_column = None
    if len(frames) == 1 and _content_key(frames[0], config) and source is not None:
        counted = _dedup_by_content(frames[0], config, source)
    else:
        keyed = [_keyed(f, config, source, root, source_column) for f in frames]
        stacked = tgt.merge_schemas(keyed)
        arrival, ragged = (c if c in stacked.columns else None
                           for c in (ARRIVAL_COLUMN, RAGGED_COLUMN))
        counted = dedup_counted(stacked, config.key, config.order_by, config.keep,
                                quoted(_VALID), arrival, ragged,
                                SOURCE_FILE if per_file else None).drop(_VALID)
    kept, obs = observe_load(counted)
    mapped = apply_mapping(kept, config.mappings, key=config.key, time_name=config.time_name)
    return mapped, obs


def _keyed(df: DataFrame, config: LoadConfig, source: str | None, root: str | None,
           source_column: str | None) -> DataFrame:
    """One header's rows with load time, source and key."""
    df = add_metadata(df, source, config.ts, root=root, on_collision=config.on_collision,
                      time_name=config.time_name, source_column=source_column)
    df = ensure_id(df, config.profile, config.key, ignore=_WORKING)
    valid = F.lit(True)
    for c in (find_column(df, r) for r in config.required):
        if c:
            valid = valid & quoted(c).isNotNull()
    return df.withColumn(_VALID, valid)


def _content_key(df: DataFrame, config: LoadConfig) -> bool:
    """True when the key will be the content hash and nothing else is
    required: equal keys are then exactly equal rows."""
    return (config.profile == "content" and find_column(df, config.key) is None
            and all(r.lower() == config.key.lower() for r in config.required))


def _dedup_by_content(df: DataFrame, config: LoadConfig, source: str) -> DataFrame:
    df = resolve_collisions(df, (LOAD_TIME, SOURCE_FILE, config.time_name),
                            config.on_collision)
    ragged = RAGGED_COLUMN if RAGGED_COLUMN in df.columns else None
    rows = dedup_rows(df, config.key, with_copies=True, ragged=ragged)
    return rows.select(*[quoted(c) for c in df.columns if c != ragged],
                       load_time(config.ts).alias(LOAD_TIME),
                       F.lit(source).alias(SOURCE_FILE),
                       F.col(config.key), F.col(config.key).alias(GROUP), COPIES,
                       *([RAGGED] if ragged else []))


def load_frame(spark: SparkSession, df: DataFrame | Sequence[DataFrame], config: LoadConfig,
               source_label: str, source: str | None = None, root: str | None = None,
               source_column: str | None = None, note: str | None = None,
               once: bool = False, arrived: Sequence[str] | None = None,
               keep_failure: bool = True) -> LoadResult:
    """Run the load of an already scanned frame (or one per header) into
    ``config.target``. Loads may overlap (P5): each writes a folder of its own
    and counts from its commit on. ``once`` notes the label before writing, so
    that :func:`quayside.plans.target.already_loaded` knows a replay. ``arrived``
    names the files that arrived, for an audit row of each. Without ``keep_failure``
    a failure leaves no record; the caller sees to it."""
    tgt.ensure_target(spark, config.target, config.key)
    frames = [df] if isinstance(df, DataFrame) else list(df)
    run = tgt.new_run()
    if once:
        tgt.start_label(spark, config.target, source_label, run)
    fields = {f.name: f.dataType.simpleString() for x in frames for f in x.schema.fields
              if f.name not in (source_column, *_WORKING)}
    schema = ", ".join(f"{n} {t}" for n, t in fields.items())

    def done(counts, status, message, rows=False, per_file=()):
        n = tgt.commit(spark, config.target, run, rows=rows)
        result = LoadResult(n, source_label, config.target, counts, status, message, schema)
        _store(spark, result)
        if arrived is not None:
            seen = {f.source_file for f in per_file}
            none = [FileCounts(name, LoadCounts(), EMPTY, "no records in source")
                    for name in sorted(set(arrived) - seen)]
            write_file_audit(spark, n, [*per_file, *none], config.target)
        return result

    if all(is_empty(x) for x in frames):
        return done(LoadCounts(), EMPTY, "no records in source")
    if source is None and source_column is None:
        # Name each row's file while the scan is still the frame's source.
        frames = [x.select("*", F.col("_metadata.file_path").alias(FILE_COLUMN)) for x in frames]
        source_column = FILE_COLUMN
    try:
        mapped, obs = prepare([spread(x) for x in frames], config, source, root, source_column,
                              arrived is not None)
        folder = tgt.write_run(mapped, config.target, run, config.key, config.write_partitions)
        counts = LoadCounts.from_metrics(obs.get).check()
        per_file = [] if arrived is None else file_counts(
            obs.get["files"], _written_by_file(spark, folder, mapped, config), counts)
    except Exception as exc:
        # Nothing of a failed load is readable; its own folder goes.
        tgt.drop_run(spark, config.target, run)
        if not keep_failure:
            raise
        run = tgt.new_run()  # a label stays open for its next try
        done(LoadCounts(), FAILED, f"{type(exc).__name__}: {exc}")
        raise
    if counts.malformed:
        said = f"{counts.malformed} rows whose number of fields isn't the header's"
        note = f"{note}; {said}" if note else said
    result = done(counts, SUCCESS, note, rows=True, per_file=per_file)
    if config.compact_every:
        tgt.compact_if_due(spark, config.target, config.compact_every, config.key)
    return result


def _written_by_file(spark: SparkSession, folder: str, mapped: DataFrame,
                     config: LoadConfig) -> dict[str, int]:
    """Rows of a written run by their file: one dictionary-coded column is read back."""
    named = {m[0]: m[2] for m in config.mappings or ()}
    column = named.get(SOURCE_FILE, SOURCE_FILE)
    if column not in mapped.columns:
        raise ValueError(f"counts per file need the target column of {SOURCE_FILE!r}")
    rows = spark.read.parquet(folder).groupBy(quoted(column).alias("f")).agg(
        F.count("*").alias("n")).collect()
    return {r["f"]: r["n"] for r in rows}


def refuse(spark: SparkSession, config: LoadConfig, source: str, message: str,
           name: str | None = None, status: str = FAILED) -> LoadResult:
    """Store that a source isn't loaded; ``name`` is an arrived file's key."""
    tgt.ensure_target(spark, config.target, config.key)
    n = tgt.commit(spark, config.target, tgt.new_run(), rows=False)
    result = LoadResult(n, source, config.target, LoadCounts(), status, message)
    _store(spark, result)
    if name:
        write_file_audit(spark, n, [FileCounts(name, LoadCounts(), status, message)],
                         config.target)
    return result


def counts_files(config: LoadConfig) -> bool:
    """Whether the target keeps each row's file, which counts per file need."""
    return config.mappings is None or any(m[0] == SOURCE_FILE for m in config.mappings)


def loadable(df: DataFrame, config: LoadConfig) -> str | None:
    """Why a header can't be loaded, or None."""
    try:
        data = df.drop(*_WORKING)
        resolve_collisions(data, (LOAD_TIME, SOURCE_FILE, config.time_name), config.on_collision)
    except ColumnCollisionError as exc:
        return f"{type(exc).__name__}: {exc}"
    return None


def scan(spark: SparkSession, paths: Sequence[str], config: LoadConfig,
         sizes: dict[str, int] | None = None):
    """S1 as ``config`` says: one frame per header, with its files."""
    return scan_groups(spark, paths, config.same_header, sizes, config.split_over,
                       config.split_bytes, escape=config.escape, multi_line=config.multi_line,
                       **config.csv_options)


def run_load(spark: SparkSession, path: str | Sequence[str], config: LoadConfig,
             key: str | None = None, root: str | None = None) -> LoadResult:
    """Load headered CSV at ``path`` into the keyed target.

    ``path`` is a file, a folder or a list of them. ``key`` is the object
    key recorded as ``source_file`` (the reference records the key, not the
    URI); without it each row records its own file, less ``root``. The
    format gate runs before the target is touched (D12): a file must end in
    ``.csv``; from a folder, the ``.csv`` files are taken (any case, not
    recursive), and a folder without one is refused. A path that exists is
    taken literally, whatever characters it holds; another may be a glob. Files whose headers
    differ are read per header, unless ``same_header`` says they share one.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if key:
        check_format(key)
    inputs: dict[str, int] = {}
    for p in paths:
        if files.is_dir(spark, p):
            listed = list_files(spark, literal_path(p), CSV_GLOB)
            if not listed:
                raise UnsupportedFormatError(f"no CSV files in {p}")
            inputs |= listed
        elif any(ch in p for ch in "*?[{") and not files.exists(spark, p):
            listed = list_files(spark, p)
            if not key:
                for f in listed:
                    check_format(f)
            inputs |= listed
        else:
            if not key:
                check_format(p)
            inputs[p] = files.size_of(spark, p)
    groups = scan(spark, list(inputs), config, inputs)
    frames = [df for df, _files in groups] or [spark.createDataFrame([], f"{FILE_COLUMN} string")]
    return load_frame(spark, frames, config, key or ",".join(paths), source=key, root=root,
                      source_column=FILE_COLUMN)


def _store(spark: SparkSession, r: LoadResult) -> None:
    write_audit(spark, audit_record(r.batch_id, r.source, r.target, r.counts, r.status,
                                    r.message, r.source_schema), r.target)
    log.info("load %s batch %s into %s: read %d, null rejected %d, duplicates %d, "
             "written %d, status %s%s", r.source, r.batch_id, r.target, r.counts.read,
             r.counts.null_rejected, r.counts.duplicates, r.counts.written, r.status,
             f" ({r.message})" if r.message else "")
