"""Best-fit packing by minimum bin slack.

Method. Texts become pieces of at most ``capacity`` tokens. For one bin at a
time, a subset-sum dynamic programme over the lengths still there (a bitset of
reachable fills, longest lengths first) finds the fullest combination that holds
the longest of them; the combination is then taken off, as many times as the
counts allow.

At scale. Pieces of one length are interchangeable, so the programme needs the
length histogram alone: at most ``capacity`` counts on the driver, whatever the
corpus. Which piece gets which place is settled in Spark: pieces are ranked
within their length, in salted parts of about ``rank_rows`` rows whose offsets
come from one aggregate, and a rank names its bin and offset. A hot length is
spread over as many parts as it needs.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.bpe import SLICE, WORDS, Vocabulary, read_vocabulary
from quayside.llm.frames import handing_back, in_slices, kept_by, written

OPERATOR = "packing"
# tiktoken's word split fails on white space of about a million characters.
GAP = 10_000
_GAPS = regex.compile(r"\p{White_Space}{%d,}" % GAP)
_SOME = re.compile(r"\s{9}")  # in every 1000th character, where there is a gap


def _encoder(text: str) -> Callable[[str], bytes]:
    """One encoder per Python worker, over all its tasks until another operator's run."""
    kept, key = kept_by(OPERATOR), hash(text)
    if key not in kept:
        kept[key] = library_encoder(text)
    return kept[key]


def library_encoder(text: str) -> Callable[[str], bytes]:
    """Texts to ids as the tokenizers library gives them for this vocabulary.

    Where a token's id tells its merge's rank, tiktoken's merge loop gives the
    same ids several times faster; else the library itself encodes. White space of
    ``GAP`` characters or more is split off before tiktoken sees the text."""
    vocabulary = Vocabulary(text)
    made = [w for _, _, w in vocabulary.merges]
    if made != sorted(made) or min(made, default=0) <= max(vocabulary.bytes.values()):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(text)
        library.no_truncation()
        library.no_padding()
        return lambda x: array("I", library.encode(x, add_special_tokens=False).ids).tobytes()
    import tiktoken

    ranks = {label: i for i, label in vocabulary.labels.items()
             if i not in vocabulary.added.values()}
    loop = tiktoken.Encoding("packing", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
    added = vocabulary.added
    parts = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def plain(x: str) -> list[int]:
        if len(x) < GAP or not _SOME.search(x[::GAP // 10]):
            return loop.encode_ordinary(x)
        out, at = [], 0
        for gap in _GAPS.finditer(x):
            # One word, but for its last character if a visible one follows.
            end = gap.end() - (gap.end() < len(x))
            out += loop.encode_ordinary(x[at:gap.start()])
            out += loop._encode_single_piece(x[gap.start():end])
            at = end
        return out + loop.encode_ordinary(x[at:])

    def encode(x: str) -> bytes:
        out = array("I")
        for k, part in enumerate(parts.split(x) if parts else [x]):
            out.extend([added[part]] if k % 2 else plain(part))
        return out.tobytes()

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: whole if it fits; else full
    pieces, of which the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def token_pieces(docs: DataFrame, vocabulary: str, *, capacity: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids``: each text's ids, then ``end_id``,
    cut into pieces. ``ids`` are little-endian unsigned 32-bit. A null or empty
    text is one piece that holds ``end_id`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(shared.value)
        for rows in in_slices(SLICE)(batches):
            out = []
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                ids = encode(text) + end
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc_id, k, start, n, ids[4 * start:4 * (start + n)]))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(handing_back(run, OPERATOR),
                            "doc_id long, piece int, start long, length long, ids binary")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of the lengths in ``counts`` that fills ``room`` best;
    among equals, one that uses the longest lengths."""
    reach, steps = 1, []
    mask = (1 << room + 1) - 1
    for size in sorted((s for s in counts if counts[s] and s <= room), reverse=True):
        left, take = min(counts[size], room // size), 1
        while left:
            take = min(take, left)
            steps.append((size, take, reach))
            reach |= reach << size * take & mask
            left, take = left - take, take * 2
        if reach >> room:
            break
    at, out = reach.bit_length() - 1, {}
    for size, take, before in reversed(steps):
        if not before >> at & 1:
            out[size] = out.get(size, 0) + take
            at -= size * take
    return out


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Bins for all pieces: how often each combination is used."""
    counts, out = dict(histogram), []
    while longest := max((s for s, n in counts.items() if n), default=0):
        counts[longest] -= 1
        bin_ = fullest(counts, capacity - longest)
        counts[longest] += 1
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(counts[s] // n for s, n in bin_.items())
        for s, n in bin_.items():
            counts[s] -= n * times
        out.append((times, bin_))
    return out


def places(bins: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """One row for each combination and length in it: length, first rank, number
    in a bin, first bin, offset; by length and rank."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for times, bin_ in bins:
        offset = 0
        for size, n in sorted(bin_.items(), reverse=True):
            rows.append((size, used.get(size, 0), n, base, offset))
            used[size] = used.get(size, 0) + n * times
            offset += size * n
        base += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, *, capacity: int = 2048, rank_rows: int = 50_000) -> DataFrame:
    """``pieces`` (any columns, with a ``length`` from 1 to ``capacity``) with
    ``sequence_id`` and ``offset`` (earlier columns of these names go). Every row is placed, repeated rows too; an
    empty table gives an empty table. ``pieces`` should be written data."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if any(s is None or not 0 < s <= capacity for s in counts):
        raise ValueError(f"piece lengths go from 1 to {capacity}")
    table = spark.sparkContext.broadcast(places(plan(counts, capacity)))
    salts = -(-max(counts.values(), default=1) // rank_rows)
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    key = F.xxhash64(*columns)
    salted = pieces.withColumn("_salt", F.pmod(key, F.lit(salts)).cast("int"))
    sums = salted.groupBy("length", "_salt").count()
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "_salt",
                       F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_salt").orderBy(*columns)
    ranked = (salted.withColumn("_at", F.row_number().over(within) - 1)
              .join(sums, ["length", "_salt"])
              .select(*columns, (F.col("_before") + F.col("_at")).cast("long").alias("_rank")))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = table.value
        wide = np.int64(1) << np.int64(44)
        size, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        row = t[np.searchsorted(t[:, 0] * wide + t[:, 1], size * wide + rank, side="right") - 1]
        at = rank - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + at // row[:, 2],
                             "offset": row[:, 4] + at % row[:, 2] * size})

    return (ranked.withColumn("_place", place("length", "_rank"))
            .select(*columns, "_place.sequence_id", "_place.offset"))


def pack_documents(docs: DataFrame, vocabulary: str, *, capacity: int = 2048,
                   end_id: int = 0) -> DataFrame:
    """Pack every document of ``docs`` (``doc_id, text``).

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, one
    row per piece. A null or empty text is one piece of one id; a null id stays
    null; repeated rows are packed as often as they occur; an empty table gives
    an empty table; other columns are ignored."""
    pieces = token_pieces(docs, vocabulary, capacity=capacity, end_id=end_id)
    digests = pieces.select("doc_id", "piece", "start", "length",
                            F.crc32("ids").alias("ids_crc32"))
    return pack(written(digests, "pieces"), capacity=capacity)
