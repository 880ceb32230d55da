"""Removal of byte strings that a document with a smaller id holds too.

Method. Blockwise suffix sorting to depth ``length`` with a cover sample:

* Cover sample. In every string of ``length`` bytes the smallest of its hashed
  ``GRAM``-byte substrings is sampled. Like a difference cover, the sample meets
  any two equal strings at the same offset; unlike one it follows the content,
  which needs a third of the positions and lets a sample be looked up by value.
* Blocks. The sampled substrings are ranked by their number of occurrences; the
  suffixes around samples that occur once in the corpus cannot match and go no
  further. The others fall into suffix buckets by their sample's hash.
* A bucket is sorted at a time, and what a task holds is one bucket of about
  ``bucket_rows`` samples. Suffixes are compared by the 128-bit names of their
  first ``length`` bytes, computed once from prefix sums, so long ties cost no
  more than short ones. Equal neighbours of a larger id are removed.
* A hot sample (more than ``bucket_rows`` occurrences: a short line that many
  documents hold between texts of their own, a long run of one byte) would fill a
  bucket alone. Its strings go one by one to the bucket of their 128-bit name.
  Before, equal strings of a document that overlap become one row, and of equal
  strings met together only the smallest id's goes on; the others are settled.

At scale. Texts are not shuffled to find matches: only sample counts (one number
each, combined per batch) and the text around repeated samples are. The repeated
samples reach the scan as a blocked Bloom filter of at most ``filter_bytes``; if
they would need more, the sample space is worked off in that many passes. Copies
of a text, and of a text part, within a batch are settled there, so a text or a
passage held by a third of all documents sends one row per batch. The last step
joins spans to texts by id, and only the texts that may have spans are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.bloom import key_filter, may_hold
from quayside.llm.frames import hand_back, handing_back, in_slices, written

GRAM = 20
SLICE = 256
SETTLED = 2048  # rows whose copies are settled together
AROUND = 1 << 15  # rows around samples held by a task, each at most 2 * length bytes
CHUNK = 1 << 18  # bytes looked at together; longer texts are taken in parts
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, hence invertible modulo 2 ** 64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        _POWERS[base] = tuple(
            np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, b, dtype=np.uint64)])
            for b in (base, inverse))
    return _POWERS[base]


def names(data: np.ndarray, size: int, base: int) -> np.ndarray:
    """A 64-bit name of each substring of ``size`` bytes: equal strings have
    equal names wherever they stand."""
    up, down = _powers(base, len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    out = (sums[size:] - sums[:-size]) * down[:len(data) - size + 1]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def samples(data: np.ndarray, ends: np.ndarray, length: int):
    """Cover samples of texts laid end to end (``ends``: where each ends).

    Returns for each run of strings with one sample: the sample's name, the
    first and last start of the strings, and the text's number."""
    none = np.empty(0, dtype=np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    grams = names(data, GRAM, BASE[0])
    low = np.uint64((1 << 24) - 1)
    best = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, have = length - GRAM + 1, 1
    while have < width:  # smallest of `width` in a row, by doubling
        step = min(have, width - have)
        best = np.minimum(best[:len(best) - step], best[step:])
        have += step
    at = (best & low).astype(np.int64)
    start = np.arange(len(at))
    text = np.searchsorted(ends, start, side="right")
    fits = start + length <= ends[text]
    start, at, text = start[fits], at[fits], text[fits]
    if not len(at):
        return none.astype(np.uint64), none, none, none
    new = np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)] - 1
    # The smallest names crowd at one end; mixed again, they spread evenly.
    key = grams[at[first]] * np.uint64(BASE[1])
    return key ^ (key >> np.uint64(31)), start[first], start[last], text[first]


def parts(docs, texts, length: int):
    """Texts in chunks of about ``CHUNK`` bytes: ids, where each text's part
    begins in its text, the bytes, and the parts' ends. A longer text is cut
    into parts that overlap by ``length - 1`` bytes, so that each string is in
    exactly one."""
    ids, begins, held, size = [], [], [], 0

    def chunk():
        return (np.array(ids, dtype=np.int64), np.array(begins, dtype=np.int64),
                np.frombuffer(b"".join(held), dtype=np.uint8),
                np.cumsum([len(x) for x in held]))

    for doc, text in zip(docs, texts):
        data = bytes(text)
        for at in range(0, max(1, len(data) - length + 1), CHUNK):
            part = data[at:at + CHUNK + length - 1]
            if size and size + len(part) > CHUNK:
                yield chunk()
                ids, begins, held, size = [], [], [], 0
            ids.append(doc)
            begins.append(at)
            held.append(part)
            size += len(part)
    if held:
        yield chunk()


def _smallest_of_copies(batch: pd.DataFrame) -> pd.DataFrame:
    """Of equal texts in a batch the one with the smallest id."""
    batch = batch[batch["doc"].notna()]
    return batch.sort_values("doc", kind="stable").drop_duplicates("h", keep="first")


def _chunks(batch: pd.DataFrame, length: int):
    batch = _smallest_of_copies(batch)
    for rows in in_slices(SLICE)([batch]):
        yield from parts(rows["doc"].astype("int64"), rows["text"], length)


def _repeated_samples(texts: DataFrame, length: int) -> DataFrame:
    """``key, n`` of the samples that occur ``n`` > 1 times in the corpus (copies
    of one text in a batch count once)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [samples(data, ends, length)[0] for _, _, data, ends in _chunks(batch, length)]
            if found:
                key, n = np.unique(np.concatenate(found), return_counts=True)
                yield pd.DataFrame({"key": key.view(np.int64), "n": n})

    return (texts.mapInPandas(handing_back(count), "key long, n long").groupBy("key")
            .agg(F.sum("n").alias("n")).where(F.col("n") > 1))


def _single(data: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray,
            shift: np.ndarray, length: int) -> np.ndarray:
    """The strings that start at ``first`` to ``last`` of each run, as columns
    ``one, two, doc, start, end``. Equal strings of a document that touch are one
    row: they stay or go together. ``shift`` turns a place into one of the text."""
    count = last - first + 1
    run = np.repeat(np.arange(len(first)), count)
    at = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + first[run]
    one, two = (names(data, length, b)[at].view(np.int64) for b in BASE)
    doc, start = doc[run], at + shift[run]
    order = np.lexsort((start, doc, two, one))
    one, two, doc, start = one[order], two[order], doc[order], start[order]
    new = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (doc[1:] != doc[:-1])
                | (start[1:] - start[:-1] > length)]
    a = np.flatnonzero(new)
    b = np.r_[a[1:], len(new)] - 1
    return np.stack([one[a], two[a], doc[a], start[a], start[b] + length])


def _later(one: np.ndarray, two: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a string (by its names) has a smaller id among the others."""
    order = np.lexsort((doc, two, one))
    a, b = one[order], two[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(order)]
    out = np.zeros(len(order), dtype=bool)
    if len(order):
        out[order] = doc[order] > doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


def _settle(found: list[np.ndarray]) -> pd.DataFrame:
    """Rows of single strings, for each name those of the smallest id; the spans
    of the others, joined, are settled."""
    one, two, doc, start, end = np.concatenate(found, axis=1)
    later = _later(one, two, doc)
    keep = ~later
    rows = [pd.DataFrame({"key": one[keep], "two": two[keep], "doc": doc[keep],
                          "start": start[keep], "size": start[keep] - end[keep]})]
    if later.any():
        doc, start, end = doc[later], start[later], end[later]
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], end[order]
        base = np.cumsum(np.r_[True, doc[1:] != doc[:-1]]) << 44  # over any text's size
        reach = np.maximum.accumulate(base + end)
        a = np.flatnonzero(np.r_[True, (base + start)[1:] > reach[:-1]])
        b = np.r_[a[1:], len(doc)] - 1
        rows.append(pd.DataFrame({"key": 0, "two": 0, "doc": doc[a], "start": start[a],
                                  "size": (reach - base)[b] - start[a]}))
    return pd.concat(rows, ignore_index=True).assign(bytes=None)[COLUMNS]


def _settle_around(found: list[pd.DataFrame]) -> pd.DataFrame:
    """Of equal bytes around a sample those of the smallest id; the others are settled."""
    rows = pd.concat(found, ignore_index=True)
    least = rows.groupby("bytes")["doc"].transform("min")
    rows["bytes"] = rows["bytes"].mask(rows["doc"] > least, None)
    return rows


COLUMNS = ["key", "two", "doc", "start", "bytes", "size"]


def _around(texts: DataFrame, bloom, hot, length: int, turn: int, turns: int) -> DataFrame:
    """Three kinds of rows, ``key, two, doc, start, bytes, size``. The bytes around
    each repeated sample; for one that a smaller id of the batch has in the same
    way, ``bytes`` is null and ``size`` tells its extent. For a hot sample, single
    strings: ``key, two`` are the string's names and ``size`` is negative."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_slices(SETTLED)(batches):
            out, around, single, held = [], 0, [], 0
            for ids, begins, data, ends in _chunks(batch, length):
                key, first, last, text = samples(data, ends, length)
                keep = may_hold(bloom.value, key.view(np.int64))
                if turns > 1:
                    keep &= key % np.uint64(turns) == np.uint64(turn)
                key, first, last, text = key[keep], first[keep], last[keep], text[keep]
                starts = np.r_[0, ends[:-1]]
                if hot is not None:
                    split = may_hold(hot.value, key.view(np.int64))
                    if split.any():
                        t = text[split]
                        single.append(_single(data, first[split], last[split], ids[t],
                                              begins[t] - starts[t], length))
                        held += single[-1].shape[1]
                        if held > CHUNK:
                            yield _settle(single)
                            single, held = [], 0
                        key, first, last, text = (x[~split] for x in (key, first, last, text))
                raw = data.tobytes()
                out.append(pd.DataFrame({
                    "key": key.view(np.int64), "two": 0, "doc": ids[text],
                    "start": first - starts[text] + begins[text],
                    "bytes": [raw[a:b + length] for a, b in zip(first, last)],
                    "size": last - first + length}))
                around += len(out[-1])
                if around > AROUND:
                    yield _settle_around(out)
                    out, around = [], 0
            if single:
                yield _settle(single)
            if out:
                yield _settle_around(out)

    return texts.mapInPandas(
        handing_back(run), "key long, two long, doc long, start long, bytes binary, size long")


def repeated_in_bucket(docs, starts, texts, length: int) -> pd.DataFrame:
    """Sort the suffixes of one bucket: spans of strings that a smaller id of the
    bucket holds too."""
    docs, starts = np.asarray(docs), np.asarray(starts)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum(sizes)
    if not len(data):
        return pd.DataFrame({"doc": [], "start": [], "end": []}, dtype="int64")
    one, two = (names(data, length, b) for b in BASE)
    row = np.repeat(np.arange(len(sizes)), sizes - length + 1)
    before = np.cumsum(sizes - length + 1) - (sizes - length + 1)
    within = np.arange(len(row)) - before[row]
    at = (ends - sizes)[row] + within
    one, two, doc = one[at], two[at], docs[row]
    order = np.lexsort((doc, two, one))
    new = np.r_[True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    gone = np.zeros(len(row), dtype=bool)
    gone[order] = doc[order] > least
    row, begin = row[gone], within[gone] + starts[row[gone]]
    new = np.r_[True, (row[1:] != row[:-1]) | (begin[1:] != begin[:-1] + 1)][:len(row)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(row)][:len(first)] - 1
    return pd.DataFrame({"doc": docs[row[first]], "start": begin[first],
                         "end": begin[last] + length})


def find_repeats(texts: DataFrame, *, length: int, filter_bytes: int,
                 bucket_rows: int) -> DataFrame:
    """``doc, start, end`` of strings that occur in a smaller id, some
    overlapping; ``texts`` has ``doc, text binary, h`` (a digest of the text)."""
    spark = texts.sparkSession
    shared = written(_repeated_samples(texts, length), "repeat-samples")
    count, rows, many = shared.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)),
                                   F.count_if(F.col("n") > bucket_rows)).first()
    turns = max(1, -(-count * 2 // filter_bytes))
    buckets = max(1, -(-rows // (turns * bucket_rows)))

    # What a filter takes for hot too is whole all the same: a key is hot everywhere or nowhere.
    hot = spark.sparkContext.broadcast(key_filter(
        shared.where(F.col("n") > bucket_rows), many, most=filter_bytes)) if many else None

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        around, single = rows["bytes"].notna(), rows["size"] < 0
        found = repeated_in_bucket(*(rows.loc[around, c] for c in ("doc", "start", "bytes")),
                                   length)
        done = rows[~around & ~single]
        apart = rows[single]
        done = pd.concat([done, apart[_later(*(apart[c].to_numpy()
                                               for c in ("key", "two", "doc")))]])
        out = pd.concat([found, done[["doc", "start"]].assign(
            end=done["start"] + done["size"].abs())])
        del rows, done, apart
        hand_back(collect=False)
        return out

    found = []
    for turn in range(turns):
        mine = shared.where(F.pmod(_unsigned_mod("key", turns), F.lit(turns)) == turn)
        bloom = spark.sparkContext.broadcast(key_filter(mine, count // turns, most=filter_bytes))
        # Settled rows go anywhere; the others to their sample's or string's bucket.
        single = F.col("size") < 0
        place = F.when(single, F.xxhash64("key", "two")).when(
            F.col("bytes").isNull(), F.xxhash64("doc", "start")).otherwise(F.xxhash64("key"))
        found.append(_around(texts, bloom, hot, length, turn, turns)
                     .select(F.when(single, F.col("key")).otherwise(F.lit(0)).alias("key"), "two",
                             "doc", "start", "bytes", "size",
                             F.pmod(place, F.lit(buckets)).alias("bucket"))
                     .groupBy("bucket").applyInPandas(sort, "doc long, start long, end long"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _unsigned_mod(name: str, n: int):
    """``name`` taken as unsigned, modulo ``n``."""
    high = F.shiftrightunsigned(name, 1) % n * 2
    return (high + F.col(name).bitwiseAND(F.lit(1))) % n


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, *, length: int = 50, id_col: str = "doc_id",
                   text_col: str = "text", filter_bytes: int = 64 << 20,
                   bucket_rows: int = 10_000, as_text: bool = False) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts
    in a document with a smaller id; strings are judged on the input.

    Returns ``docs`` with ``n_bytes, spans array<struct<start, end>>, kept
    binary`` (earlier columns of these names go): the maximal removed runs and
    the bytes that stay, one row per row. A null text counts as empty. A row
    without an id loses nothing and takes nothing from others. Repeated rows are
    one document, each returned; rows that share an id but not a text lose
    nothing, though others lose what they hold. Texts are taken whole, whatever
    their length; other columns stay; an empty table gives an empty table. With
    ``as_text`` ``kept`` is text: bytes of a character that is cut in two go too."""
    spark = docs.sparkSession
    docs = docs.drop("n_bytes", "spans", "kept")
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8")
    doc = F.col(id_col).cast("long")
    texts = docs.select(doc.alias("doc"), text.alias("text")).withColumn("h", F.md5("text"))
    base = written(texts.select("doc", "h", F.octet_length("text").cast("long").alias("n")),
                   "repeat-base")
    spans = find_repeats(texts, length=length, filter_bytes=filter_bytes, bucket_rows=bucket_rows)
    spans = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("raw"))
    # Later copies of a text lose all of it; ids with two texts lose nothing.
    known = base.where(F.col("doc").isNotNull())
    least = known.where(F.col("n") >= length).groupBy("h", "n").agg(F.min("doc").alias("first"))
    copies = (known.join(least, ["h", "n"]).where(F.col("doc") > F.col("first"))
              .select("doc").distinct().withColumn("copy", F.lit(True)))
    odd = (known.groupBy("doc").agg(F.min("h").alias("a"), F.max("h").alias("b"))
           .where(F.col("a") != F.col("b")).select("doc"))
    touched = written(spans.join(copies, "doc", "full").join(odd, "doc", "left_anti")
                      .select(F.col("doc").alias("_doc"), "raw", "copy"), "repeat-spans")
    # Texts that can't have spans aren't shuffled.
    bloom = spark.sparkContext.broadcast(key_filter(
        touched.select(F.xxhash64("_doc").alias("key")), touched.count(), most=filter_bytes))

    @F.pandas_udf("boolean")
    def maybe(key: pd.Series) -> pd.Series:
        return pd.Series(may_hold(bloom.value, key.to_numpy()))

    kind = "string" if as_text else "binary"

    @F.pandas_udf(f"spans array<struct<start:long,end:long>>, kept {kind}")
    def cut(texts: pd.Series, copies: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        spans, kept = [], []
        for data, copy, a, b in zip(texts, copies, starts, ends):
            mine = ([(0, len(data))] if copy else
                    [] if a is None else merged(list(zip(a.tolist(), b.tolist()))))
            at, left = 0, []
            for start, end in mine:
                left.append(data[at:start])
                at = end
            spans.append([{"start": start, "end": end} for start, end in mine])
            rest = b"".join(left) + data[at:]
            kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
        return pd.DataFrame({"spans": spans, "kept": kept})

    columns = docs.columns
    flagged = docs.withColumns({"_doc": doc, "_maybe": doc.isNotNull() & maybe(F.xxhash64(doc))})
    hit = (flagged.where("_maybe").join(touched, "_doc", "left")
           .withColumn("_cut", cut(text, F.coalesce("copy", F.lit(False)),
                                   F.transform("raw", lambda x: x["start"]),
                                   F.transform("raw", lambda x: x["end"])))
           .select(*columns, F.octet_length(text).cast("long").alias("n_bytes"), "_cut.spans",
                   "_cut.kept"))
    clean = flagged.where(~F.col("_maybe")).select(
        *columns, F.octet_length(text).cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        text.cast(kind).alias("kept"))
    return hit.union(clean)


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    **how) -> DataFrame:
    """``docs`` with the repeats taken out of the text. Bytes of a character that
    is cut in two go with the removed part. Rows and other columns stay; a null
    text comes back empty."""
    out = remove_repeats(docs, id_col=id_col, text_col=text_col, as_text=True, **how)
    return out.withColumn(text_col, F.col("kept")).select(*docs.columns)
