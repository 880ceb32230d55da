"""Interaction audit of quality filters, with table-wide duplicates from text tries.

Method. Map tasks reduce their equal texts to the smallest id and the members' ids
(pre-aggregation). The texts are then range-partitioned by adaptive prefixes: a
prefix that too many bytes share is extended until none is heavy or the texts end.
Each range is read in text order into a compressed radix trie that holds the
smallest id at each terminal. Terminals that no later text can reach are traversed
and released, so a task holds one path, whatever the size of its range. A document
whose id isn't its terminal's smallest is a duplicate. With it, every document has
a mask of failed filters; masks reduce to counts per part, and from those few counts
all orders of the filters follow.

At scale. Texts move once, one row a map buffer for copies; ids move to terminals
and labels in narrow rows. No rows are paired: the duplicate flag is an equality join
on the id and the text's hash, whose left side is grouped before. Balance alone rests
on the prefixes; any ranges give the same result.

Defined results. Null text is the empty text, null lang the empty part. A row without
id has no smaller id and no label, and isn't smaller than any: it is never a duplicate
and makes none. Rows that repeat an id and its text are not smaller than each other.
Labels that repeat an id count as one; a label is set if any of them sets it. Texts of
any length are tested and inserted whole. An empty table gives no rows. Further columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.frames import written

# The filters' letters and limits.
FILTERS = "ABCDE"
MIN_WORDS = 200
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
# Bytes of texts a map task gathers before it gives them out, and of members.
BUFFER_BYTES = 16 * 1024 * 1024
MEMBER_BYTES = 48
# Adaptive prefixes: first length in characters, growth, and the heaviest share of all
# bytes that one may hold before it is extended. Balance only.
FIRST_DEPTH = 16
DEPTH_GROWTH = 4
HEAVY_SHARE = 1 / 512


class RadixTrie:
    """A compressed trie of byte strings; terminals hold the smallest id seen."""

    class Node:
        __slots__ = ("label", "children", "least", "value")

        def __init__(self, label: bytes):
            self.label, self.children, self.least, self.value = label, {}, None, None

    def __init__(self):
        self.root = self.Node(b"")

    def insert(self, text: bytes, number: int, value=None) -> None:
        """Add ``text``; ``value`` goes with the terminal."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = self.Node(text[at:])
                node, at = child, len(text)
            elif text.startswith(child.label, at):
                node, at = child, at + len(child.label)
            else:
                shared = _shared(child.label, text[at:at + len(child.label)])
                upper = self.Node(child.label[:shared])
                child.label = child.label[shared:]
                upper.children[child.label[0]] = child
                node.children[text[at]] = upper
                node, at = upper, at + shared
        if node.least is None or number < node.least:
            node.least = number
        node.value = value

    def terminals(self, node=None) -> Iterator[tuple[int, object]]:
        """Smallest id and value of each terminal under a node."""
        todo = [node or self.root]
        while todo:
            one = todo.pop()
            if one.least is not None:
                yield one.least, one.value
            todo.extend(one.children.values())

    def release(self, text: bytes) -> Iterator[tuple[int, object]]:
        """Traverse and drop all branches that are not on ``text``'s path. In a sorted
        stream no later text reaches them, nor the proper prefixes on the path."""
        node, at = self.root, 0
        while at < len(text):
            for first in [c for c in node.children if c != text[at]]:
                yield from self.terminals(node.children.pop(first))
            if node.least is not None:
                yield node.least, node.value
                node.least = None
            node = node.children[text[at]]
            at += len(node.label)


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def text_mask(text: bytes, n_chars: int) -> int:
    """Bits 0-3: the text fails A, B, C, D. ``bytes.split`` cuts at exactly the white
    space of the words' definition."""
    words = text.split()
    upper = len(text) - len(text.translate(None, UPPER))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * upper > 3 * n_chars) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


_GATHERED = pa.schema([("text", pa.string()), ("mask", pa.int32()), ("least", pa.int64()),
                       ("ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string()))])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of a buffer, with its mask, smallest id and members."""
    held: dict[bytes, list] = {}
    size = 0

    def flush():
        rows = list(held.items())
        for at in range(0, len(rows), 1000):
            some = rows[at:at + 1000]
            texts = pa.array([t for t, _ in some], pa.binary()).cast(pa.string())
            columns = [[r[0] for _, r in some],
                       [min((i for i in r[1] if i is not None), default=None) for _, r in some],
                       [r[1] for _, r in some], [r[2] for _, r in some]]
            yield pa.RecordBatch.from_arrays(
                [texts] + [pa.array(c, f.type) for c, f in zip(columns, list(_GATHERED)[1:])],
                schema=_GATHERED)
        held.clear()

    for batch in batches:
        chars = pc.utf8_length(batch.column("text"))
        texts = batch.column("text").cast(pa.binary())
        for row in range(batch.num_rows):
            text = texts[row].as_py()
            entry = held.get(text)
            if entry is None:
                entry = held[text] = [text_mask(text, chars[row].as_py()), [], []]
                size += len(text)
            entry[1].append(batch.column("doc_id")[row].as_py())
            entry[2].append(batch.column("part")[row].as_py())
            size += MEMBER_BYTES
            if size >= BUFFER_BYTES:
                yield from flush()
                size = 0
    yield from flush()


def adaptive_prefix(texts: DataFrame, share: float = HEAVY_SHARE,
                    first: int = FIRST_DEPTH) -> Column:
    """The range key of ``text``: its first characters, more of them below prefixes of
    different texts that hold over ``share`` of all bytes. Each round looks at the texts below the heavy
    prefixes of the round before, so their number stays below 1 / share; it ends
    where no heavy prefix has longer texts."""
    weight = F.octet_length("text")
    total = texts.agg(F.sum(weight)).first()[0] or 0
    key = F.substring("text", 1, first)
    depth, below = first, texts
    while total:
        longer = below.where(F.length("text") > depth)
        heavy = [r[0] for r in longer.groupBy(F.substring("text", 1, depth).alias("p"))
                 .agg(F.sum(weight).alias("w"), F.min("text_hash").alias("one"),
                      F.max("text_hash").alias("other"))
                 .where((F.col("w") > share * total) & (F.col("one") != F.col("other")))
                 .select("p").collect()]
        if not heavy:
            break
        here = F.substring("text", 1, depth).isin(heavy)
        key = F.when(here, F.substring("text", 1, depth * DEPTH_GROWTH)).otherwise(key)
        below, depth = below.where(here), depth * DEPTH_GROWTH
    return key


_FIRSTS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64())])


def _traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Insert a range's texts, in order, and give each terminal's smallest id."""
    trie, last = RadixTrie(), None

    def out(found):
        columns = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, schema=_FIRSTS)

    for batch in batches:
        found = []
        texts = batch.column("text").cast(pa.binary())
        ids, hashes = batch.column("least").to_pylist(), batch.column("text_hash").to_pylist()
        for row in range(batch.num_rows):
            text = texts[row].as_py()
            trie.insert(text, ids[row], hashes[row])
            if text != last:
                found.extend(trie.release(text))
                last = text
        yield out(found)
    yield out(list(trie.terminals()))


def least_ids(gathered: DataFrame) -> DataFrame:
    """``doc_id, text_hash`` of the row with the smallest id of each distinct text."""
    texts = gathered.where("least IS NOT NULL").select("text", "least",
                                                       F.xxhash64("text").alias("text_hash"))
    keyed = texts.withColumn("prefix", adaptive_prefix(texts))
    return (keyed.repartitionByRange("prefix").sortWithinPartitions("text")
            .select("text", "least", "text_hash")
            .mapInArrow(_traverse, "doc_id long, text_hash long"))


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of documents per ``part, mask, good, toxic``; bit k of the mask is set
    where the document fails filter k of ``FILTERS``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce("lang", F.lit("")).alias("part"))
    gathered = written(rows.mapInArrow(
        _gather, "text string, mask int, least long, ids array<long>, parts array<string>"),
        "tries-texts")
    firsts = written(least_ids(gathered), "tries-firsts")
    members = gathered.select(F.xxhash64("text").alias("text_hash"), "mask", F.explode(
        F.arrays_zip("ids", "parts")).alias("m")).select(
        "text_hash", "mask", F.col("m.ids").alias("doc_id"), F.col("m.parts").alias("part"))
    keys = ["doc_id", "text_hash", "mask", "part"]
    facts = members.where("doc_id IS NOT NULL").groupBy(*keys).agg(F.count("*").alias("n"))
    marked = facts.join(firsts.withColumn("is_first", F.lit(True)), ["doc_id", "text_hash"], "left")
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    full = F.col("mask") + F.when(F.col("is_first"), 0).otherwise(16)
    known = marked.join(marks, "doc_id", "left").select(
        "part", full.alias("mask"), F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")
    unnamed = members.where("doc_id IS NULL").select(
        "part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"),
        F.lit(1).cast("long").alias("n"))
    return (known.unionByName(unnamed).groupBy("part", "mask", "good", "toxic")
            .agg(F.sum("n").alias("n")))


def steps_of_orders() -> Column:
    """An array of every step of every order of the filters: the order, the step, its
    filter's bit and the bits of the filters before it (600 entries for five)."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            rows.append(f"named_struct('filter_order', '{''.join(order)}', 'step', {step}, "
                        f"'bit', {bit}, 'before', {before})")
            before |= bit
    return F.expr(f"array({', '.join(rows)})")


def audit(counts: DataFrame) -> DataFrame:
    """Every part's counts under every order of the filters, from ``masks``."""
    each = counts.withColumn("s", F.explode(steps_of_orders())).select("*", "s.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    passed = F.col("mask").bitwiseAND(F.col("before")) == 0

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    steps = each.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & passed).alias("kept"), total(fails & passed).alias("removed"),
        total(fails & ~passed).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & passed & F.col("good")).alias("good_lost"),
        total(fails & passed & F.col("toxic")).alias("toxic_lost"))
    filters_orders = Window.partitionBy("part", "bit")  # 600 / 5 rows
    return steps.withColumn("shapley", F.sum("removed").over(filters_orders)).drop("bit")
