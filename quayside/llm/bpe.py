"""Byte-level BPE by a tokenization automaton.

Method. The merges are compiled, in order, into a deterministic automaton over
tokens that accepts exactly the correct tokenizations. It begins with one state
that loops on every byte. The gadget of a merge ``u v -> w`` redirects every arc
labelled ``u`` to a copy of its target that has no arc ``v``, and gives every
state that has an arc ``u`` an arc ``w`` to where ``u v`` used to lead. All arcs
with one label lead to one state, so a state is kept as the label that leads to
it and the number of merges done so far, and a copy as the one arc it lost: the
table stays linear in the number of merges, where listed arcs would be
quadratic. ``arc`` follows that table.

Encoding splits a text into words as the vocabulary's pre-tokenizer does and
runs each word through two tables in one pass, byte by byte, without stepping
back. Each prefix of a word has one accepted path, so each place has one state,
kept as the label that led to it. The first table, a matching automaton over the
labels' bytes, gives the labels that end at a place; the second tells which of
them is an arc from the state at the place where it begins. Exactly one is. A
word takes time in proportion to its length. Rows of both tables are filled in
as they are first met, up to ``MAX_ROWS`` entries; beyond that entries are
worked out again.
Decoding emits the arcs' labels. A worker keeps the ids of the words it has met, up to
``MAX_KEPT`` of them; both bounds change time alone.

The vocabulary's file is a parameter; it is read on the driver and broadcast
(its size doesn't follow the corpus).
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.frames import in_slices

MAX_KEPT = 300_000
MAX_ROWS = 500_000
KEPT_CHARS = 40
SLICE = 256
# The pre-tokenizer's word pattern: a fixed value of byte-level BPE files.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_GAP = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """Byte-level files write each byte as one printable letter: printable
    Latin-1 bytes as themselves, the others as letters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if chr(b) not in out]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Labels (bytes by id), merges (pairs of ids, in order) and added tokens."""

    def __init__(self, text: str):
        data = json.loads(text)
        letters = byte_letters()
        ids = data["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.labels = {i: bytes(letters[c] for c in s) for s, i in ids.items()
                       if s not in self.added}
        self.labels |= {i: s.encode() for s, i in self.added.items()}
        self.bytes = {b: ids[c] for c, b in letters.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]


class Automaton:
    def __init__(self, vocabulary: Vocabulary):
        self.labels = vocabulary.labels
        base = set(vocabulary.bytes.values())
        # By label: the step that made it (-1: a byte), its two parts, and the
        # arcs that its target state has lost, with the step of each loss.
        self.made = dict.fromkeys(base, -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.lost: dict[int, dict[int, int]] = {i: {} for i in base}
        self.known: dict[int, bool] = {}
        self.steps = len(vocabulary.merges)
        for step, (u, v, w) in enumerate(vocabulary.merges):
            if (w in self.made or u not in self.made or v not in self.made
                    or not self._has(u, step - 1, v)):
                continue
            self.made[w], self.parts[w], self.lost[w] = step, (u, v), {}
            self.lost[u][v] = step
        # The matching automaton: a node's row by byte, the longest label that
        # ends at a node, and each label's longest proper end that is a label.
        self.width = max(self.labels) + 1
        self.sizes = [len(self.labels.get(i, b"")) for i in range(self.width)]
        self.rows: list[dict[int, int]] = [{}]
        self.ends = [-1]
        self.shorter = [-1] * self.width
        for i in self.made:
            node = 0
            for byte in self.labels[i]:
                after = self.rows[node].get(byte)
                if after is None:
                    after = self.rows[node][byte] = len(self.rows)
                    self.rows.append({})
                    self.ends.append(-1)
                node = after
            self.ends[node] = i
        self.back, self.filled = [0] * len(self.rows), 0
        level = list(self.rows[0].values())
        while level:
            below = []
            for node in level:
                for byte, after in self.rows[node].items():
                    back = self.back[node]
                    while back and byte not in self.rows[back]:
                        back = self.back[back]
                    self.back[after] = back = self.rows[back].get(byte, 0)
                    if self.ends[after] < 0:
                        self.ends[after] = self.ends[back]
                    else:
                        self.shorter[self.ends[after]] = self.ends[back]
                    below.append(after)
            level = below
        self.whole = {self.labels[i]: [i] for i in self.made}

    def _has(self, at: int, step: int, label: int) -> bool:
        """Whether the state that ``at`` led to after ``step`` has an arc."""
        while True:
            if self.lost[at].get(label, step + 1) <= step:
                return False
            made = self.made[label]
            if made >= self.made[at] and made >= 0:
                step, label = min(step, made), self.parts[label][0]
            elif self.made[at] < 0:
                return True
            else:
                at, step = self.parts[at][1], self.made[at] - 1

    def arc(self, at: int, label: int) -> bool:
        found = self._has(at, self.steps, label)
        if len(self.known) < MAX_ROWS:
            self.known[at * self.width + label] = found
        return found

    def _move(self, node: int, byte: int) -> int:
        """The node after ``byte``, where ``node`` has no entry for it yet."""
        back = node
        while back and byte not in self.rows[back]:
            back = self.back[back]
        after = self.rows[back][byte]
        if self.filled < MAX_ROWS:
            self.filled += 1
            self.rows[node][byte] = after
        return after

    def run(self, word: bytes) -> list[int]:
        """The ids along the accepted path of one pre-split word; where an arc
        leads from the start over the whole word, that is the path."""
        found = self.whole.get(word)
        if found is not None:
            return found
        rows, ends, shorter, sizes = self.rows, self.ends, self.shorter, self.sizes
        known, width = self.known, self.width
        lead, node = [-1], 0
        for place, byte in enumerate(word, 1):
            try:
                node = rows[node][byte]
            except KeyError:
                node = self._move(node, byte)
            label = ends[node]
            while (at := lead[place - sizes[label]]) >= 0:
                try:
                    if known[at * width + label]:
                        break
                except KeyError:
                    if self.arc(at, label):
                        break
                label = shorter[label]
            lead.append(label)
        out, place = [], len(word)
        while place:
            out.append(lead[place])
            place -= sizes[lead[place]]
        out.reverse()
        return out


class Encoder:
    """Whole texts to ids (little-endian unsigned 32-bit). ``words`` encodes one
    pre-split word; texts are cut at single spaces between visible characters,
    where no word of the pattern crosses, and a part met before isn't split
    again."""

    def __init__(self, vocabulary: Vocabulary, words: Callable[[bytes], list[int]]):
        self.added, self.words = vocabulary.added, words
        self.cut = (re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
                    if self.added else None)
        self.pattern = regex.compile(WORDS)
        self.kept: dict[str, bytes] = {}

    def part(self, text: str) -> bytes:
        out = array("I")
        pieces = self.cut.split(text) if self.cut else [text]
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(self.added[piece])
            elif piece:
                for word in self.pattern.findall(piece):
                    out.extend(self.words(word.encode("utf-8", "replace")))
        return out.tobytes()

    def _kept(self, piece: str) -> bytes:
        found = self.kept.get(piece)
        if found is None:
            found = self.part(" " + piece)
            if (len(piece) <= KEPT_CHARS and len(self.kept) < MAX_KEPT
                    and piece == piece.strip() and piece):
                self.kept[piece] = found
        return found

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        pieces = text.split(" ")
        if len(pieces) == 1 or not pieces[0] or pieces[0][-1].isspace():
            return self._slow(text)
        first, rest = pieces[0], pieces[1:]
        found = list(map(self.kept.get, rest))
        if None in found:
            for k, piece in enumerate(rest):
                if found[k] is None:
                    if not piece or piece[0].isspace() or piece[-1].isspace():
                        return self._slow(text)
                    found[k] = self._kept(piece)
        return self.part(first) + b"".join(found)

    def _slow(self, text: str) -> bytes:
        first, *rest = _GAP.split(text)
        return self.part(first) + b"".join(map(self._kept, rest))


def decode(labels: dict[int, bytes], ids: bytes) -> str:
    """Emit the labels of the ids' arcs; a broken byte becomes U+FFFD."""
    numbers = array("I", bytes(ids))
    return b"".join(map(labels.__getitem__, numbers)).decode("utf-8", "replace")


_WORKER: dict[str, tuple] = {}


def _of_worker(text: str) -> tuple[Encoder, dict[int, bytes]]:
    """One automaton and its kept words per Python worker, over all its tasks."""
    key = str(hash(text))
    if key not in _WORKER:
        vocabulary = Vocabulary(text)
        automaton = Automaton(vocabulary)
        _WORKER[key] = Encoder(vocabulary, automaton.run), vocabulary.labels
    return _WORKER[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Ids and the text decoded from them, one row per row of ``docs``.

    Returns ``doc_id, ids binary, decoded string``. A null or empty text has no
    ids and decodes to an empty text; a null id stays null; repeated rows are
    returned as often as they occur; an empty table gives an empty table; other
    columns are ignored. Texts of any length are encoded whole.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, labels = _of_worker(shared.value)
        for rows in in_slices(SLICE)(batches):
            ids = [encoder.encode(x) for x in rows["text"]]
            yield pd.DataFrame({"doc_id": rows["doc_id"], "ids": ids,
                                "decoded": [decode(labels, x) for x in ids]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, ids binary, decoded string")
