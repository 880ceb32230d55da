import hashlib
import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayside.llm import bpe
from tests.llm import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    vocabulary = bpe.Vocabulary(bpe.read_vocabulary(PATH))
    return bpe.Encoder(vocabulary, bpe.Automaton(vocabulary).run), vocabulary.labels


def test_every_label_is_its_own_path(encoder):
    own, labels = encoder
    wrong = [i for i, label in labels.items() if i not in own.added.values()
             and own.words(label) != [i]]
    assert not wrong


def test_random_texts_encode_and_decode_as_the_library_does(encoder, library):
    own, labels = encoder
    rng = random.Random(4)
    pieces = ["a", "aa", " ", "  ", "\n", " \n", "\t", "<|endoftext|>", "<|endoftext", "'s", "'ll",
              "é", "中文", "🙂", "1", "23", "!!!", " the", "ing", "\x1c", "\x85", "\u3000", "ß",
              "x" * 70, "İ", "\u200b", "a\u0301", "\x00"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 25))) for _ in range(4000)]
    texts += ["a" * 4000, " " * 3000, "ab" * 2000, cases.LONG]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        got = own.encode(text)
        assert array("I", got).tolist() == want.ids, text[:80]
        assert bpe.decode(labels, got) == library.decode(want.ids, skip_special_tokens=False)


class OnePass:
    """A word that can be read once, from its first byte to its last."""

    def __init__(self, word: bytes):
        self.word, self.passes = word, 0

    def __len__(self):
        return len(self.word)

    def __iter__(self):
        self.passes += 1
        return iter(self.word)


def test_long_words_take_one_pass(encoder, library, monkeypatch):
    own, _ = encoder
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choices(letters, k=100_000)), "ab" * 50_000 + "c", "z" * 65_537]
    monkeypatch.setattr(bpe, "MAX_ROWS", 1000)  # rows beyond the bound are worked out again
    for word in words:
        once = OnePass(word.encode())
        assert own.words(once) == library.encode(word, add_special_tokens=False).ids
        assert once.passes == 1


def test_automaton_follows_merge_order():
    """A word's path is what merging by rank gives, on a small vocabulary."""
    rng = random.Random(7)
    merges, known = [], ["a", "b", "c"]
    while len(merges) < 40:
        u, v = rng.choice(known), rng.choice(known)
        if u + v not in known and len(u + v) < 9:
            merges.append((u, v))
            known.append(u + v)
    ids = {t: i for i, t in enumerate(known)}

    class Small:
        labels = {i: t.encode() for t, i in ids.items()}
        bytes = {ord(c): ids[c] for c in "abc"}

    Small.merges = [(ids[u], ids[v], ids[u + v]) for u, v in merges]
    automaton = bpe.Automaton(Small)
    rank = {m: r for r, m in enumerate(merges)}
    for _ in range(3000):
        word = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        parts = list(word)
        while True:
            best = min(((rank[p], p) for p in zip(parts, parts[1:]) if p in rank), default=None)
            if best is None:
                break
            at, out = 0, []
            while at < len(parts):
                if tuple(parts[at:at + 2]) == best[1]:
                    out.append("".join(parts[at:at + 2]))
                    at += 2
                else:
                    out.append(parts[at])
                    at += 1
            parts = out
        assert automaton.run(word.encode()) == [ids[p] for p in parts], word


def test_documents(spark, library):
    rows = bpe.encode_documents(cases.documents(spark), PATH).collect()
    assert len(rows) == len(cases.TEXTS)
    want = {(i, hashlib.md5((t or "").encode()).hexdigest()):
            library.encode(t or "", add_special_tokens=False).ids for i, t in cases.TEXTS}
    got = {(r["doc_id"], hashlib.md5(r["decoded"].encode()).hexdigest()):
           array("I", bytes(r["ids"])).tolist() for r in rows}
    assert got == want


def test_empty_table(spark):
    assert bpe.encode_documents(cases.empty(spark), PATH).count() == 0
