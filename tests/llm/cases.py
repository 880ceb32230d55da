"""Rows that every text operator must take: nulls, empty and odd texts, ties,
repeated rows, a very long text, and extra columns with clashing names."""

import random

from pyspark.sql import functions as F

LONG = " ".join(f"long{i % 997}x{i // 997}" for i in range(40_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away into the dark green wood"),
    (2, None), (3, ""), (4, " \t\n "), (5, "one"), (5, "one"), (6, "one two"),
    (7, "The quick brown fox jumps over the lazy dog and runs far away into the dark green wood"),
    (8, "x" * 300), (9, "Été \u00a0 naïve 中文 🙂 \x00 <|endoftext|> 'll don't"), (10, LONG),
    (None, "a row without an id"), (None, None), (11, "a\n\nb\na\n \na"), (12, "ONE"),
]
# Names that the operators use themselves.
CLASHING = ("score", "kept", "n_words", "labels", "spans", "component_id", "rank", "piece",
            "sequence_id", "offset", "ids", "key", "doc", "text_2")


def documents(spark, rows=TEXTS, clashing=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if clashing:
        df = df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    return df


def empty(spark):
    return documents(spark, [])


def prose(seed, n, words=400):
    """``n`` texts of a small vocabulary with copies, near copies and passages
    that several share."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéß", k=rng.randint(2, 7))) for _ in range(words)]
    passage = " ".join(rng.choices(vocabulary, k=25))
    out = []
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.15:
            text = rng.choice(out)[1]
        elif out and kind < 0.45:
            parts = rng.choice(out)[1].split(" ")
            for _ in range(rng.randint(1, 3)):
                parts[rng.randrange(len(parts))] = rng.choice(vocabulary)
            text = " ".join(parts)
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.randint(1, 120)))
            if kind > 0.7:
                text += "\n" + passage
        out.append((i * 3 + 1, text))
    rng.shuffle(out)
    return out
