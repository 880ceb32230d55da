"""Quality rules by weak supervision.

Method. Each rule votes good (1), votes bad (-1) or abstains (0) on a document.
Expectation-maximisation over the vote patterns estimates, without labels, the
share of good documents and each rule's accuracy on good ones and on each kind
of bad ones; the posterior probability of good replaces the filter that asks all rules to pass.

At scale. Counts, votes and posterior are column expressions: one pass, no
shuffle, no Python. The vote patterns are one aggregate of at most
``3 ** len(RULES)`` rows over all documents, and only they reach the driver,
where the few numbers of the model are fitted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[ \t-\r]+"
WINDOW = 8
# Each rule's prior rate of bad votes on good documents. A fault that one rule
# alone can see looks like that rule's error; the prior tells them apart, and it
# weighs as much as the documents do.
FALSE_ALARMS = {"words": 0.05, "word_length": 0.002, "symbols": 0.002, "lines": 0.05,
                "windows": 0.002, "capitals": 0.002, "variety": 0.002}
RULES = tuple(FALSE_ALARMS)


def add_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules look at, under ``_q`` names."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = docs.withColumn("_q_text", text)
    trimmed = F.btrim("_q_text", F.lit(" \t\n\x0b\f\r"))
    docs = docs.withColumn("_q_words", F.when(trimmed == "", F.array().cast("array<string>"))
                           .otherwise(F.split(trimmed, SPACE)))
    lines = F.filter(F.split("_q_text", "\n"), lambda x: F.rlike(x, F.lit(r"[^ \t-\r]")))
    hashes = F.when(F.size("_q_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size("_q_words") - WINDOW + 1),
                    lambda i: F.xxhash64(F.slice("_q_words", i, WINDOW))))
    docs = docs.withColumns({"_q_lines": lines, "_q_hashes": hashes})
    # Only texts where some window occurs twice are sorted.
    again = F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes")
    docs = docs.withColumn("_q_sorted", F.when(again, F.sort_array(
        F.transform("_q_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("_q_sorted", lambda x, i:
                     (x["h"] == F.coalesce(F.get("_q_sorted", i - 1)["h"], x["h"] + 1))
                     | (x["h"] == F.coalesce(F.get("_q_sorted", i + 1)["h"], x["h"] + 1)))
    docs = docs.withColumn("_q_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("_q_at", start, lambda a, i: F.struct(
        (i + WINDOW).alias("end"),
        (a["n"] + WINDOW - F.greatest(F.lit(0), a["end"] - i)).alias("n")))["n"]
    # Always true, but not for the optimiser: a later filter pushed below the
    # counts would put each of them into the lambdas of the next.
    here = F.monotonically_increasing_id() >= 0
    counts = {
        "_q_n_words": F.size("_q_words").cast("long"),
        "_q_word_chars": F.length(F.array_join("_q_words", "")).cast("long"),
        "_q_n_symbols": F.regexp_count("_q_text", F.lit(r"[#*$%&|<>]")).cast("long"),
        "_q_n_lines": F.size("_q_lines").cast("long"),
        "_q_n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "_q_n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "_q_n_capitals": F.regexp_count("_q_text", F.lit(r"\p{Lu}")).cast("long"),
        "_q_n_distinct": F.size(F.array_distinct("_q_words")).cast("long"),
    }
    return docs.withColumns({c: F.when(here, x) for c, x in counts.items()}).drop("_q_text", "_q_words", "_q_lines", "_q_hashes", "_q_sorted", "_q_at")


def votes() -> dict[str, Column]:
    """One column for each rule: -1, 0 or 1."""
    n = F.greatest(F.col("_q_n_words"), F.lit(1))
    chars = F.greatest(F.col("_q_word_chars"), F.lit(1))
    lines = F.greatest(F.col("_q_n_lines"), F.lit(1))

    def vote(bad, good):
        return F.when(bad, -1).when(good, 1).otherwise(0)

    length = F.col("_q_word_chars") / n
    return {
        "words": vote(F.col("_q_n_words") < 20, F.col("_q_n_words") >= 50),
        "word_length": vote((length < 2) | (length > 20), length.between(3, 12)),
        "symbols": vote(F.col("_q_n_symbols") * 10 > n, F.col("_q_n_symbols") * 100 <= n),
        "lines": vote(F.col("_q_n_dup_lines") * 10 > lines * 3, F.col("_q_n_dup_lines") == 0),
        "windows": vote(F.col("_q_n_repeat_words") * 10 > n * 3,
                        F.col("_q_n_repeat_words") == 0),
        "capitals": vote(F.col("_q_n_capitals") * 10 > chars * 4,
                         F.col("_q_n_capitals") * 10 < chars * 2),
        "variety": vote((F.col("_q_n_distinct") * 5 < n) & (F.col("_q_n_words") >= 50),
                        F.col("_q_n_distinct") * 5 >= n * 2),
    }


def learn(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> dict:
    """Expectation-maximisation over vote patterns and their counts.

    Bad documents are of several kinds, and most rules see one kind alone; so
    beside the good class there is a bad class for each rule. A pattern begins
    in the classes of the rules that vote bad on it, else as good. Estimated are
    the classes' shares and each rule's rate of good votes in each (smoothed, in
    the good class by ``FALSE_ALARMS``;
    never higher in a bad class than in the good one, so that a good vote never
    speaks against a document). Returned, with the good class as the zero: each
    bad class's log odds, and what a good and a bad vote of each rule add."""
    rules = len(patterns[0][0]) if patterns else len(RULES)
    total = sum(n for _, n in patterns)
    alarms = list(FALSE_ALARMS.values())
    if not total:
        return {"share": [-3.0] * rules, "good": [[0.0] * rules] * rules,
                "bad": [[3.0 * (r == k) for r in range(rules)] for k in range(rules)]}
    held = []
    for votes_, _ in patterns:
        against = [r for r, v in enumerate(votes_) if v < 0]
        good = 0.1 if against else 0.95
        rest = against or range(rules)
        held.append([good] + [(1 - good) / len(rest) * (r in rest) for r in range(rules)])
    model = {}
    for _ in range(rounds):
        share, rate = [], []
        for y in range(rules + 1):
            share.append((sum(h[y] * n for h, (_, n) in zip(held, patterns)) + 1)
                         / (total + rules + 1))
            rate.append([])
            for r in range(rules):
                up = sum(h[y] * n for h, (v, n) in zip(held, patterns) if v[r] > 0) + 1
                down = sum(h[y] * n for h, (v, n) in zip(held, patterns) if v[r] < 0) + 1
                if y == 0:
                    up += total * (1 - alarms[r])
                    down += total * alarms[r]
                rate[y].append(up / (up + down) if y == 0 else min(up / (up + down), rate[0][r]))
        model = {
            "share": [math.log(s / share[0]) for s in share[1:]],
            "good": [[math.log(k[r] / rate[0][r]) for r in range(rules)] for k in rate[1:]],
            "bad": [[math.log((1 - k[r]) / (1 - rate[0][r])) for r in range(rules)]
                    for k in rate[1:]]}
        before, held = held, [_classes(model, votes_) for votes_, _ in patterns]
        if max(abs(a[0] - b[0]) for a, b in zip(before, held)) < 1e-7:
            break
    return model


def _odds(model: dict, kind: int, votes_: tuple[int, ...]) -> float:
    return model["share"][kind] + sum(
        a if v > 0 else b if v < 0 else 0.0
        for v, a, b in zip(votes_, model["good"][kind], model["bad"][kind]))


def _classes(model: dict, votes_: tuple[int, ...]) -> list[float]:
    weights = [1.0] + [math.exp(min(50.0, _odds(model, k, votes_)))
                       for k in range(len(model["share"]))]
    return [w / sum(weights) for w in weights]


def fit(docs: DataFrame, text_col: str = "text") -> dict:
    """Fit on the vote patterns of all documents."""
    counted = add_counts(docs.select(text_col), text_col).select(
        *(c.alias(r) for r, c in votes().items()))
    rows = counted.groupBy(*RULES).count().orderBy(*RULES).collect()
    return learn([(tuple(row[r] for r in RULES), row["count"]) for row in rows])


def keep(docs: DataFrame, model: dict, *, text_col: str = "text") -> DataFrame:
    """The rows that ``judge`` keeps, with their own columns."""
    own = F.struct(*docs.columns).alias("_own")
    judged = judge(docs.select(own, F.col(text_col).alias("text")), model)
    return judged.where("kept").select("_own.*")


def judge(docs: DataFrame, model: dict, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, posterior, kept`` (earlier columns of these
    names are replaced).

    A null text counts as empty: all counts are 0, ``base_failed`` is true.
    Every row, repeated ones too, and every other column stays; an empty table
    gives an empty table."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = add_counts(docs, text_col).withColumns({f"_q_v_{r}": v for r, v in votes().items()})
    weight = F.lit(1.0)
    for kind, start in enumerate(model["share"]):
        z = F.lit(start)
        for r, up, down in zip(RULES, model["good"][kind], model["bad"][kind]):
            v = F.col(f"_q_v_{r}")
            z = z + F.when(v > 0, F.lit(up)).when(v < 0, F.lit(down)).otherwise(0.0)
        weight = weight + F.exp(F.least(z, F.lit(50.0)))
    failed = ((F.col("_q_n_words") < 20)
              | (F.col("_q_n_repeat_words") * 100 > F.col("_q_n_words") * 30))
    out = out.withColumns({"_q_failed": failed, "_q_posterior": 1 / weight})
    out = out.withColumns({n: F.col(f"_q_{n}") for n in names}
                          | {"base_failed": F.col("_q_failed"), "posterior": F.col("_q_posterior"),
                             "kept": ~F.col("_q_failed") & (F.col("_q_posterior") >= 0.5)})
    return out.drop(*(c for c in out.columns if c.startswith("_q_")))
