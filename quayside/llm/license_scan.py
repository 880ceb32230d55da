"""License scans by ordered signature rules.

Method. A text becomes its lower-case words, one space apart. A keyword
prefilter leaves a text only the rules whose keyword it holds; each of these
regexes gives word intervals. Detections are then resolved: one that lies inside
another goes (of equal intervals the higher priority stays), and so does one
that overlaps a detection of higher priority. The labels left are the method's.

At scale. All of it is column expressions on one row: one pass, no shuffle, no
Python. The rules (``rules()``, some hundreds) are built from the names and
forms below and enter the plan as a constant.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.frames import ascii_lower

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases with labels of their own: fixed values of the contract.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"),
           ("cc by nc", "cc-by-nc"))
# Name (a pattern over words), its keyword, and the label.
NAMES = (
    ("mit", "mit", "mit"), ("mit no attribution", "attribution", "mit-0"),
    ("x11", "x11", "x11"), ("isc", "isc", "isc"), ("zlib(?: libpng)?", "zlib", "zlib"),
    ("(?:simplified|2 clause|two clause) bsd|bsd 2 clause", "bsd", "bsd-2-clause"),
    ("(?:new|modified|revised|3 clause|three clause) bsd|bsd 3 clause", "bsd", "bsd-3-clause"),
    ("(?:original|4 clause|four clause) bsd|bsd 4 clause", "bsd", "bsd-4-clause"),
    ("bsd", "bsd", "bsd"), ("boost software", "boost", "bsl-1.0"),
    ("apache(?: software)?", "apache", "apache"),
    ("gnu general public", "gnu", "gpl"), ("gpl", "gpl", "gpl"),
    ("gnu (?:lesser|library) general public", "gnu", "lgpl"), ("lgpl", "lgpl", "lgpl"),
    ("gnu affero general public", "affero", "agpl"), ("agpl", "agpl", "agpl"),
    ("gnu free documentation", "gnu", "gfdl"), ("gfdl", "gfdl", "gfdl"),
    ("mozilla public", "mozilla", "mpl"), ("mpl", "mpl", "mpl"),
    ("eclipse public", "eclipse", "epl"), ("epl", "epl", "epl"),
    ("european union public", "european", "eupl"), ("eupl", "eupl", "eupl"),
    ("common development and distribution", "distribution", "cddl"), ("cddl", "cddl", "cddl"),
    ("common public", "common", "cpl"), ("ibm public", "ibm", "ipl"),
    ("microsoft public", "microsoft", "ms-pl"), ("microsoft reciprocal", "microsoft", "ms-rl"),
    ("academic free", "academic", "afl"), ("open software", "software", "osl"),
    ("artistic", "artistic", "artistic"), ("perl artistic", "perl", "artistic"),
    ("python software foundation", "python", "psf"), ("ruby", "ruby", "ruby"), ("php", "php", "php"),
    ("(?:sil )?open font", "font", "ofl"), ("open database", "database", "odbl"),
    ("open data commons attribution", "commons", "odc-by"), ("unlicense", "unlicense", "unlicense"),
    ("do what the fuck you want to public", "want", "wtfpl"), ("wtfpl", "wtfpl", "wtfpl"),
    ("server side public", "server", "sspl"), ("business source", "business", "busl"),
    ("elastic", "elastic", "elastic"), ("university of illinois ncsa", "ncsa", "ncsa"),
    ("postgresql", "postgresql", "postgresql"), ("openssl", "openssl", "openssl"),
    ("latex project public", "latex", "lppl"), ("q public", "public", "qpl"),
    ("sun public", "sun", "spl"), ("vovida software", "vovida", "vsl"), ("zope public", "zope", "zpl"),
)
# Creative Commons terms, spelt out and short.
TERMS = (("attribution", "by"), ("attribution share ?alike", "by sa"),
         ("attribution non ?commercial", "by nc"), ("attribution no ?deriv(?:ative|ativ)e?s", "by nd"),
         ("attribution non ?commercial share ?alike", "by nc sa"),
         ("attribution non ?commercial no ?deriv(?:ative|ativ)e?s", "by nc nd"))
# Signatures, each written for itself: sentences that open license texts, and names in
# which version and license stand otherwise. Keyword, pattern, label.
SIGNATURES = (
    ("hereby", "permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("hereby", "permission is hereby granted free of charge to any person or organization",
     "bsl-1.0"),
    ("redistribution", "redistribution and use in source and binary forms", "bsd"),
    ("permission", "permission to use copy modify and or distribute this software for any purpose",
     "isc"),
    ("redistribute", "this program is free software you can redistribute it and or modify it "
     "under the terms of the gnu general public license", "gpl"),
    ("redistribute", "this library is free software you can redistribute it and or modify it "
     "under the terms of the gnu (?:lesser|library) general public license", "lgpl"),
    ("mozilla", "this source code form is subject to the terms of the mozilla public license",
     "mpl"),
    ("unencumbered", "this is free and unencumbered software released into the public domain",
     "unlicense"),
    ("apache", "apache 2(?: 0)? licen[cs]e", "apache-2"),
    ("gplv2", "gplv2(?: or later)?", "gpl"), ("gplv3", "gplv3(?: or later)?", "gpl"),
    ("lgplv2", "lgplv2(?: 1)?(?: or later)?", "lgpl"),
    ("lgplv3", "lgplv3(?: or later)?", "lgpl"), ("agplv3", "agplv3(?: or later)?", "agpl"),
)
# Ways to name a license, with the confidence of a detection; earlier is stronger.
FORMS = (
    ("spdx license identifier (?:{name})(?P<v>)", 1.0),
    ("(?:licensed|released|distributed|published) under (?:the terms of )?(?:the |a )?"
     "(?:{name})(?: licen[cs]e)?(?P<v>)", 0.95),
    ("under the terms of (?:the |a )?(?:{name})(?: licen[cs]e)?(?P<v>)", 0.9),
    ("subject to (?:the terms of )?(?:the |a )?(?:{name}) licen[cs]e(?P<v>)", 0.85),
    ("(?:{name}) licen[cs]e(?P<v>)", 0.8),
)
VERSION = r"(?: (?:version |v)?(?:[1-4])(?: [0-9])?)?(?: or later)?"
NO_WORDS = "array<struct<s:int,e:int>>"


def rules() -> list[tuple[str, str, str, int, float]]:
    """``keyword, pattern, label, priority, confidence``: the signatures, then every
    name in every form; a lower priority number wins. Every match of a rule holds its
    keyword."""
    named = list(NAMES)
    for spelt, short in TERMS:
        label = "cc-" + short.replace(" ", "-")
        named.append((f"creative commons {spelt}", "creative", label))
        named.append((f"cc {short}", "cc", label))
    named += [("cc0", "cc0", "cc0"), ("cc zero", "zero", "cc0"),
              ("creative commons zero", "creative", "cc0")]
    out = [(keyword, pattern, label, -1, 0.97) for keyword, pattern, label in SIGNATURES]
    for rank, (form, confidence) in enumerate(FORMS):
        for name, keyword, label in named:
            pattern = form.replace("{name}", name).replace("(?P<v>)", VERSION)
            out.append((keyword, pattern, label, rank, confidence))
    for spelt, short in TERMS:
        label = "cc-" + short.replace(" ", "-")
        out.append(("cc", f"cc {short}{VERSION}", label, len(FORMS), 0.7))
    out.append(("reserved", "all rights reserved", "proprietary", len(FORMS) + 1, 0.5))
    out.append(("public", "(?:in|into|to) the public domain", "public-domain", len(FORMS), 0.6))
    return out


def normal(text: Column) -> Column:
    """The words of a text, each between two single spaces; one space if none."""
    spaced = F.regexp_replace(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BREAKS, " ")
    trimmed = F.btrim(spaced)
    return F.when(trimmed == "", " ").otherwise(F.concat(F.lit(" "), trimmed, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _constant(rows: Iterable[tuple]) -> Column:
    return F.array(*(F.struct(F.lit(k).alias("k"), F.lit(p).alias("p"), F.lit(label).alias("label"),
                              F.lit(rank).alias("rank"), F.lit(c).alias("c"))
                     for k, p, label, rank, c in rows))


def _intervals(text: Column, pattern: Column) -> Column:
    """Word intervals of a pattern's matches: both ends are marked in the text,
    then found among its words."""
    full = F.concat(F.lit("(?<= )("), pattern, F.lit(")(?= )"))
    marked = F.split(F.regexp_replace(F.btrim(text), F.concat(
        F.lit("(?<![^ ])("), pattern, F.lit(")(?![^ ])")), F.lit("\x01$1\x02")), " ")
    found = F.transform(marked, lambda w, i: F.struct(
        F.startswith(w, F.lit("\x01")).alias("a"), F.endswith(w, F.lit("\x02")).alias("b"),
        i.alias("i")))
    starts = F.transform(F.filter(found, lambda x: x["a"]), lambda x: x["i"])
    ends = F.transform(F.filter(found, lambda x: x["b"]), lambda x: x["i"])
    pairs = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    return F.when(F.rlike(text, full), pairs).otherwise(F.array().cast(NO_WORDS))


def scan(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, n_base, first_word, last_word, base_labels,
    labels, score`` (earlier columns of these names are replaced).

    A null text counts as empty: no words, no places, null ``first_word`` and
    ``last_word``, empty labels, score 0. Texts of any length are scanned whole. ``score`` is the highest confidence of
    a detection left (a base phrase counts 0.9). Every row, repeated ones too,
    and every other column stays; an empty table gives an empty table."""
    out = docs.withColumn("_l_text", normal(F.col(text_col)))
    first, last, counts, has = [], [], [], []
    for phrase, label in PHRASES:
        there = F.contains("_l_text", F.lit(f" {phrase} "))
        counts.append(F.when(there, F.regexp_count("_l_text", F.lit(f" {phrase}(?= )"))).otherwise(0))
        first.append(F.when(there, _spaces(F.substring_index("_l_text", f" {phrase} ", 1))))
        last.append(F.when(there, _spaces(F.regexp_extract("_l_text", f"(?s)^(.*) {phrase}(?= )", 1))))
        has.append(F.when(there, F.lit(label)))
    all_rules = rules()
    keywords = sorted({r[0] for r in all_rules})
    gate = F.rlike("_l_text", F.lit(" (?:licen[cs]ed?|released|distributed|published|terms"
                                    "|spdx|cc|copyright|domain|unlicense|hereby|redistribut(?:e|ion)"
                                    "|permission|mozilla|reserved|[al]?gplv[23]) "))
    hits = F.filter(F.array(*map(F.lit, keywords)),
                    lambda k: F.contains("_l_text", F.concat(F.lit(" "), k, F.lit(" "))))
    out = out.withColumns({
        "_l_n_words": F.greatest(_spaces(F.col("_l_text")) - 1, F.lit(0)),
        "_l_n_base": sum(counts[1:], counts[0]).cast("long"),
        "_l_first": F.least(*first), "_l_last": F.greatest(*last),
        "_l_base": F.array_compact(F.array(*has)),
        "_l_hits": F.when(gate, hits).otherwise(F.array().cast("array<string>"))})
    live = F.filter(_constant(all_rules), lambda r: F.array_contains(F.col("_l_hits"), r["k"]))
    out = out.withColumn("_l_rules", F.when(F.size("_l_hits") > 0, live))
    found = F.flatten(F.transform("_l_rules", lambda r: F.transform(
        _intervals(F.col("_l_text"), r["p"]), lambda x: F.struct(
            x["s"].alias("s"), (-x["e"]).alias("e"), r["rank"].alias("rank"),
            r["label"].alias("label"), r["c"].alias("c")))))
    out = out.withColumn("_l_found", F.when(F.size("_l_rules") > 0, F.sort_array(found)))
    none = F.struct(F.lit(-1).alias("end"), F.lit(0).alias("rank"),
                    F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("c"))

    def resolve(a, x):
        end = -x["e"]
        goes = (end <= a["end"]) | ((x["s"] <= a["end"]) & (x["rank"] > a["rank"]))
        return F.when(goes, a).otherwise(F.struct(
            end.alias("end"), x["rank"].alias("rank"),
            F.array_union(a["labels"], F.array(x["label"])).alias("labels"),
            F.greatest(a["c"], x["c"]).alias("c")))

    left = F.aggregate("_l_found", none, resolve)
    out = out.withColumn("_l_left", F.coalesce(left, none))
    joined = F.array_join(F.sort_array(F.array_union(F.col("_l_base"), F.col("_l_left")["labels"])), ",")
    # Always true, but not for the optimiser: a later filter isn't pushed below.
    here = F.monotonically_increasing_id() >= 0
    results = {
        "n_words": F.col("_l_n_words"), "n_base": F.col("_l_n_base"),
        "first_word": F.col("_l_first"), "last_word": F.col("_l_last"),
        "base_labels": F.array_join(F.sort_array(F.array_distinct("_l_base")), ","),
        "labels": joined,
        "score": F.greatest(F.col("_l_left")["c"],
                            F.when(F.size("_l_base") > 0, 0.9).otherwise(0.0))}
    out = out.withColumns({c: F.when(here, x) for c, x in results.items()})
    return out.drop(*(c for c in out.columns if c.startswith("_l_")))
