import re

from quayside.llm import license_scan as ls
from tests.llm import cases


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute(text):
    words = words_of(text)
    places = [(k, label) for phrase, label in ls.PHRASES for p in [phrase.split()]
              for k in range(len(words) - len(p) + 1) if words[k:k + len(p)] == p]
    at = [k for k, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in places})))


ROWS = [
    (20, "Licensed under the MIT License, twice under the mit-license."),
    (21, "Apache License, Version 2.0 and the Apache License 2"), (22, "CC BY-NC CC BY NC"),
    (23, "under the mit license" * 3), (24, "This work is under the GNU General Public License, v3."),
    (25, "GNU Lesser General Public License version 2.1 or later"), (26, "SPDX-License-Identifier: MIT"),
    (27, "cc by cc by nc cc by nc sa 4.0"), (28, "all rights reserved copyright"),
    (29, "mit wir gehen"), (30, "released into the public domain"), (31, "cc by nc " * 2000),
    (32, "cc by ncx, xcc by nc"), (33, "\x01 under the mit license \x02"),
    # Line ends of Unicode are letters of a word here.
    (34, "a\u0085b under the mit license"), (35, "x\u2028y z under the mit license cc by nc\u2029"),
    (36, "under the mit license \u2029 cc by nc \u0085"),
]


def test_base_equals_brute_force(spark):
    rows = cases.TEXTS + ROWS
    out = ls.scan(cases.documents(spark, rows))
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"],
                   r["base_labels"]) for r in out.collect()), key=str)
    assert got == sorted(((d, *brute(t)) for d, t in rows), key=str)
    assert out.columns.count("labels") == 1


def test_labels_of_the_method(spark):
    rows = {r["doc_id"]: (r["labels"], r["score"]) for r in
            ls.scan(cases.documents(spark, ROWS)).collect()}
    assert rows[20] == ("mit", 0.95) and rows[24] == ("gpl", 0.8) and rows[26] == ("mit", 1.0)
    assert rows[25] == ("lgpl", 0.8)  # the GPL inside it is suppressed
    assert rows[21][0] == "apache,apache-2" and rows[27][0] == "cc-by,cc-by-nc,cc-by-nc-sa"
    assert rows[28][0] == "proprietary" and rows[30][0] == "public-domain"
    assert rows[29] == ("", 0.0) and rows[31][0] == "cc-by-nc"


def test_base_labels_stay_and_labels_are_sorted(spark):
    for r in ls.scan(cases.documents(spark, ROWS)).collect():
        base, found = (set(filter(None, r[c].split(","))) for c in ("base_labels", "labels"))
        assert base <= found and r["labels"] == ",".join(sorted(found)) and 0 <= r["score"] <= 1


def test_rules_are_ordered_and_gated():
    rules = ls.rules()
    assert len(rules) >= 200
    for keyword, pattern, label, rank, confidence in rules:
        re.compile(pattern)
        assert keyword and label and 0 < confidence <= 1
    ranks = [r[3] for r in rules[:-1 - len(ls.TERMS)]]
    assert ranks == sorted(ranks)


def test_empty_table(spark):
    assert ls.scan(cases.empty(spark)).count() == 0


SIGNED = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this": "mit",
    "Permission is hereby granted, free of charge, to any person or organization": "bsl-1.0",
    "Redistribution and use in source and binary forms, with or without": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any purpose": "isc",
    "This program is free software: you can redistribute it and/or modify it under the terms "
    "of the GNU General Public License as published": "gpl",
    "This library is free software; you can redistribute it and/or modify it under the terms "
    "of the GNU Lesser General Public License": "lgpl",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "the Apache 2.0 license": "apache-2", "licensed under GPLv3": "gpl", "GPLv2 or later": "gpl",
    "LGPLv2.1": "lgpl", "(LGPLv3)": "lgpl", "AGPLv3": "agpl", "the cc zero license": "cc0",
    "CC0 license": "cc0", "(c) 2024. All rights reserved.": "proprietary"}


def test_each_signature_is_found(spark):
    rows = list(enumerate(SIGNED))
    found = {r["doc_id"]: r["labels"] for r in ls.scan(cases.documents(spark, rows)).collect()}
    assert found == {i: SIGNED[t] for i, t in rows}
    near = ["permission is granted to any person", "redistribution in binary forms only",
            "all rights were reserved", "gpl v", "a mozilla browser", "zero license fees"]
    assert {r["labels"] for r in ls.scan(cases.documents(spark, list(enumerate(near)))).collect()
            } == {""}
