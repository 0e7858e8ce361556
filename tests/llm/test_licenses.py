"""License scans against a plain scan of each text."""

import re

from tidemark.llm.licenses import BASE, RULES, license_scan


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, base = [], set()
    for phrase, label in BASE:
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                starts.append(i)
                base.add(label)
    joined = " " + " ".join(words) + " "
    hits = [
        (m.start(), m.end(), rank, rule.label)
        for rank, rule in enumerate(RULES) if rule.keyword in joined
        for m in re.finditer(f" (?:{rule.pattern})(?= )", joined, re.ASCII)
    ]
    stays = [
        h for h in hits
        if not any(o[0] <= h[0] and h[1] <= o[1] and (o[1] - o[0] > h[1] - h[0] or o[2] < h[2]) for o in hits if o is not h)
    ]
    n = len(stays) + len(starts)
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | {h[3] for h in stays})), n / (n + 1),
    )


TEXTS = [
    None, "", "...", "cc by", "CC-BY", "Licensed under CC BY-SA 4.0, see the file.", "GNU General Public License v3 or later",
    "all rights reserved all rights reserved All Rights RESERVED", "ACC by, cc byte", "x " * 3000 + "MIT License " + "y " * 3000,
    "Apache License, Version 2.0. The MIT license. Copyright (c) 2020 Some Body. All rights reserved.",
    "GNU Lesser General Public License 2.1 and GNU Affero General Public License 3 only", "cc by cc by cc by cc",
    "Creative Commons Attribution-ShareAlike 3.0 Unported License", "wörter über cc by, ünd GPL", "BSD 3-Clause License",
]


def test_same_as_plain_scan(docs):
    got = {row[0]: tuple(row[1:]) for row in license_scan(docs(TEXTS)).collect()}
    assert got == {n: plain(text) for n, text in enumerate(TEXTS)}


def test_gaps_take_any_words(docs):
    holder = "The Regents of the University of California and the named contributors to it"
    texts = [
        "Copyright 2020 Müller GmbH. All rights reserved", "Creative Commons Attribution 3.0 España License",
        f"Copyright (c) 2019, 2020 {holder}. All rights reserved.", "May not be reproduced für ähnliche Zwecke without schriftliche permission",
        "Copyright 2020 A. All rights reserved. Copyright 2021 B. All rights reserved.", "do what the ƒ*ück you want to public license 2",
    ]
    got = {row[0]: tuple(row[1:]) for row in license_scan(docs(texts)).collect()}
    assert got == {n: plain(text) for n, text in enumerate(texts)}
    assert got[0][5] == got[2][5] == got[4][5] == "reserved,reserved-by-copyright"
    assert got[1][5] == "cc-by-3.0" and got[3][5] == "no-reproduction"
    assert got[4][6] == 4 / 5  # two notices and two base places


def test_tables_of_the_driver(spark, sf):
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {row["doc_id"]: row["text"] for row in frame.collect()}
    got = {row[0]: tuple(row[1:]) for row in license_scan(frame).collect()}
    assert got == {n: plain(text) for n, text in texts.items()}


def test_empty_table_repeated_rows_and_clashing_columns(docs):
    assert license_scan(docs([]).limit(0)).collect() == []
    twice = docs([(1, "cc by"), (1, "cc by")]).selectExpr("*", "1 as words", "2 as uid")
    assert [row["base_labels"] for row in license_scan(twice).collect()] == ["cc-by", "cc-by"]


def test_longer_detection_wins(docs):
    row = license_scan(docs(["cc by sa 4 0"])).first()
    assert row["labels"] == "cc-by,cc-by-sa-4.0" and len(RULES) > 200
