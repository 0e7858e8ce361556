"""License scans by ordered signature rules, in DataFrame functions only.

Texts are reduced to lower-case words.  A rule is a label, a regular
expression over words and a rank; rules belong to families, and a family's
rules are only tried on texts that hold its keyword.  Of overlapping
detections, one that lies inside a longer one is suppressed, and of those
with the same extent the one of the best rank stays.  The rules are made
from names, versions and wordings, a few hundred in all.

Detections are rows (a few numbers each); those of one text meet in windows
that keep a running value, so neither a long text nor one with very many
detections is held in an array of pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import ascii_lower, id_and_text

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Any word in a rule; words may hold characters beyond ASCII, which Java's ``\w`` leaves out.
WORD = "[^ ]+"
HOLDER = 30  # words of a copyright holder at most; the nearest end of the notice counts

#: Phrases and labels that every scan reports.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Rule:
    keyword: str
    label: str
    pattern: str  # of words separated by one space


def _creative_commons() -> list[Rule]:
    spoken = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
    rules = []
    for parts in (("by", "nc", "sa"), ("by", "nc", "nd"), ("by", "sa"), ("by", "nd"), ("by", "nc"), ("by",)):
        short, long = " ".join(parts), " ".join(spoken[p] for p in parts)
        label = "cc-" + "-".join(parts)
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            name = f"{label}-{version.replace(' ', '.')}"
            rules.append(Rule("cc", name, f"cc {short} {version}"))
            rules.append(Rule("commons", name, f"creative commons {long}(?: license)? {version}(?: {WORD})? (?:license|licence)"))
            rules.append(Rule("licenses", name, f"licenses {short} {version}"))
        rules.append(Rule("cc", label, f"cc {short}(?: license)?"))
        rules.append(Rule("commons", label, f"creative commons {long}(?: license)?"))
    for version in ("1 0",):
        rules.append(Rule("cc0", "cc0-1.0", f"cc0(?: {version})?(?: universal)?"))
        rules.append(Rule("publicdomain", "cc0-1.0", f"publicdomain zero {version}"))
    return rules


def _gnu() -> list[Rule]:
    kinds = {
        "agpl": ("affero general public licen[sc]e", ("3",)),
        "lgpl": ("(?:lesser|library) general public licen[sc]e", ("2", "2 1", "3")),
        "gpl": ("general public licen[sc]e", ("1", "2", "3")),
        "gfdl": ("free documentation licen[sc]e", ("1 1", "1 2", "1 3")),
    }
    rules = []
    for short, (name, versions) in kinds.items():
        keyword = "documentation" if short == "gfdl" else "general public"
        for version in versions:
            label = f"{short}-{version.replace(' ', '.')}"
            number = f"v?(?:ersion )?{version}(?: 0)?"
            rules.append(Rule(keyword, f"{label}-or-later", f"(?:gnu )?{name} {number} or (?:any |\\(at your option\\) )?later(?: version)?"))
            rules.append(Rule(keyword, f"{label}-or-later", f"(?:gnu )?{name} as published by the free software foundation either version {version} of the license or at your option any later version"))
            rules.append(Rule(keyword, f"{label}-only", f"(?:gnu )?{name} {number} only"))
            rules.append(Rule(keyword, label, f"(?:gnu )?{name} {number}"))
            rules.append(Rule(short, f"{label}-or-later", f"{short} v?{version}(?: 0)? or later"))
            rules.append(Rule(short, f"{label}-only", f"{short} v?{version}(?: 0)? only"))
            rules.append(Rule(short, label, f"{short} ?v?{version}(?: 0)?"))
        rules.append(Rule(keyword, short, f"(?:gnu )?{name}"))
    return rules


def _named() -> list[Rule]:
    """Families with a name and versions: label, keyword, wording, versions."""
    families = (
        ("apache", "apache", "apache(?: software)? licen[sc]e", ("1 0", "1 1", "2 0")),
        ("mpl", "mozilla", "mozilla public licen[sc]e", ("1 0", "1 1", "2 0")),
        ("epl", "eclipse", "eclipse public licen[sc]e", ("1 0", "2 0")),
        ("cddl", "development and distribution", "common development and distribution licen[sc]e", ("1 0", "1 1")),
        ("eupl", "european union public", "european union public licen[sc]e", ("1 0", "1 1", "1 2")),
        ("cecill", "cecill", "cecill(?: free software)?(?: licen[sc]e)?(?: agreement)?", ("1 0", "1 1", "2 0", "2 1")),
        ("artistic", "artistic", "artistic licen[sc]e", ("1 0", "2 0")),
        ("osl", "open software", "open software licen[sc]e", ("1 0", "1 1", "2 0", "2 1", "3 0")),
        ("afl", "academic free", "academic free licen[sc]e", ("1 1", "1 2", "2 0", "2 1", "3 0")),
        ("ofl", "sil open font", "sil open font licen[sc]e", ("1 0", "1 1")),
        ("bsl", "boost", "boost software licen[sc]e", ("1 0",)),
        ("busl", "business source", "business source licen[sc]e", ("1 0", "1 1")),
        ("sspl", "server side public", "server side public licen[sc]e", ("1",)),
        ("odbl", "open database", "open database licen[sc]e", ("1 0",)),
        ("odc-by", "open data commons attribution", "open data commons attribution licen[sc]e", ("1 0",)),
        ("pddl", "public domain dedication", "public domain dedication and licen[sc]e", ("1 0",)),
        ("psf", "python software foundation", "python software foundation licen[sc]e", ("2",)),
        ("php", "php license", "php license", ("3 0", "3 01")),
        ("zpl", "zope public", "zope public licen[sc]e", ("1 1", "2 0", "2 1")),
        ("lppl", "latex project public", "latex project public licen[sc]e", ("1 0", "1 1", "1 2", "1 3")),
        ("ms-pl", "microsoft public", "microsoft public licen[sc]e", ()),
        ("ms-rl", "microsoft reciprocal", "microsoft reciprocal licen[sc]e", ()),
        ("cpl", "common public license", "common public license", ("1 0",)),
        ("ipl", "ibm public", "ibm public licen[sc]e", ("1 0",)),
        ("apsl", "apple public source", "apple public source licen[sc]e", ("1 0", "1 1", "1 2", "2 0")),
        ("qpl", "q public", "q public licen[sc]e", ("1 0",)),
        ("rpl", "reciprocal public", "reciprocal public licen[sc]e", ("1 1", "1 5")),
        ("ecl", "educational community", "educational community licen[sc]e", ("1 0", "2 0")),
        ("ogl-uk", "open government", "open government licen[sc]e", ("1 0", "2 0", "3 0")),
        ("elastic", "elastic license", "elastic license", ("2 0",)),
        ("hippocratic", "hippocratic", "hippocratic licen[sc]e", ("2 1", "3 0")),
        ("openrail", "responsible ai", "responsible ai licen[sc]e", ("1 0",)),
        ("mulan-psl", "mulan", "mulan permissive software licen[sc]e", ("1", "2")),
        ("upl", "universal permissive", "universal permissive licen[sc]e", ("1 0",)),
        ("wtfpl", "do what the", f"do what the {WORD} you want to public licen[sc]e", ("1", "2")),
    )
    rules = []
    for label, keyword, wording, versions in families:
        for version in versions:
            rules.append(Rule(keyword, f"{label}-{version.replace(' ', '.')}", f"(?:the )?{wording} v?(?:ersion )?{version}"))
        rules.append(Rule(keyword, label, f"(?:the )?{wording}"))
    return rules


def _wordings() -> list[Rule]:
    """Licenses known by what they say."""
    return [
        Rule("mit", "mit", "(?:the )?mit licen[sc]e"),
        Rule("mit", "mit", "licensed under(?: the)? mit"),
        Rule("permission is hereby granted", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
        Rule("permission to use", "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
        Rule("isc", "isc", "isc licen[sc]e"),
        *[Rule("bsd", f"bsd-{n}-clause", f"bsd (?:{n}|{word}) clause(?: licen[sc]e)?") for n, word in ((0, "zero"), (2, "two"), (3, "three"), (4, "four"))],
        *[Rule("bsd", f"bsd-{n}-clause", f"(?:{n}|{word}) clause bsd(?: licen[sc]e)?") for n, word in ((0, "zero"), (2, "two"), (3, "three"), (4, "four"))],
        *[Rule("bsd", f"bsd-{n}-clause", f"{name} bsd licen[sc]e") for n, name in ((2, "simplified"), (3, "new"), (3, "revised"), (4, "original"))],
        Rule("bsd", "bsd", "bsd(?: style)? licen[sc]e"),
        Rule("redistribution and use", "bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
        Rule("unlicense", "unlicense", "(?:the )?unlicense"),
        Rule("unencumbered", "unlicense", "free and unencumbered software released into the public domain"),
        Rule("zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
        Rule("as is without any express", "zlib", "provided as is without any express or implied warranty in no event will the authors be held liable"),
        Rule("public domain", "public-domain", "(?:released into|in|dedicated to) the public domain"),
        Rule("rights reserved", "reserved", "all rights (?:are )?reserved"),
        Rule("rights reserved", "some-rights-reserved", "some rights reserved"),
        Rule("rights reserved", "reserved-by-copyright", f"copyright (?:c )?\\d{{4}}(?: \\d{{4}})?(?: {WORD}){{1,{HOLDER}}}? all rights reserved"),
        Rule("proprietary", "proprietary", "proprietary and confidential"),
        Rule("proprietary", "proprietary", "proprietary licen[sc]e"),
        Rule("unauthorized copying", "proprietary", "unauthorized copying of this file via any medium is strictly prohibited"),
        Rule("may not be reproduced", "no-reproduction", f"may not be reproduced(?: {WORD}){{0,8}} without(?: {WORD}){{0,3}} permission"),
        Rule("personal use only", "personal-use", "for personal use only"),
        Rule("commercial use", "non-commercial", "(?:not for|no) commercial use"),
        Rule("evaluation", "evaluation", "for evaluation purposes only"),
        Rule("spdx", "spdx-tag", f"spdx license identifier(?: {WORD}){{1,3}}"),
    ]


#: In order of rank, the best first.
RULES: tuple[Rule, ...] = tuple(_creative_commons() + _gnu() + _named() + _wordings())


def word_text(text: Column) -> Column:
    """The words in lower case, each after one space, and a space at the end; one space for none."""
    words = F.trim(F.regexp_replace(ascii_lower(text), NOT_WORD, " "))
    return F.when(words == "", " ").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _base(words: Column, n_words: Column) -> tuple[Column, Column, Column, Column]:
    """Places, first and last word and labels of the base phrases.

    A text cut at a phrase has one part more than places; what precedes the
    first and follows the last place gives their word numbers.
    """
    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE:
        size = len(phrase.split())
        parts = F.split(words, f" {phrase}(?= )", -1)
        there = F.contains(words, F.lit(f" {phrase} "))
        places.append(F.when(there, F.size(parts) - 1).otherwise(0).cast("long"))
        firsts.append(F.when(there, spaces(F.element_at(parts, 1))))
        lasts.append(F.when(there, n_words - (spaces(F.element_at(parts, -1)) - 1) - size))
        labels.append(F.when(there, F.lit(label)))
    return sum(places[1:], places[0]), F.least(*firsts), F.greatest(*lasts), F.array_compact(F.array(*labels))


def _tried(words: Column, rules: tuple[Rule, ...]) -> Column:
    """The rules, with their rank, of all families whose keyword the text holds."""
    families: dict[str, list[Column]] = {}
    for rank, rule in enumerate(rules):
        entry = F.struct(F.lit(rank).alias("rank"), F.lit(rule.label).alias("label"), F.lit(f" (?:{rule.pattern})(?= )").alias("pattern"))
        families.setdefault(rule.keyword, []).append(entry)
    known = F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*own).alias("rules")) for k, own in families.items()])
    return F.flatten(F.transform(F.filter(known, lambda f: F.contains(words, f["keyword"])), lambda f: f["rules"]))


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``labels`` adds those of the detections that are not suppressed to the
    base labels.  ``score`` is n / (n + 1) for n such detections and base
    places.  Null and empty texts have no words, empty labels and score 0;
    repeated rows, also with the same id, are scanned each by itself; an empty
    table gives no rows; other columns are dropped, whatever their names.  A
    text and its words are values of expressions, of the size that Spark allows
    for one, 2 GB.
    """
    scanned = id_and_text(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", word_text(F.col("text")).alias("words")
    )
    words = F.col("words")
    n_words = F.greatest(spaces(words) - 1, F.lit(0).cast("long"))
    n_base, first, last, labels = _base(words, n_words)
    cut = F.transform(
        _tried(words, rules),
        lambda r: F.struct(
            r["rank"].alias("rank"), r["label"].alias("label"),
            F.transform(F.split(words, r["pattern"], -1), lambda p: F.length(p)).alias("gaps"),
            F.transform(F.regexp_extract_all(words, r["pattern"], F.lit(0)), lambda m: F.length(m)).alias("lengths"),
        ),
    )
    measured = scanned.select(
        "uid", "doc_id", n_words.alias("n_words"), n_base.alias("n_base"), first.alias("first_word"),
        last.alias("last_word"), F.array_sort(labels).alias("base"),
        F.filter(cut, lambda r: F.size(r["lengths"]) > 0).alias("hits"),
    )
    digest = ["uid", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    per_rule = measured.select(*digest, F.explode_outer("hits").alias("hit"))
    # one row per detection; a text without any keeps one row without a length
    rows = per_rule.select(
        *digest, "hit.rank", "hit.label", F.posexplode_outer("hit.lengths").alias("n", "long"), "hit.gaps"
    ).select(*digest, "rank", "label", "n", "long", F.get("gaps", F.col("n")).alias("gap"))
    parted = rows.repartition("uid")
    along = Window.partitionBy("uid", "rank").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    placed = parted.withColumn("end", F.sum(F.col("gap") + F.col("long")).over(along)).withColumn(
        "start", F.col("end") - F.col("long")
    )
    order = Window.partitionBy("uid").orderBy(F.col("start"), F.col("end").desc(), F.col("rank"))
    outer = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    judged = placed.withColumn("stays", F.col("long").isNotNull() & (outer.isNull() | (F.col("end") > outer)))
    summed = judged.groupBy("uid").agg(
        *[F.first(c).alias(c) for c in digest[1:]],
        F.collect_set(F.when(F.col("stays"), F.col("label"))).alias("found"), F.count_if("stays").alias("n"),
    )
    total = F.col("n") + F.col("n_base")
    return summed.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "found")), ",").alias("labels"),
        (total / (total + 1)).alias("score"),
    )
