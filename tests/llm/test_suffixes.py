"""Repeated passages against brute force over all windows."""

import hashlib
import random
from collections import Counter

from tidemark.llm import suffixes
from tidemark.llm.suffixes import SPAN, maximal_repeats, remove_repeats, repeat_digests, suffix_array


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[i : i + SPAN] for raw in raws for i in range(len(raw) - SPAN + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - SPAN + 1):
            if seen[raw[i : i + SPAN]] > 1:
                gone[i : i + SPAN] = b"\x01" * SPAN
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def planted(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß ") for _ in range(rng.randint(1, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, other = prose(80), prose(45)
    texts = [prose(rng.randint(1, 200)) for _ in range(40)]
    texts += [prose(rng.randint(0, 60)) + passage + prose(rng.randint(0, 60)) for _ in range(30)]
    texts += [prose(5) + passage[rng.randint(0, 60) :] + other for _ in range(20)]
    texts += [texts[3]] * 5 + [texts[41][1:]] + [None, "", "x" * 199, "y" * 700, "ab" * 300, prose(40) * 3]
    return texts


def check(docs, texts, **options):
    got = {row[0]: tuple(row[1:]) for row in repeat_digests(docs(texts), **options).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_same_as_brute_force(docs):
    check(docs, planted())


def test_same_when_anchors_are_split_into_blocks(docs):
    check(docs, planted(2), block=3)


def test_same_across_strides(docs, monkeypatch):
    monkeypatch.setattr(suffixes, "STRIDE", 64)
    raw = "".join(planted(3)[:60]).encode()
    first, last, _ = suffixes.anchored_runs(raw)
    assert first.tolist() == [0, *(last[:-1] + 1).tolist()] and last[-1] == len(raw) - SPAN


def test_repeated_ids_and_empty_table(docs):
    text = planted(4)[0] * 3
    rows = repeat_digests(docs([(7, text), (7, text), (None, "short")])).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, len(text.encode()), len(text.encode())]
    assert repeat_digests(docs([]).limit(0)).collect() == []


def test_maximal_repeats_list_all_occurrences():
    texts = [b"xabcdy", b"zabcdw", b"qabcr"]
    found = {(n, tuple(sorted((t, s) for _, t, s in places))) for n, places in
             maximal_repeats(texts, suffix_array(texts, 3), 3)}
    assert found == {(4, ((0, 1), (1, 1))), (3, ((0, 1), (1, 1), (2, 1)))}


def test_remove_keeps_rows_columns_and_characters(spark):
    passage = "é" + "wörter und ".join("abcdefghijklmnopqrstuvwxyz")
    rows = [(1, "ü" + passage, "of"), (2, "ä" + passage, "uid"), (3, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, of string").withColumnRenamed("of", "uid")
    got = {r["doc_id"]: (r["text"], r["uid"]) for r in remove_repeats(frame).collect()}
    assert got == {1: ("ü", "of"), 2: ("ä", "uid"), 3: (None, None)}
