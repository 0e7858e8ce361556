"""Periodic runs against a search of all periods at all places."""

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from tidemark.llm import periods, queries

ODD = [None, "", " \t\n", "a", "a a a a a a", "a a a a a", "x  y\tx y x\x0by x y x y x y", "é é é é é é é", "a a a"]


def plain_runs(words, least, shortest):
    found = set()
    for p in range(1, len(words) // 2 + 1):
        i = p
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - p]:
                j += 1
            if j - i >= p:
                start, end = i - p, j
                smallest = next(q for q in range(1, p + 1) if all(words[k] == words[k - q] for k in range(start + q, end)))
                if smallest == p and end - start >= max(shortest, least * p):
                    found.add((start, end - start, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_up(rng):
    n, letters = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5])
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        at, p, end = rng.randrange(n), rng.randint(1, max(1, n // 3)), rng.randint(0, n)
        for i in range(at + p, end):
            words[i] = words[i - p]
    return np.array(words, np.int64)


@pytest.mark.parametrize("least, shortest", [(2, 0), (3, 0), (4, 6)])
def test_runs_same_as_all_periods(least, shortest):
    rng = random.Random(least)
    for _ in range(300):
        group = [made_up(rng) for _ in range(rng.randint(1, 3))]
        want = [plain_runs(words.tolist(), least, shortest) for words in group]
        assert periods.runs_of(group, least, shortest) == want


def test_words_may_come_in_any_pieces():
    rng = random.Random(4)
    for _ in range(300):
        words = made_up(rng)
        catcher, at = periods.SquareCatcher(2), 0
        while at < len(words):
            step = rng.choice([1, 1, 3, 10, 40])
            catcher.append(words[at : at + step])
            at += step
            assert catcher.runs() == plain_runs(words[:at].tolist(), 2, 0)


def test_long_sequences_of_one_run():
    for period, n in ((1, 100_000), (7, 100_000), (20_011, 100_000)):
        words = np.arange(n) % period
        assert periods.runs_of([words], 4, 6) == [[(0, n, period)]]


def plain_row(text, alter=lambda words: words):
    words = alter(periods.words_of(text or ""))
    runs = plain_runs(words, 4, 6)
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    return runs, best, milli, b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_rows_of_odd_texts(spark):
    texts = [*ODD, "w " * 30_000 + "end", "one two three " * 5 + "b b b b b b b"]
    rows = [(n // 2, text, "x") for n, text in enumerate(texts)] + [(None, "a a a a a a a", "x")]  # ids twice, and none
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, start string")
    got = sorted(((r["doc_id"], r["runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["collapsed"])
                  for r in periods.periodic_runs(frame).collect()), key=repr)
    want = []
    for n, text, _ in rows:
        if text and len(text) > 50_000:
            want.append((n, [(0, 30_000, 1)], 0, 30_000, 1, 30_000_000, "w end"))
            continue
        runs, best, milli, kept = plain_row(text)
        want.append((n, runs, *best, milli, kept.decode()))
    assert got == sorted(want, key=repr)
    assert periods.periodic_runs(frame.limit(0)).collect() == []


def test_query_on_the_smallest_table(spark, sf):
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs) and sum(r["n_runs"] > 0 for r in got.values()) > 10
    for doc in docs:
        if len(doc["text"]) > 8000:
            continue  # all periods of a long text take too long here
        def tail(words, h=crc32(str(doc["doc_id"]).encode())):
            if h % 10 or not words:
                return words
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]

        runs, best, milli, kept = plain_row(doc["text"], tail)
        row = got[doc["doc_id"]]
        listed = "".join(f"{a},{n},{p}\n" for a, n, p in runs)
        assert tuple(row[1:]) == (len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
