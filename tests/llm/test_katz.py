"""The Katz model against one made of dictionaries, and its probabilities added up."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from tidemark.llm import katz, queries

START, END, RARE = "<start>", "<end>", "<rare>"


class Plain:
    """The same model, written down word by word."""

    def __init__(self, texts, frequent):
        texts = [self.words(t) for t in texts]
        self.count = Counter(w for t in texts for w in [*t, END])
        self.tokens = sum(self.count.values())
        self.factor = self.factors(self.count, self.tokens)
        words = sorted((w for w in self.count if w != END), key=lambda w: (-self.count[w], w.encode()))
        self.frequent = set(words[:frequent])
        self.alone = {w: self.factor(c) * c / self.tokens for w, c in self.count.items()}
        self.unknown = 1 - sum(self.alone.values()) if self.tokens else 1.0
        self.classes = {w: p for w, p in self.alone.items() if w in self.frequent or w == END}
        self.classes[RARE] = 1 - sum(self.classes.values()) if self.tokens else 1.0
        self.after = defaultdict(Counter)
        for t in texts:
            line = [START, *map(self.klass, t), END]
            for a, b in zip(line, line[1:]):
                self.after[a][b] += 1
        self.bigram_factor = self.factors(Counter({(a, b): n for a, c in self.after.items() for b, n in c.items()}), self.tokens)

    @staticmethod
    def words(text):
        return [w.decode() for w in (text or "").encode().lower().split()]

    @staticmethod
    def factors(counts, total):
        n = Counter(counts.values())
        for top in (5, 4, 3, 2):
            if all(n[r] for r in range(1, top + 2)):
                common = (top + 1) * n[top + 1] / n[1]
                if common < 1:
                    found = {r: ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) for r in range(1, top + 1)}
                    if all(0 < f < 1 for f in found.values()):
                        return lambda c: found.get(c, 1.0)
        freed = n[1] / total if 0 < n[1] < total else 1 / (total + 1)
        return lambda c: 1 - freed

    def klass(self, word):
        return word if word in self.frequent else RARE

    def of_class(self, a, b):
        follows = self.after.get(a)
        if not follows:
            return self.classes[b]
        total = sum(follows.values())
        kept = sum(self.bigram_factor(n) * n for n in follows.values())
        if len(follows) == len(self.classes):
            total = kept
        elif kept >= total:
            total += 1
        if b in follows:
            return self.bigram_factor(follows[b]) * follows[b] / total
        return (1 - kept / total) / (1 - sum(self.classes[c] for c in follows)) * self.classes[b]

    def of_word(self, a, word):
        if not self.tokens:
            return 1.0
        if word == END or word in self.frequent:
            return self.of_class(a, word)
        return self.of_class(a, RARE) * self.alone.get(word, self.unknown) / self.classes[RARE]

    def row(self, text):
        words = self.words(text)
        line = [START, *map(self.klass, words)]
        base = math.log10(self.tokens + 0.1 * (len(self.count) + 1))
        return (
            len(words) + 1, sum(w in self.count for w in [*words, END]), self.tokens,
            sum(math.log10(self.count[w] + 0.1) - base for w in [*words, END]),
            sum(math.log10(self.of_word(a, w)) for a, w in zip(line, [*words, END])),
        )


def made_up(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 25))) for _ in range(n)]
    return texts + [None, "", " \t ", "W1 w1\x0bÄ ä", "only here", "w0 " * 500, "w0 " * 500]


def same(rows, want):
    rows, want = sorted(map(tuple, rows), key=repr), sorted(want, key=repr)
    assert [r[:4] for r in rows] == [w[:4] for w in want]
    assert np.allclose([r[4:] for r in rows], [w[4:] for w in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("frequent, block, seed", [(65_534, 1_500_000, 1), (20, 7, 2), (3, 40, 3), (0, 13, 4)])
def test_scores_same_as_dictionaries(spark, frequent, block, seed):
    texts = made_up(seed)
    rows = [(n // 2 if n % 5 else None, t, 0) for n, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(4)
    learnt = frame.filter("doc_id % 3 > 0")
    model = katz.fit(learnt, frequent=frequent, block=block)
    plain = Plain([t for i, t, _ in rows if i is not None and i % 3], frequent)
    same(katz.score(frame, model, block=block).collect(), [(i, *plain.row(t)) for i, t, _ in rows])


@pytest.mark.parametrize("classes, block, seed", [(20, 7, 2), (3, 40, 3), (1, 1_500_000, 4)])
def test_words_beyond_the_classes_have_bigrams_of_their_own(spark, monkeypatch, classes, block, seed):
    monkeypatch.setattr(katz, "FREQUENT", classes)
    texts = [*made_up(seed), "w59 w58 w59 w58 new w59", "new new w1 new"]
    rows = [(n // 2 if n % 5 else None, t, 0) for n, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(4)
    plain = Plain([t for i, t, _ in rows if i is not None and i % 3], len(rows) * 1000)
    want = [(i, *plain.row(t)) for i, t, _ in rows]
    same(katz.score(frame, katz.fit(frame.filter("doc_id % 3 > 0"), block=block), block=block).collect(), want)
    marked = frame.selectExpr("*", "doc_id % 3 > 0 AS learns")
    same(katz.fit_and_score(marked, "learns", block=block).collect(), want)


def test_probabilities_add_up_after_every_class(spark):
    for seed, frequent in ((5, 20), (6, 65_534)):
        frame = spark.createDataFrame([(t,) for t in made_up(seed)], "text string")
        model = katz.fit(frame, frequent=frequent)
        classes = model.classes
        outcomes = np.flatnonzero(classes.alone > 0).astype(np.uint32)
        counted = {}
        for r in model.bigrams.collect():
            counted |= dict(zip(katz._keys_unpacked(r["keys"], r["size"]).tolist(), katz._narrow(r["counts"], r["size"]).tolist()))
        for first in np.flatnonzero(classes.counts > 0).tolist():
            keys = np.uint32(first << 16) | outcomes
            counts = np.array([counted.get(k, 0) for k in keys.tolist()])
            assert abs((10 ** classes.scores(keys, counts)).sum() - 1) < 1e-9
        # the words of the common class add up to it
        rare = {r["word"]: r["n"] for r in model.words.collect() if r["word"].encode() not in model.frequent}
        shares = sum(katz.discounted(np.array([n]), classes.word_factors)[0] / classes.tokens for n in rare.values())
        assert abs(shares + classes.unknown - classes.alone[katz.RARE]) < 1e-12


def test_backoff_where_nothing_or_everything_is_left():
    factors = np.array([0, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])
    low = np.zeros((6, 3), np.int64)
    low[1] = [0, 0, 3]
    counts, seen, lower = np.array([0, 90, 3]), np.array([0, 2, 3]), np.array([0, 0.4, 1.0])
    norm, weight = katz.backoff(counts, seen, lower, low, factors, 3)
    assert np.allclose(norm, [1, 91, 1.5]) and np.allclose(weight, [1, (1 / 91) / 0.6, 0])


def test_no_text_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    got = katz.score(frame, katz.fit(frame.limit(0))).collect()
    assert sorted(map(tuple, got)) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert katz.score(frame.limit(0), katz.fit(frame)).collect() == []


def test_query_on_the_smallest_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    held = {d["doc_id"]: crc32(str(d["doc_id"]).encode()) % 10 == 0 for d in docs}
    plain = Plain([d["text"] for d in docs if not held[d["doc_id"]]], 65_534)
    rows = queries.op12_katz_backoff(spark, sf).collect()
    assert {r["doc_id"]: r["held_out"] for r in rows} == held
    same([(r[0], *r[2:]) for r in rows], [(d["doc_id"], *plain.row(d["text"])) for d in docs])
    better = [r["score"] > r["base_score"] for r in rows if r["held_out"]]
    assert sum(better) > 0.9 * len(better)
