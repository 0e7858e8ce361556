"""Tokenizer alignment against whole texts encoded and grouped one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import alignment, queries

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", None, "a", "hello world", "  two  spaces ", "x ▁ y", "▁", "a\tb\n\nc d", "中文字符 测试 \U0001f600", "<|endoftext|> <s> </s>",
    "\0 a", "a" * 300, "end ", " lead", "tab\t x", "word\x1c y", "1234567 890", "x　y z", "\n", "hello world",
]


def random_ends(rng):
    n = rng.randint(1, 60)
    return [np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})) for _ in range(2)]


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 1000])
def test_overlaps_whatever_the_pieces(steps):
    rng = random.Random(steps)
    for _ in range(300):
        a, b = random_ends(rng)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        want = [
            (i, j, sum(c < end for c in common))
            for i, (start, end) in enumerate(zip([0, *a], a)) for j, (s, e) in enumerate(zip([0, *b], b))
            if start < e and s < end
        ]
        assert sorted(zip(*[column.tolist() for column in alignment.overlaps(a, b, steps)])) == want


def test_cuts_make_pieces_of_equal_work():
    rng = random.Random(9)
    for _ in range(200):
        a, b = random_ends(rng)
        cuts = alignment.diagonal_cuts(a, b, 5)
        assert cuts[0] == (0, 0) and cuts[-1] == (len(a), len(b))
        assert all(sum(stop) - sum(start) == 5 for start, stop in zip(cuts, cuts[1:-1]))
        assert all((i == 0 or j == len(b) or a[i - 1] <= b[j]) and (j == 0 or i == len(a) or b[j - 1] < a[i]) for i, j in cuts)


def plain_groups(both, text):
    """Ids of A and B between offsets where both end; none if a text has no tokens."""
    if not text:
        return []
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(both.bytes_a[i] for i in a) != raw or b"".join(both.bytes_b[i] for i in b) != raw:
        return []
    groups, end_a, end_b, left = [([], [])], 0, 0, list(b)
    for token in a:
        groups[-1][0].append(token)
        end_a += len(both.bytes_a[token])
        while end_b < end_a:
            groups[-1][1].append(left[0])
            end_b += len(both.bytes_b[left.pop(0)])
        if end_a == end_b:
            groups.append(([], []))
    return groups[:-1]


def plain_rows(texts):
    both = alignment.TwoTokenizers(*PATHS)
    found = [plain_groups(both, text) for text in texts]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in found]
    counts = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return [
        (
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
            sum(n for pair, n in own.items() if counts[pair] == most[pair[0]]),
            sum(n * counts[pair] for pair, n in own.items()),
            ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups),
        )
        for groups, own in zip(found, links)
    ]


@pytest.mark.parametrize("block, expanded", [(6_000_000, 4096), (200, 2)])
def test_rows_same_as_whole_texts(spark, monkeypatch, block, expanded):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block)
    monkeypatch.setattr(alignment, "EXPANDED", expanded)
    monkeypatch.setattr(alignment, "STEPS", 16)
    texts = ODD * 2 + ["word " * 20_000 + "x"] + ["zzz qqq"] * 300  # repeated rows, a long text, a group of copies
    frame = spark.createDataFrame([(n % 50 or None, t, 1) for n, t in enumerate(texts)], "doc_id bigint, text string, block int")
    got = [tuple(r) for r in alignment.align_tokenizers(frame.repartition(5), *PATHS).collect()]
    assert sorted(map(repr, got)) == sorted(repr((n % 50 or None, *row)) for n, row in enumerate(plain_rows(texts)))
    assert alignment.align_tokenizers(frame.limit(0), *PATHS).collect() == []


def test_query_on_the_smallest_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc, row in zip(docs, plain_rows([d["text"] for d in docs])):
        want[doc["doc_id"]] = (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "")
    got = queries.op13_tokenizer_alignment(spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


def test_a_block_encodes_a_word_once_whatever_signs_follow():
    both, handed = alignment.TwoTokenizers(*PATHS), []
    words = both.parts.words

    class Counted:
        def encode_batch_fast(self, texts, **options):
            handed.extend(len(text) for text in texts)
            return words.encode_batch_fast(texts, **options)

    both.parts.words = Counted()
    rare = ["".join(random.Random(n).choices("bcdfgklmnrt", k=9)) for n in range(200)]
    texts = [" ".join(word + sign for word in rare) for sign in ["", ".", ",", ";", "%%%", "!", ")"]]
    parts, which, owner = alignment.spaced_parts(texts)
    a, b, place, good = both.encode(parts)
    assert good.all() and 0 < sum(handed) < 1.3 * len(texts[0])
    ids, _, counts = a.of(place[which])
    stops = np.cumsum(np.bincount(owner, counts).astype(int))[:-1]
    for text, own in zip(texts, np.split(ids, stops)):
        assert own.tolist() == both.a.encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("odd", [False, True])
def test_parts_stand_in_the_order_of_the_texts(odd):
    texts = ["b a  c", "a b", "", "x\0y z", "c\na b", " b"] if odd else ["a b", "", "c\na b", "b"]
    parts, which, owner = alignment.spaced_parts(texts)
    assert len(set(parts)) == len(parts) and len(which) == len(owner) and owner.tolist() == sorted(owner.tolist())
    for n, text in enumerate(texts):
        assert "".join(parts[w] for w in which[owner == n]) == (" " + text if text else "")


def test_links_of_small_groups_same_as_of_listed_ones(monkeypatch):
    rng = np.random.default_rng(3)
    counts_a, counts_b = rng.integers(1, 4, 500), rng.integers(1, 4, 500)
    ids = rng.integers(0, 9, counts_a.sum()), rng.integers(0, 9, counts_b.sum())
    doc = np.sort(rng.integers(0, 20, 500))
    at_once = alignment.linked(*ids, counts_a, counts_b, doc, 10)
    monkeypatch.setattr(alignment, "EXPANDED", 2)
    for one, other in zip(at_once, alignment.linked(*ids, counts_a, counts_b, doc, 10)):
        assert one.tolist() == other.tolist()
