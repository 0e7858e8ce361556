"""Ids from remembered or gathered parts equal those of whole texts."""

import random

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe, chunks, common, packing

PIECES = [" ", "\n", "a", "the", "  ", "\n\n", "\t", "é", "　", "\xa0", "漢", "<|endoftext|>", "'s", "12", ".", "\r", "\nb"]


def odd_texts(n):
    rng = random.Random(1)
    for i in range(n):
        pool = PIECES if i % 2 else PIECES[:4] + PIECES[11:15]
        yield "".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))


def test_ids_of_odd_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, plain = packing.TokenizerIds(path), Tokenizer.from_file(path)
    encode.parts.most = 50  # forgets often
    for text in odd_texts(5000):
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_ids_of_texts_encoded_together():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, plain = packing.TokenizerIds(path), Tokenizer.from_file(path)
    encode.parts.most = 200
    texts = ["", "ends blank  ", " begins", "\n\n", "word", "ends blank  ", "\nline", "a\u00a0", "\u00a0b c\x1c", "'s it", " "]
    texts += list(odd_texts(3000)) + ["again and\nagain " * 40, "x" * 5000]
    for start in range(0, len(texts), 37):
        some = texts[start : start + 37]
        for text, raw in zip(some, encode.encode(some), strict=True):
            assert raw == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_a_worker_forgets_the_parts_when_another_operator_runs():
    path = public_tokenizers.path("byte_bpe_50k.json")
    memory = packing.tokenizer_ids(path)
    list(common.documents_of(iter([]), keeps=path))
    assert packing.tokenizer_ids(path) is memory
    list(common.documents_of(iter([])))
    assert not common.REMEMBERED


def test_two_tiers_on_odd_texts(monkeypatch):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, texts = bpe.Encoder(bpe.PerfectHash(ranks), public_tokenizers.PATTERN), list(odd_texts(3000))
    encoder.known.most = 50  # forgets often
    texts += ["ǅungla ªº ʰ ٣ Ⅷ word\u0301s", "x" * 1000, "don't I'LL 've"]
    for start in range(0, len(texts), 50):
        some = texts[start : start + 50]
        ids, ends = encoder.encode(some)
        for text, own, raw in zip(some, np.split(ids, ends[:-1]), encoder.decode(ids, ends)):
            assert own.tolist() == plain.encode_ordinary(text) and bytes(raw) == text.encode()


def test_the_memory_of_merges_is_bounded():
    memory = chunks.Generations(100)
    for n in range(10_000):
        memory.put(n, n)
        assert memory.get(n) == n and (n < 50 or memory.get(n - 50) == n - 50)
        assert len(memory.young) + len(memory.old) <= 200
    bpe.MERGED.clear()
    encoder = bpe.Encoder(bpe.PerfectHash(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))), public_tokenizers.PATTERN)
    rng = random.Random(3)
    encoder.encode(["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(500)) for _ in range(50)])  # no spaces at all
    assert all(len(key) < bpe.KEPT_BYTES for key in encoder.known.young)
