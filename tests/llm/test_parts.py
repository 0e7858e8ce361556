"""Ids by pre-tokens that are remembered equal those of whole texts, and each is encoded once."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from tidemark.llm import packing, parts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = ["a", "Word", "élan", "ÿŁ", "ªº", "ж", "漢", "1", "22", "²½", ".", ",,", "%%%", "«»", "—", "'s", "'", "<", "<|endoftext|>"]
SPACES = [" ", " ", " ", "\n", "\n", "  ", "\n\n", "\t", "\0", "\xa0", "\xad", "\x1c", " "]


def random_texts(n, seed=5):
    rng = random.Random(seed)
    for _ in range(n):
        signs = LETTERS + SPACES[: rng.choice([3, 5, len(SPACES)])] * 2
        yield "".join(rng.choice(signs) for _ in range(rng.randint(0, 30)))


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_of_texts_with_all_kinds_of_signs():
    encode, plain = packing.TokenizerIds(PATH), Tokenizer.from_file(PATH)
    encode.parts.most = 300  # forgets often
    texts = list(random_texts(6000))
    for start in range(0, len(texts), 60):
        some = texts[start : start + 60]
        for text, raw in zip(some, encode.encode(some), strict=True):
            assert raw == ids_of(plain, text), text
        assert len(encode.parts.numbers) == len(encode.parts.counts) < 3000
    assert encode.encode([]) == [] and encode.encode(["", ""]) == [b"", b""]


def test_common_signs_are_cut_as_the_tokenizer_cuts_them():
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    for sign in parts._COMMON:
        text = f" a{sign}1{sign}.{sign} {sign}b\n{sign}"
        own = []
        for _, (start, stop) in cut(text):
            own.append(text[start:stop])
        assert parts._PRETOKENS(text) == own, text


def test_a_pretoken_is_encoded_once_whatever_stands_beside_it():
    encode, handed = packing.TokenizerIds(PATH), []
    words, whole = encode.parts.words, encode.parts.tokenizer

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **options):
            handed.extend(len(text) for text in texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    encode.parts.words, encode.parts.tokenizer = Counted(words), Counted(whole)
    rare = ["".join(random.Random(n).choices("bcdfgklmnrt", k=9)) for n in range(200)]
    texts = [" ".join(word + sign for word in rare) for sign in ["", ".", ",", ";", "%%%", "!", ")"]]
    encode.encode(texts[:3])
    encode.encode(texts[3:])
    assert sum(handed) < 1.3 * len(texts[0])  # some 7.5 times that if a word is encoded anew with every sign
    for text, raw in zip(texts, encode.encode(texts)):
        assert raw == ids_of(whole, text)


def test_tokenizers_that_cut_otherwise_are_used_whole():
    texts = list(random_texts(300, seed=6))
    lower, cut = Tokenizer.from_file(PATH), Tokenizer.from_file(PATH)
    lower.normalizer = normalizers.Lowercase()
    cut.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Digits(True), pre_tokenizers.ByteLevel(add_prefix_space=False)])
    for tokenizer in (lower, cut):
        assert parts.PartIds(tokenizer, 100).is_common is None
    special = Tokenizer.from_file(PATH)
    special.encode_special_tokens = True
    own = parts.PartIds(special, 100)
    some = sorted({" " + word for text in texts for word in text.split() if word})
    pool, place = own.of(some)
    ids, counts = pool.take(place)
    for text, raw in zip(some, np.split(ids, np.cumsum(counts)[:-1])):
        assert raw.astype("<u4").tobytes() == ids_of(special, text), text
