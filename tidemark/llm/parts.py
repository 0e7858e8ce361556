"""Ids of many parts of texts by one byte-level tokenizer, and a bounded memory of them.

Parts are encoded as they stand, each by itself.  Parts of common letters,
figures and signs are cut into pre-tokens by one pass of a regular expression;
different pre-tokens are handed to the tokenizer's model once, in the letters
of its own vocabulary.  All other parts go through the whole tokenizer.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import unicodedata
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.chunks import Pool

BETWEEN = "\0"  # stands between pieces of text that are handed on together
NOTHING = ""  # the piece with number 0, for that
CALL = 4096  # pre-tokens encoded in one call
KEPT_CHARS = 64  # longer parts are forgotten first

#: Letters and figures up to U+024F, all of them in Unicode since its first versions; the signs among these but the quote,
#: which contractions begin with, and the soft hyphen, which is a format character.
_COMMON = [chr(c) for c in chain(range(0x21, 0x7F), range(0xA1, 0x250)) if c not in (0x27, 0xAD)]
_LETTERS = "".join(c for c in _COMMON if unicodedata.category(c)[0] == "L")
_FIGURES = "".join(c for c in _COMMON if unicodedata.category(c)[0] == "N")
_PRETOKENS = re.compile(rf" ?[{_LETTERS}]+| ?[{_FIGURES}]+| ?[^ \n{BETWEEN}{_LETTERS}{_FIGURES}]+|\n|{BETWEEN}").findall


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}


def different(texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The different ones of many texts, and the place of each text among these."""
    keyed = pc.dictionary_encode(texts)
    return keyed.dictionary.to_numpy(zero_copy_only=False).tolist(), keyed.indices.to_numpy()


class PartIds:
    """Ids by a tokenizer, with a bounded memory of pre-tokens, and of parts that are not cut into these.

    When it is full, those that only one block has asked for go, and all long
    ones; more if these are too few.
    """

    def __init__(self, tokenizer, most: int):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side; no threads within one
        self.tokenizer, self.most = tokenizer, most
        # a byte-level vocabulary writes every byte as one character
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)
        # a part that may hold an added token, such as a special one, goes through the whole tokenizer
        odd = {"'"} | {t.content[:1] for t in tokenizer.get_added_tokens_decoder().values()}
        common = re.escape("".join(c for c in _COMMON if c not in odd))
        cuts = re.compile(rf"\n[{common}]*| ?[{common}]+")
        self.is_common = cuts.fullmatch if self._known_kind() else None
        self.words = Tokenizer(tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        letter = {b: c for c, b in byte_of_letter().items()} | {0: " "}
        self.letters = "".join(letter[b] for b in range(256))
        nothing = np.zeros(1, np.int64)
        self._keep({NOTHING: 0}, np.empty(0, np.uint32), nothing, nothing)

    def _known_kind(self) -> bool:
        """Whether the tokenizer cuts a text as ``_PRETOKENS`` does, and changes nothing before that."""
        t = self.tokenizer
        if t.normalizer is not None or t.pre_tokenizer is None or t.truncation is not None or t.padding is not None:
            return False
        cut = json.loads(t.pre_tokenizer.__getstate__())
        return (cut["type"], cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)

    def of(self, parts: list[str]) -> tuple[Pool, np.ndarray]:
        """Ids of different parts, none of them empty, and the place of each part among these."""
        if len(self.numbers) > self.most or self.chars > 32 * self.most:
            self._forget()
        common = [n for n, part in enumerate(parts) if self.is_common(part)] if self.is_common else []
        rest = np.delete(np.arange(len(parts)), common).tolist()
        pretokens, which = different(pa.array(_PRETOKENS("".join([parts[n] + BETWEEN for n in common])), pa.large_string()))
        if common:
            pretokens[pretokens.index(BETWEEN)] = NOTHING
        if not self._learn_pretokens(pretokens):  # a vocabulary without some of their bytes
            self.is_common = None
            return self.of(parts)
        whole = [parts[n] for n in rest]
        self._learn_whole(whole)
        numbers = np.concatenate((self._known(pretokens)[which], self._known(whole)))
        self.asked[numbers] += 1
        ids, counts = self.take(numbers)
        stops = np.concatenate((np.flatnonzero(numbers == 0), len(which) + np.arange(len(whole))))
        place = np.empty(len(parts), np.int64)
        place[common + rest] = np.arange(len(parts))
        return Pool([ids], np.diff(np.cumsum(counts)[stops], prepend=0)), place

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a sequence of pieces, and how many each has."""
        counts = self.counts[numbers]
        places = np.repeat(self.starts[numbers] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return self.ids[places], counts

    def _known(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.get, pieces, repeat(-1)), np.int64, len(pieces))

    def _unknown(self, pieces: list[str]) -> list[str]:
        return [pieces[n] for n in np.flatnonzero(self._known(pieces) < 0).tolist()]

    def _add(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.numbers)
        self.numbers.update(zip(pieces, range(first, first + len(pieces))))
        self.chars += sum(map(len, pieces))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(counts) - counts))
        self.ids, self.counts = np.concatenate((self.ids, ids)), np.concatenate((self.counts, counts))
        self.asked = np.concatenate((self.asked, np.zeros(len(pieces), np.int64)))

    def _learn_pretokens(self, pieces: list[str]) -> bool:
        new, ids, counts = self._unknown(pieces), [], []
        for start in range(0, len(new), CALL):
            some = new[start : start + CALL]
            raw = (BETWEEN.join(some) + BETWEEN).encode()
            spelled = codecs.charmap_decode(raw, "strict", self.letters)[0]
            ids.append(np.array(self.words.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, np.uint32))
            ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0) - np.arange(len(some))
            if self.bytes_of[ids[-1]].sum() != ends[-1]:
                return False
            counts.append(self._counts(ids[-1], ends))
        if new:
            self._add(new, np.concatenate(ids), np.concatenate(counts))
        return True

    def _learn_whole(self, parts: list[str]) -> None:
        new = self._unknown(parts)
        # such a part would run into its neighbours
        alone = [part for part in new if part[-1].isspace() or part[0] != "\n" and (part[0] != " " or part[1].isspace())]
        if alone:
            found = self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)
            ids = [np.array(one.ids, np.uint32) for one in found]
            self._add(alone, np.concatenate(ids), np.array([len(own) for own in ids], np.int64))
        if firm := list(set(new).difference(alone)):
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(firm)], add_special_tokens=False)[0].ids, np.uint32)
            self._add(firm, ids, self._counts(ids, np.cumsum([len(part.encode()) for part in firm])))

    def _counts(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many ids each part has, by the byte where it ends."""
        return np.diff(np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, side="right"), prepend=0)

    def _keep(self, numbers: dict[str, int], ids: np.ndarray, counts: np.ndarray, asked: np.ndarray) -> None:
        self.numbers, self.ids, self.counts, self.asked = numbers, ids, counts, asked
        self.starts, self.chars = np.cumsum(counts) - counts, sum(map(len, numbers))

    def _forget(self) -> None:
        parts = list(self.numbers)
        short = np.fromiter(map(len, parts), np.int64, len(parts)) < KEPT_CHARS
        short[0] = False
        least = 2
        while (kept := np.flatnonzero(short & (self.asked >= least))).size > self.most // 2:
            least *= 2
        kept = np.concatenate(([0], kept))
        ids, counts = self.take(kept)
        self._keep({parts[n]: i for i, n in enumerate(kept.tolist())}, ids, counts, self.asked[kept] // 2)
