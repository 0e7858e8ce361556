"""Cutting a text where byte-level BPE cannot merge across, so that parts can be looked up."""

from __future__ import annotations

import re

import numpy as np

#: White space other than space and line feed.
_ODD = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_CLEAN = re.compile(r"(?<=\S) (?=\S)")


def _plain(text: str) -> bool:
    """No white space but single spaces, and line feeds without a space beside them."""
    if text.isascii() or not any(c in text for c in _ODD[8:]):
        plain = not any(c in text for c in _ODD[:8])
    else:
        plain = False
    return plain and "  " not in text and " \n" not in text and "\n " not in text and text[:1] != " " and text[-1:] != " "


def clean_parts(text: str) -> list[str]:
    """The text cut at every single space between two characters that are not white space.

    Pre-tokens are made of an optional space and characters after it, or of
    white space, and white space is only cut before its last character.  So
    each part but the first, with its space put back in front, has the same
    pre-tokens alone as in the text.
    """
    return text.split(" ") if _plain(text) else _CLEAN.split(text)


def marked_lines(text: str, mark: str) -> str | None:
    """The text with a mark at every place where it may be cut; none if it is empty, holds marks or has uneven white space.

    These are the places of ``clean_parts`` and, if no two line feeds stand
    together, those before a line feed.  A lone line feed is a pre-token of its
    own, so lines that begin and end with common words are made of common parts.
    """
    if not text or mark in text or not _plain(text):
        return None
    if "\n\n" not in text:
        text = text[0] + text[1:].replace("\n", mark + "\n")
    return text.replace(" ", mark + " ")


def marked_words(text: str, mark: str) -> str | None:
    """A text with a space in front and a mark before every other place of ``clean_parts``; none where ``marked_lines`` has none."""
    if not text or mark in text or not _plain(text):
        return None
    return " " + text.replace(" ", mark + " ")


class Memo(dict):
    """A dictionary that starts anew at a given size, so that a task's memory is bounded."""

    def __init__(self, most: int = 250_000):
        super().__init__()
        self.most = most

    def put(self, key, value) -> None:
        if len(self) >= self.most:
            self.clear()
        self[key] = value


class Generations:
    """A bounded memory of two halves: what is asked for moves to the younger one, and the older one goes when that is full."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Numbered(dict):
    """Things to numbers, in order of appearance."""

    def __missing__(self, thing) -> int:
        number = self[thing] = len(self)
        return number


class Parts:
    """The parts of several texts, each different one once."""

    def __init__(self):
        self.numbers = Numbered()
        self.texts: list[np.ndarray] = []

    def add(self, parts: list) -> None:
        """The parts of the next text; the first may be in a tuple, to be told from the same letters after a space."""
        self.texts.append(np.fromiter(map(self.numbers.__getitem__, parts), np.int64, len(parts)))

    def different(self) -> list[str]:
        return list(self.numbers)

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Of all parts in turn: the number of the part among the different ones, and that of its text."""
        if not self.texts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(self.texts), np.repeat(np.arange(len(self.texts)), [len(t) for t in self.texts])


class Pool:
    """Numbers of many things, one after the other, to be taken many at once."""

    def __init__(self, arrays: list[np.ndarray], counts: np.ndarray):
        self.values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
        self.counts = counts
        self.starts = np.cumsum(counts) - counts

    def take(self, things: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of a sequence of things, and how many each has."""
        counts = self.counts[things]
        places = np.repeat(self.starts[things] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return self.values[places], counts


def blocks_of(rows, limit: int):
    """Lists of (id, text) of some ``limit`` characters; a longer text is in a list with what came before it."""
    waiting, size = [], 0
    for doc_id, text in rows:
        waiting.append((doc_id, text))
        size += len(text) + 64
        if size >= limit:
            yield waiting
            waiting, size = [], 0
    if waiting:
        yield waiting
