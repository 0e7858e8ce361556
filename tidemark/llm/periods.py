"""Periodic runs of words, found by online dyadic square catching.

Words are appended to a sequence.  Whenever a block of ``2 ** k`` words that
begins at a multiple of its length is complete, it becomes a catcher.  A
square (a stretch of words said twice in a row) of period ``p``, with
``2 ** (k + 1) <= p < 2 ** (k + 2)``, has such a block wholly in its first
half, and its copy ``p`` words later; so a catcher lives for the suffixes that
begin two to four block lengths after it, and each appended word meets exactly
two live catchers of every scale: the suffix of ``2 ** k`` words that it
completes is compared with both.  A suffix that agrees is followed in both
directions; a stretch of at least two periods is a square, and squares that
overlap with one period are one run.  A stretch that reaches the last word
stays open and goes on with the next words appended.  Blocks of one word would
catch nearly every word; periods below four are found by comparing each
appended word with the word ``p`` before it and carrying on the length of the
agreement.

Suffixes are compared by fingerprints that double in length, for all words
appended at once in one numpy step per scale.  Fingerprints only propose: a
run is made of words compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.chunks import Numbered
from tidemark.llm.common import Rows, documents_of, id_and_text

Run = tuple[int, int, int]  # start, length, period
DIRECT = 4  # periods below are compared directly
BATCH_WORDS = 200_000  # words appended together; a longer text is a sequence of its own


def words_of(text: str) -> list[bytes]:
    """Words of the contract; bytes are split at exactly its six blanks."""
    return text.encode("utf-8").split()


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Fingerprints of twice the length from those of the two halves."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _agreement(words: np.ndarray, at: int, to: int, stop: int, step: int) -> int:
    """How many words agree from ``at`` and ``to`` on in the direction of ``step``, at most ``stop``."""
    done, size = 0, 8
    while done < stop:
        n = min(size, stop - done)
        if step > 0:
            same = words[at + done : at + done + n] == words[to + done : to + done + n]
        else:
            same = (words[at - done - n : at - done] == words[to - done - n : to - done])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done, size = done + n, size * 2
    return done


class SquareCatcher:
    """Finds the maximal runs of at least ``least`` periods in a sequence of word numbers that grows."""

    def __init__(self, least: int = 2):
        self.least = max(least, 2)
        self.words = np.empty(0, np.int64)
        self.prints: list[np.ndarray] = []  # per scale, of the words from each place on
        self.met = [0] * 64  # per scale, the places whose suffixes have met their catchers
        self.agreed = [0] * DIRECT  # per short period, where the agreement that reaches the last word began
        self.closed: dict[tuple[int, int], int] = {}  # start, end -> smallest period
        self.open: set[tuple[int, int]] = set()  # start, period of stretches that reach the last word

    def append(self, words: np.ndarray) -> None:
        """The next words, a number each."""
        before = len(self.words)
        self.words = np.concatenate((self.words, np.asarray(words, np.int64)))
        stretches, self.open = self.open, set()
        for start, period in stretches:
            self._follow(start, start, period, max(before - period - start, 0))
        for period in range(1, min(DIRECT, len(self.words))):
            self._compare(period, before)
        size, scale = 1, 0
        while 2 * size * self.least <= len(self.words):
            self._lengthen(scale, size)
            if 2 * size >= DIRECT:
                self._meet(scale, size)
            size, scale = 2 * size, scale + 1

    def runs(self) -> list[Run]:
        """Start, length and smallest period of the runs so far, by start, then period."""
        n, best = len(self.words), dict(self.closed)
        for start, period in self.open:
            best[start, n] = min(period, best.get((start, n), period))
        found = [(a, b - a, p) for (a, b), p in best.items() if b - a >= self.least * p]
        return sorted(found, key=lambda r: (r[0], r[2]))

    def _stretch(self, start: int, end: int, period: int) -> None:
        if end == len(self.words):
            self.open.add((start, period))
        elif end - start >= 2 * period:
            self.closed[start, end] = min(period, self.closed.get((start, end), period))

    def _follow(self, start: int, at: int, period: int, known: int) -> int:
        """End of the stretch of ``period`` that began at ``start`` and whose first ``known`` words from ``at`` on agree."""
        a = at + known
        end = a + period + _agreement(self.words, a, a + period, len(self.words) - a - period, 1)
        self._stretch(start, end, period)
        return end

    def _compare(self, period: int, before: int) -> None:
        """Each new word and the one ``period`` before it."""
        first = max(before, period)
        same = self.words[first:] == self.words[first - period : -period]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8))) + first
        begun = self.agreed[period]  # the agreement that ended with the last word before
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            a = begun if a == first and begun else a
            if b == len(self.words):
                self.agreed[period] = a
                if b - a >= period:
                    self.open.add((a - period, period))
                return
            if b - a >= (self.least - 1) * period:
                self._stretch(a - period, b, period)
        self.agreed[period] = 0

    def _lengthen(self, scale: int, size: int) -> None:
        """Fingerprints of the ``size`` words from each new place on."""
        if scale == len(self.prints):
            self.prints.append(np.empty(0, np.uint64))
        done = len(self.prints[scale])
        if scale == 0:
            new = self.words[done:].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D)
            new ^= new >> np.uint64(31)
        else:
            half = self.prints[scale - 1][done:]
            new = _mixed(half[: -size // 2], half[size // 2 :])
        self.prints[scale] = np.concatenate((self.prints[scale], new))

    def _covered(self, size: int) -> np.ndarray | None:
        """Per word, how far the runs with a period of at most ``size`` that began there or before reach."""
        n = len(self.words)
        spans = [(a, b) for (a, b), p in self.closed.items() if p <= size and b - a > 2 * size]
        spans += [(a, n) for a, p in self.open if p <= size and n - a > 2 * size]
        if not spans:
            return None
        reach = np.zeros(n, np.int64)
        a, b = np.array(spans, np.int64).T
        np.maximum.at(reach, a, b)
        return np.maximum.accumulate(reach)

    def _meet(self, scale: int, size: int) -> None:
        """The suffixes completed since, with the two catchers that live for each."""
        prints, words = self.prints[scale], self.words
        places = np.arange(max(self.met[scale], 2 * size), len(prints))
        self.met[scale] = len(prints)
        nearer = (places // size - 2) * size
        caught = []
        for blocks in (nearer, nearer - size):
            alive = blocks >= 0
            agree = prints[places[alive]] == prints[blocks[alive]]
            caught.append(np.stack((blocks[alive][agree], (places - blocks)[alive][agree])))
        at, period = np.concatenate(caught, axis=1)
        reach = self._covered(size) if len(at) else None
        if reach is not None:
            # a block and its copy inside a run of a period that is no longer than the block add nothing to it
            new = reach[at] < at + period + size
            at, period = at[new], period[new]
        order = np.lexsort((at, period))
        last = (0, 0)  # period and end of the stretch followed last
        for a, p in zip(at[order].tolist(), period[order].tolist()):
            if last[0] != p or a + p + size > last[1]:
                left = _agreement(words, a, a + p, a, -1)
                last = (p, self._follow(a - left, a, p, 0))


def runs_of(sequences: list[np.ndarray], least: int, shortest: int) -> list[list[Run]]:
    """Runs of several sequences, appended one after the other with a number of its own between two.

    No period reaches across such a number, so the runs are those of each sequence alone.
    """
    if not sequences:
        return []
    top = max((int(s.max()) for s in sequences if len(s)), default=0)
    joined, starts, at = [], [], 0
    for n, numbers in enumerate(sequences):
        joined += [numbers, np.array([top + 1 + n], np.int64)]
        starts.append(at)
        at += len(numbers) + 1
    found: list[list[Run]] = [[] for _ in sequences]
    edges = np.array(starts)
    catcher = SquareCatcher(least)
    catcher.append(np.concatenate(joined))
    runs = [run for run in catcher.runs() if run[1] >= shortest]
    owners = np.searchsorted(edges, [r[0] for r in runs], side="right") - 1
    for (start, length, period), owner in zip(runs, owners.tolist()):
        found[owner].append((start - starts[owner], length, period))
    return found


def collapsed(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut down to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:n] == 0


def greatest(runs: list[Run]) -> Run | None:
    """The run of the greatest exponent; the smallest start, then period, of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


FIELDS = [
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("period", pa.int64()), ("exponent_milli", pa.int64()),
]
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _judged(least: int, shortest: int, digests: bool, alter: Callable | None):
    ends = [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())] if digests else [
        ("runs", pa.list_(RUN)), ("collapsed", pa.string())]

    def rows(out: Rows, waiting: list) -> None:
        numbers = Numbered()
        sequences = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for _, words in waiting]
        for (doc_id, words), runs in zip(waiting, runs_of(sequences, least, shortest)):
            stay = collapsed(len(words), runs)
            kept = b" ".join(words if stay.all() else [w for w, k in zip(words, stay.tolist()) if k])
            best = greatest(runs)
            shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            if digests:
                listed = "".join([f"{a},{n},{p}\n" for a, n, p in runs]).encode()
                out.add(doc_id, len(runs), *shown, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())
            else:
                listed = [dict(zip(("start", "length", "period"), run)) for run in runs]
                out.add(doc_id, len(runs), *shown, listed, kept.decode("utf-8"), size=len(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, waiting, size = Rows(pa.schema(FIELDS + ends)), [], 0
        for doc_id, text in documents_of(batches):
            words = words_of(text)
            waiting.append((doc_id, alter(doc_id, words) if alter else words))
            size += len(words) + 1
            if size >= BATCH_WORDS:
                rows(out, waiting)
                waiting, size = [], 0
                if out.full():
                    yield out.batch()
        rows(out, waiting)
        yield from out.drain()

    return run


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 4, shortest: int = 6,
    digests: bool = False, alter: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Per document its runs of at least ``least`` periods and ``shortest`` words, and its text without the repeats.

    ``doc_id, n_runs``, the run of the greatest exponent (``start, length,
    period, exponent_milli``; null without runs), ``runs`` (by start, then
    period) and ``collapsed``, the words that are left when each run is cut
    down to its first period, joined by one space; with ``digests`` the SHA-256
    of the last two.  ``alter`` may change the words of a document first.

    Null and empty texts have no words and no runs; a null id stays null.
    Rows with the same id are judged each by itself, an empty table gives no
    rows, and all other columns are dropped, whatever their names.  A text
    is worked on whole in one task, with some 200 bytes a word.
    """
    last = "runs_sha256 string, collapsed_sha256 string" if digests else (
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
    schema = f"doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, {last}"
    return id_and_text(docs, id_col, text_col).mapInArrow(_judged(least, shortest, digests, alter), schema)
