"""Best-fit packing of token sequences by exact-complement hashing.

Documents are cut into pieces of at most ``size`` tokens.  How the pieces are
combined depends on their lengths only, of which there are ``size`` at most,
so the plan is made from the number of pieces of each length, a table whose
size does not depend on the data.  Single lengths, pair sums and triple sums
are looked up for combinations that fill a sequence exactly, as many at once
as there are pieces, longest pieces first; what is left goes best-fit, the
longest piece first into the smallest gap that takes it, again many at once.

The plan is a list of patterns (lengths, how often).  Pieces are numbered
within their length by task-wise counts and their offsets, without a global
order, and the number gives a piece its sequence and place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.chunks import blocks_of, clean_parts, marked_lines
from tidemark.llm.common import Rows, documents_of, id_and_text, remembered
from tidemark.llm.parts import BETWEEN, PartIds, different
from tidemark.session import written

SIZE = 2048  # tokens of a sequence
END_ID = 0  # closes every document
BLOCK_CHARS = 4_000_000  # texts encoded together

Pattern = tuple[tuple[int, ...], int]


def _complement(gap: int, most: int, counts: list[int], lengths: list[int]) -> tuple[int, ...] | None:
    """One, two or three available lengths, none above ``most``, that add up to ``gap`` exactly."""
    if gap <= most and counts[gap]:
        return (gap,)
    # pairs, the largest first part first; then triples
    top = bisect_right(lengths, min(most, gap - 1))
    for at in range(top - 1, -1, -1):
        b = lengths[at]
        if 2 * b < gap:
            break
        c = gap - b
        if counts[b] and counts[c] > (b == c):  # the piece set aside may have been the last of its length
            return b, c
    for at in range(top - 1, -1, -1):
        b = lengths[at]
        if 3 * b < gap:
            break
        rest = gap - b
        inner = bisect_right(lengths, min(b, rest - 1))
        for place in range(inner - 1, -1, -1):
            c = lengths[place]
            if 2 * c < rest:
                break
            d = rest - c
            if counts[b] and counts[c] > (c == b) and counts[d] > (d == b) + (d == c):
                return b, c, d
    return None


def plan(histogram: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Patterns that use every piece once: the lengths in a sequence and the number of such sequences."""
    counts = [0] * (size + 1)
    for length, n in histogram.items():
        counts[length] = n
    patterns: list[Pattern] = [((size,), counts[size])] if counts[size] else []
    counts[size] = 0
    lengths = [n for n in range(1, size) if counts[n]]  # ascending, those available

    def take(used: tuple[int, ...], times: int) -> None:
        for length in used:
            counts[length] -= times
            if not counts[length] and length in lengths[bisect_left(lengths, length) : bisect_left(lengths, length) + 1]:
                lengths.pop(bisect_left(lengths, length))

    for first in range(size - 1, 0, -1):
        while counts[first]:
            counts[first] -= 1  # set one aside while its complement is looked up
            found = _complement(size - first, first, counts, lengths)
            counts[first] += 1
            if found is None:
                break
            used = (first, *found)
            times = min(counts[length] // used.count(length) for length in set(used))
            patterns.append((used, times))
            take(used, times)

    # best fit: sequences by the gap they have left, each kind with its number
    gaps: list[int] = []
    open_patterns: dict[int, list[list]] = defaultdict(list)

    def put(gap: int, used: tuple[int, ...], times: int) -> None:
        if gap == 0:
            patterns.append((used, times))
            return
        if not open_patterns[gap]:
            insort(gaps, gap)
        open_patterns[gap].append([used, times])

    for length in range(size - 1, 0, -1):
        while counts[length]:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                # new sequences: each takes as many of this length as fit, the last one the rest
                each = min(size // length, counts[length])
                times = counts[length] // each
                counts[length] -= times * each
                put(size - each * length, (length,) * each, times)
                continue
            gap = gaps[at]
            used, there = open_patterns[gap].pop()
            if not open_patterns[gap]:
                gaps.pop(at)
            each = min(gap // length, counts[length])
            times = min(there, counts[length] // each)
            counts[length] -= times * each
            if there > times:
                put(gap, used, there - times)
            put(gap - each * length, used + (length,) * each, times)
    for kinds in open_patterns.values():
        patterns += [(used, times) for used, times in kinds]
    return patterns


def runs(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """Per length, rows (first number, first sequence, offset): pieces numbered from there on go to
    that sequence and the following ones."""
    next_number: dict[int, int] = defaultdict(int)
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for used, times in patterns:
        offset = 0
        for length in used:
            found[length].append((next_number[length], sequence, offset))
            next_number[length] += times
            offset += length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in found.items()}


class TokenizerIds:
    """Ids by a tokenizer file, with a memory for parts of texts that repeat.

    The texts of a block are cut into parts by Arrow, and each different part
    is looked up or encoded once, as it stands: a first part has no space in
    front, all others that do not begin a line have.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.parts = PartIds(Tokenizer.from_file(path), 250_000)  # some 50 MB

    def __call__(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode([text])[0], "<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers."""
        even, odd, order, found = [], [], [], [b""] * len(texts)
        for n, text in enumerate(texts):
            if (lines := marked_lines(text, BETWEEN)) is not None:
                even.append(lines)
                order.append(n)
            elif text:
                first, *others = clean_parts(text)
                odd.append((n, [first, *[" " + part for part in others]]))
        order += [n for n, _ in odd]
        cut = pc.split_pattern(pa.array(even, pa.large_string()), BETWEEN)
        rest = pa.array([part for _, parts in odd for part in parts], pa.large_string())
        parts, which = different(pa.concat_arrays([cut.flatten(), rest]))
        pool, place = self.parts.of(parts)
        ids, counts = pool.take(place[which])
        sizes = np.concatenate((np.diff(cut.offsets.to_numpy()), np.array([len(own) for _, own in odd], np.int64)))
        stops = (4 * np.concatenate(([0], np.cumsum(counts)))[np.cumsum(sizes)]).tolist()
        raw = ids.astype("<u4").tobytes()
        for n, a, b in zip(order, [0, *stops], stops):
            found[n] = raw[a:b]
        return found


def tokenizer_ids(path: str) -> TokenizerIds:
    return remembered(path, lambda: TokenizerIds(path))


FIELDS = [
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("task", pa.int32()), ("number", pa.int64()),
]


def _pieces(path: str, size: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = tokenizer_ids(path).encode, TaskContext.get().partitionId()
        numbers, out = [0] * (size + 1), Rows(pa.schema(FIELDS))
        last = np.array([end_id], "<u4").tobytes()
        for docs in blocks_of(documents_of(batches, keeps=path), BLOCK_CHARS):
            for (doc_id, _), ids in zip(docs, encode([text for _, text in docs])):
                ids += last
                n = len(ids) // 4
                # all pieces are full but the first
                starts = [0, *range(n % size or size, n, size)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                    raw = ids[4 * a : 4 * b]
                    kept = raw if with_ids else None
                    out.add(doc_id, piece, a, b - a, zlib.crc32(raw), kept, task, numbers[b - a], size=len(raw) if with_ids else 0)
                    numbers[b - a] += 1
                if out.full():
                    yield out.batch()
        yield from out.drain()

    return run


def _place(found: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            numbers = batch.column("number").to_numpy(zero_copy_only=False)
            sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                mine = lengths == length
                rows = found[length]
                at = np.searchsorted(rows[:, 0], numbers[mine], side="right") - 1
                sequences[mine] = rows[at, 1] + numbers[mine] - rows[at, 0]
                offsets[mine] = rows[at, 2]
            kept = batch.drop_columns(["number"])
            names = [*kept.schema.names, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequences), pa.array(offsets)], names=names)

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    size: int = SIZE, end_id: int = END_ID, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, and ``ids``
    (little-endian unsigned 32-bit) if asked for.

    Null and empty texts are one piece that holds the closing id only;
    repeated rows, also with the same id, are packed each by itself; an empty
    table gives no rows; other columns are dropped, whatever their names.  A
    text is encoded whole in one task, with some 60 bytes a token.
    """
    schema = (
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, task int, number bigint"
    )
    cut = id_and_text(docs, id_col, text_col).mapInArrow(_pieces(tokenizer_path, size, end_id, with_ids), schema)
    pieces = written(cut, "pieces")
    counts = written(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    # one row per length, `size` of them at most
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        F.col("task").alias("of"), F.col("length").alias("long"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    numbered = pieces.join(
        first.hint("merge"), (F.col("task") == F.col("of")) & (F.col("length") == F.col("long"))
    ).select(*columns, (F.col("number") + F.col("first")).alias("number"))
    kinds = {"doc_id": "bigint", "piece": "int", "ids": "binary"}
    out = ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in [*columns, "sequence_id", "offset"])
    return numbered.mapInArrow(_place(runs(plan(histogram, size))), out)
