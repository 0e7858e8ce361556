"""Removal of repeated passages by the common-prefix interval tree of an enhanced suffix array.

A passage counts as repeated when a string of ``SPAN`` bytes starts at two
places or more, in one document or in several; all bytes under such a string
go.  One suffix array over everything would need all text in one place, so it
is cut into parts that can be judged by themselves:

1. Every window of ``SPAN`` bytes has an anchor: the ``GRAM`` bytes with the
   smallest hash in it, the last of equal ones.  Equal windows have equal
   anchors at equal places.  A run of windows with one anchor is a fragment.
2. Anchors that occur once are dropped (counted by Spark over all documents).
   The fragments around the others meet by anchor; equal fragments are
   counted per task first, so copies do not gather in one task.
3. The fragments of an anchor get an enhanced suffix array.  A stack scan over
   its common prefixes gives the intervals, and those that can be extended to
   the left in different ways are the maximal repeats; all their occurrences
   are marked, not only neighbours.
4. An anchor with very many different fragments has its fragments dealt out
   to blocks; each block states its windows once, and blocks meet by window.

The marks go back to the documents by fragment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Rows, documents_of, id_and_text, numbered
from tidemark.operators.joins import equal_keys
from tidemark.session import Scratch, written

SPAN = 200  # bytes
GRAM = 48
STRIDE = 1 << 17  # windows hashed at once
BLOCK = 4096  # different fragments in one suffix array


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on."""
    base = 0x9E3779B97F4A7C15
    level, width = data.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D), 1
    while width < 32:
        level = level[:-width] * np.uint64(pow(base, width, 1 << 64)) + level[width:]
        width *= 2
        if width == 16:
            sixteen = level
    both = level[: len(data) - GRAM + 1] * np.uint64(pow(base, 16, 1 << 64)) + sixteen[32 : 32 + len(data) - GRAM + 1]
    both = (both ^ (both >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return both ^ (both >> np.uint64(29))


def anchored_runs(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, last window and the anchor's hash (signed)."""
    firsts, lasts, keys, data = [], [], [], np.frombuffer(raw, np.uint8)
    reach = SPAN - GRAM + 1
    for begin in range(0, len(data) - SPAN + 1, STRIDE):
        hashes = gram_hashes(data[begin : begin + STRIDE + SPAN - 1])
        place = np.arange(len(hashes), dtype=np.uint64)
        low = np.uint64((1 << 20) - 1)
        least, width = (hashes & ~low) | (low - place), 1  # of equal hashes the last
        while 2 * width <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        n = len(hashes) - reach + 1
        least = np.minimum(least[:n], least[reach - width : reach - width + n])
        anchor = (low - (least & low)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        firsts.append(starts + begin)
        lasts.append(np.concatenate((starts[1:], [n])) - 1 + begin)
        keys.append(hashes[anchor[starts]].view(np.int64))
    if not firsts:
        none = np.empty(0, np.int64)
        return none, none, none
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(keys)


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the longest common prefix, ``known`` bytes at least."""
    low, high = known, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def suffix_array(texts: list[bytes], span: int = SPAN) -> list[tuple[bytes, int, int]]:
    """The suffixes of at least ``span`` bytes in order: (suffix, text, start)."""
    return sorted((text[at:], n, at) for n, text in enumerate(texts) for at in range(len(text) - span + 1))


def maximal_repeats(texts: list[bytes], suffixes: list[tuple[bytes, int, int]], span: int = SPAN):
    """Maximal repeats as (length, suffixes), each with all its occurrences, by a stack scan.

    Intervals of the suffix array whose suffixes share ``span`` bytes or more
    are the nodes of the tree.  A node is maximal if its suffixes are preceded
    by different bytes; the start of a text differs from everything.
    """
    def before(entry: tuple[bytes, int, int]) -> int:
        return texts[entry[1]][entry[2] - 1] if entry[2] else -1  # -1: differing

    stack: list[list[int]] = []  # common prefix, first suffix, byte before (-1: several)
    for at in range(1, len(suffixes) + 1):
        shared = 0
        if at < len(suffixes):
            a, b = suffixes[at - 1][0], suffixes[at][0]
            if a[:span] == b[:span]:
                shared = common_prefix(a, b, span)
        first, byte = at - 1, before(suffixes[at - 1])
        while stack and stack[-1][0] > shared:
            length, first, own = stack.pop()
            byte = own if own == byte else -1
            if byte == -1:
                yield length, suffixes[first:at]
        if shared:
            if stack and stack[-1][0] == shared:
                stack[-1][2] = byte if stack[-1][2] == byte else -1
            else:
                stack.append([shared, first, byte])


def merged_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of (start, end) runs; runs that touch become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = out[-1][0], end
        else:
            out.append((start, end))
    return out


def _pack(runs: list[tuple[int, int]]) -> bytes:
    return np.array(runs, "<i4").tobytes()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3).compress
    out = Rows(pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("z", pa.binary())]))
    for uid, doc_id, text in documents_of(batches):
        z = squeeze(text.encode("utf-8"))
        out.add(uid, doc_id, z, size=len(z))
        if out.full():
            yield out.batch()
    yield from out.drain()


def _unpacker():
    import zstandard

    return zstandard.ZstdDecompressor().decompress


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = _unpacker()
    for uid, z in documents_of(batches):
        _, _, keys = anchored_runs(unpack(z))
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), uid, np.int64)), pa.array(keys)], names=["uid", "key"])


FRAGMENT = [
    ("key", pa.int64()), ("block", pa.int32()), ("blocks", pa.int32()), ("fh", pa.binary()), ("n", pa.int64()),
    ("fragment", pa.binary()), ("uid", pa.int64()), ("first", pa.int64()),
]


def _fragments(block: int):
    """Documents and their repeated anchors -> a row per occurrence, and a row per different fragment of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, out, own, size = _unpacker(), Rows(pa.schema(FRAGMENT)), {}, 0
        for uid, z, marked in documents_of(batches, 32):
            counts, raw = {m["key"]: m["n"] for m in marked}, unpack(z)
            for first, last, key in zip(*[column.tolist() for column in anchored_runs(raw)]):
                if (n := counts.get(key)) is None:
                    continue
                fragment = raw[first : last + SPAN]
                fh = xxhash.xxh3_128_digest(fragment)
                out.add(None, None, None, fh, None, None, uid, first, size=40)
                if fh in own:
                    own[fh][3] += 1
                else:
                    blocks = -(-n // block)
                    own[fh] = [key, int.from_bytes(fh[:8], "little") % blocks, blocks, 1, fragment]
                    size += len(fragment) + 200
                if out.full():
                    yield out.batch()
            if size > 48 << 20:
                yield from _counted(own)
                own, size = {}, 0
        yield from out.drain()
        yield from _counted(own)

    def _counted(own: dict) -> Iterator[pa.RecordBatch]:
        out = Rows(pa.schema(FRAGMENT))
        for fh, (key, part, blocks, n, fragment) in own.items():
            out.add(key, part, blocks, fh, n, fragment, None, None, size=len(fragment))
            if out.full():
                yield out.batch()
        yield from out.drain()

    return run


VERDICT = [("fh", pa.binary()), ("runs", pa.binary()), ("window", pa.binary()), ("place", pa.int32())]


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragment rows sorted by anchor and block -> marked runs per fragment, and the windows of split anchors."""
    out = Rows(pa.schema(VERDICT))
    for (_, _, blocks), rows in groupby(documents_of(batches), key=lambda row: row[:3]):
        found: dict[bytes, list] = {}
        for _, _, _, fh, n, fragment in rows:
            if fh in found:
                found[fh][1] += n
            else:
                found[fh] = [fragment, n]
        names, texts = list(found), [fragment for fragment, _ in found.values()]
        runs = [[(0, len(fragment))] if n > 1 else [] for fragment, n in found.values()]
        suffixes = suffix_array(texts) if len(texts) > 1 or blocks > 1 else []
        for length, places in maximal_repeats(texts, suffixes):
            for _, text, start in places:
                runs[text].append((start, start + length))
        for fh, marked in zip(names, runs):
            if marked:
                out.add(fh, _pack(merged_runs(marked)), None, None)
        if blocks > 1:
            for window, same in groupby(suffixes, key=lambda s: s[0][:SPAN]):
                _, text, start = next(same)
                alone = next(same, None) is None and found[names[text]][1] == 1
                out.add(names[text] if alone else None, None, xxhash.xxh3_128_digest(window), start if alone else None)
                if out.full():
                    yield out.batch()
        if out.full():
            yield out.batch()
    yield from out.drain()


def repeat_marks(packed: DataFrame, block: int = BLOCK) -> DataFrame:
    """``of, spans`` per document with repeats: spans are (first, runs), the runs relative to ``first``."""
    early = Scratch()
    with early.collect():
        anchors = written(packed.select("uid", "z").mapInArrow(_anchors, "uid bigint, key bigint"), "anchors")
    common = anchors.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").withColumnRenamed("key", "common")
    shared = anchors.join(common, equal_keys(anchors, common, {"key": "common"}))
    lists = shared.groupBy(F.col("uid").alias("of")).agg(F.collect_set(F.struct("key", "n")).alias("marked"))
    pieces = written(
        packed.join(lists, F.col("uid") == F.col("of")).select("uid", "z", "marked").mapInArrow(
            _fragments(block),
            "key bigint, block int, blocks int, fh binary, n bigint, fragment binary, uid bigint, first bigint",
        ),
        "fragments",
    )
    early.drop(packed.sparkSession)
    met = pieces.filter("fragment IS NOT NULL").select("key", "block", "blocks", "fh", "n", "fragment")
    met = met.repartition("key", "block").sortWithinPartitions("key", "block")
    verdicts = written(met.mapInArrow(_verdicts, "fh binary, runs binary, window binary, place int"), "verdicts")
    windows = verdicts.filter("window IS NOT NULL").select("window", F.col("fh").alias("in"), "place")
    twice = windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").withColumnRenamed("window", "again")
    single = windows.filter("place IS NOT NULL")
    across = single.join(twice, equal_keys(single, twice, {"window": "again"})).select(
        F.col("in").alias("mark"), "place", F.lit(None).cast("binary").alias("runs")
    )
    marks = verdicts.filter("runs IS NOT NULL").select(
        F.col("fh").alias("mark"), F.lit(None).cast("int").alias("place"), "runs"
    ).union(across)
    occurrences = pieces.filter("uid IS NOT NULL").select("fh", "uid", "first")
    hit = occurrences.join(marks, equal_keys(occurrences, marks, {"fh": "mark"}))
    return hit.groupBy(F.col("uid").alias("of")).agg(F.collect_list(F.struct("first", "place", "runs")).alias("spans"))


def spans_of(marks: list[dict] | None) -> list[tuple[int, int]]:
    """The marked runs of a document in order, as places in its bytes."""
    found = []
    for mark in marks or ():
        first = mark["first"]
        if mark["runs"] is None:
            found.append((first + mark["place"], first + mark["place"] + SPAN))
        else:
            found += [(first + a, first + b) for a, b in np.frombuffer(mark["runs"], "<i4").reshape(-1, 2).tolist()]
    return merged_runs(found)


def _left(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *[end for _, end in spans]]
    starts = [*[start for start, _ in spans], len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends, starts))


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without characters that are only partly inside."""
    out = []
    for start, end in spans:
        while start < end and raw[start] & 0xC0 == 0x80:
            start += 1
        while start < end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = _unpacker()
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
    out = Rows(pa.schema([*fields, ("kept_sha256", pa.string())]))
    for doc_id, z, marks in documents_of(batches, 32):
        raw, spans = unpack(z), spans_of(marks)
        gone = sum(end - start for start, end in spans)
        out.add(doc_id, len(raw), gone, len(spans), hashlib.sha256(_left(raw, spans)).hexdigest())
        if out.full():
            yield out.batch()
    yield from out.drain()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = _unpacker()
    out = Rows(pa.schema([("uid", pa.int64()), ("left", pa.string())]))
    for uid, z, marks in documents_of(batches, 32):
        raw = unpack(z)
        left = _left(raw, whole_characters(raw, spans_of(marks))).decode("utf-8")
        out.add(uid, left, size=len(left))
        if out.full():
            yield out.batch()
    yield from out.drain()


def _store(rows: DataFrame) -> DataFrame:
    """``uid, doc_id, z``: the texts compressed once, so that they cross the network small."""
    return written(rows.mapInArrow(_packed, "uid bigint, doc_id bigint, z binary"), "packed")


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Null and empty texts have no bytes; texts below ``SPAN`` bytes lose none.
    Repeated rows, also with the same id, are judged each by itself, so copies
    of a long text lose all of it.  An empty table gives no rows; other columns
    are dropped, whatever their names.  A text is cut whole in one task, with
    some 20 bytes a byte.
    """
    rows = id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    packed = _store(rows)
    marked = packed.join(repeat_marks(packed, block), F.col("uid") == F.col("of"), "left").select("doc_id", "z", "spans")
    return marked.mapInArrow(
        _digests, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` without its repeated passages: every row stays, with all columns, and loses the marked bytes.

    A character that is only partly under a mark stays whole.  Rows without a
    mark keep their text as it was, null included.  Columns may have any name;
    an empty table gives an empty one.
    """
    flat, text_at = numbered(docs), f"c{docs.columns.index(text_col)}"
    source = written(flat.withColumn("uid", F.monotonically_increasing_id()), "rows")
    packed = _store(
        source.select("uid", F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col(text_at).cast("string"), F.lit("")).alias("text"))
    )
    marks = repeat_marks(packed, block)
    changed = packed.join(marks, F.col("uid") == F.col("of")).select("uid", "z", "spans").mapInArrow(
        _texts, "uid bigint, left string"
    ).withColumnRenamed("uid", "of")
    joined = source.join(changed, F.col("uid") == F.col("of"), "left")
    columns = [F.coalesce("left", c).alias(c) if c == text_at else F.col(c) for c in flat.columns]
    return joined.select(*columns).toDF(*docs.columns)
