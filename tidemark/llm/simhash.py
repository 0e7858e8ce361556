"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits.  The
Golay code [23,12,7] is perfect: every 23-bit word is within 3 bits of
exactly one codeword.  The keys of a segment are the codewords within 4 bits
of it, one or six of them.  Two segments that differ in at most 2 bits share
a key: a word half way between them is within 1 bit of both and within 3 of
its codeword.

Of two fingerprints that differ in at most 5 bits, two of the three segments
differ in at most 2 bits each (else two segments had 3 or more).  So
fingerprints are joined on the pair of keys of every pair of segments, and
the bit distance of those that meet is verified.

Fingerprints are made distinct first.  Those that share a key are linked by
a spanning forest, never by all pairs, and components of links by stars.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import documents_of, id_and_text, numbered
from tidemark.llm.components import connected_components
from tidemark.operators.joins import equal_keys
from tidemark.session import written

SHINGLE, DISTANCE, SEED = 4, 4, 42
MOST_DISTANCE = 5
BLOCK = 2048  # fingerprints compared at once; longer runs are split into blocks
SHORT_RUN = 24  # runs up to this length are compared by shifting
GENERATOR = 0xC75  # Golay generator polynomial: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit and width
PAIRS = ((0, 1), (0, 2), (1, 2))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bitwise majority of the shingles' XXH64; 0 without words."""
    words = (text or "").encode("utf-8").lower().split()  # of bytes: A-Z and white space of ASCII only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        some = zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)])
        hashes = np.array([digest(joined[a:b], seed) for a, b in some], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _remainder(word: int) -> int:
    for shift in range(11, -1, -1):
        if word >> (shift + 11) & 1:
            word ^= GENERATOR << shift
    return word


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the single bits, and per syndrome the patterns of weight 4 or less that lead to a codeword.

    Unused places of the second table are -1.
    """
    single = np.array([_remainder(1 << i) for i in range(23)], np.int64)
    patterns: list[list[int]] = [[] for _ in range(2048)]

    def grow(first: int, word: int, syndrome: int, weight: int) -> None:
        patterns[syndrome].append(word)
        if weight < 4:
            for i in range(first, 23):
                grow(i + 1, word | 1 << i, syndrome ^ int(single[i]), weight + 1)

    grow(0, 0, 0, 0)
    most = max(map(len, patterns))
    return single, np.array([p + [-1] * (most - len(p)) for p in patterns], np.int64)


def segment_keys(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Codeword indices (12 bits) near each 23-bit word, -1 where there are fewer than six."""
    single, patterns = tables
    syndrome = np.zeros(len(words), np.int64)
    for i in range(23):
        syndrome ^= np.where(words >> i & 1, single[i], 0)
    near = patterns[syndrome]
    return np.where(near >= 0, (words[:, None] ^ near) >> 11, -1)


def pair_keys(prints: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints, as (key, fingerprint) columns."""
    keys = []
    for first, width in SEGMENTS:
        words = (prints >> np.uint64(first)) & np.uint64((1 << width) - 1)
        keys.append(segment_keys(words.astype(np.int64), tables))
    found, owners = [], []
    for n, (a, b) in enumerate(PAIRS):
        both = (n << 24) | (keys[a][:, :, None] << 12) | keys[b][:, None, :]
        valid = (keys[a][:, :, None] >= 0) & (keys[b][:, None, :] >= 0)
        found.append(both[valid])
        owners.append(np.broadcast_to(prints[:, None, None], valid.shape)[valid])
    return np.concatenate(found), np.concatenate(owners)


def forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is connected within the block: a breadth-first spanning forest."""
    links, rest = [], prints
    while len(rest) > 1:
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            front = queue.pop()
            for at in range(0, len(front), 64):
                some = front[at : at + 64]
                near = np.bitwise_count(some[:, None] ^ rest[None, :]) <= distance
                hit = near.any(axis=0)
                if hit.any():
                    reached = rest[hit]
                    links += zip(some[near[:, hit].argmax(axis=0)].tolist(), reached.tolist())
                    rest = rest[~hit]
                    queue.append(reached)
                if not len(rest):
                    break
    return links


def across(left: np.ndarray, right: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the near pairs between two blocks, breadth first from side to side."""
    links, rests = [], [left, right]
    while len(rests[0]) and len(rests[1]):
        queue, rests[0] = [(0, rests[0][:1])], rests[0][1:]
        while queue:
            side, front = queue.pop()
            for at in range(0, len(front), 64):
                some, rest = front[at : at + 64], rests[1 - side]
                near = np.bitwise_count(some[:, None] ^ rest[None, :]) <= distance
                hit = near.any(axis=0)
                if hit.any():
                    reached = rest[hit]
                    links += zip(some[near[:, hit].argmax(axis=0)].tolist(), reached.tolist())
                    rests[1 - side] = rest[~hit]
                    queue.append((1 - side, reached))
    return links


class Blocks:
    """The fingerprints of one long run, block by block, in a file."""

    def __init__(self) -> None:
        self.file, self.count = tempfile.TemporaryFile(), 0

    def add(self, block: np.ndarray) -> None:
        self.file.seek(0, 2)
        self.file.write(block.tobytes())
        self.count += 1

    def get(self, n: int) -> np.ndarray:
        self.file.seek(n * BLOCK * 8)
        return np.frombuffer(self.file.read(BLOCK * 8), "<u8")


LINK_FIELDS = [("a", pa.int64()), ("b", pa.int64()), ("left", pa.binary()), ("right", pa.binary())]


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    """Link rows with a < b, as signed numbers."""
    both = np.array(links, "<u8").reshape(-1, 2).view("<i8")
    both = np.unique(np.sort(both, axis=1), axis=0)
    none = pa.nulls(len(both), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), none, none], schema=pa.schema(LINK_FIELDS))


def _runs(distance: int):
    """Sorted (key, fingerprint) rows -> link rows, and block pairs of long runs for the next pass."""

    def shifted(keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        found, at, shift = [], np.arange(len(keys)), 1
        while len(at):
            at = at[at + shift < len(keys)]
            at = at[keys[at] == keys[at + shift]]
            near = at[np.bitwise_count(prints[at] ^ prints[at + shift]) <= distance]
            found.append(np.stack([prints[near], prints[near + shift]], axis=1))
            shift += 1
        return np.concatenate(found) if found else np.empty((0, 2), "<u8")

    def long_run(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """One run, in pieces: its blocks by themselves here, pairs of blocks handed on."""
        blocks, rest = Blocks(), np.empty(0, "<u8")
        for part in parts:
            rest = np.concatenate([rest, part])
            while len(rest) >= BLOCK:
                blocks.add(rest[:BLOCK])
                yield _links(forest(rest[:BLOCK], distance))
                rest = rest[BLOCK:]
        if len(rest):
            yield _links(forest(rest, distance))
            if blocks.count:
                blocks.add(rest)
        for i in range(blocks.count):
            left = blocks.get(i).tobytes()
            for j in range(i + 1, blocks.count):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([left], pa.binary()),
                     pa.array([blocks.get(j).tobytes()], pa.binary())],
                    schema=pa.schema(LINK_FIELDS),
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for batch in batches:
                if batch.num_rows:
                    yield batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view("<u8")

        source = pieces()
        keys, prints = np.empty(0, np.int64), np.empty(0, "<u8")
        ended = False
        while not ended:
            more = next(source, None)
            ended = more is None
            if not ended:
                keys, prints = np.concatenate([keys, more[0]]), np.concatenate([prints, more[1]])
            if not len(keys):
                continue
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(keys)])))
            if not ended:  # the last run may go on in the next batch
                if sizes[-1] > BLOCK:
                    yield from _short(keys, prints, starts[:-1], sizes[:-1])
                    open_key, rest = keys[-1], []

                    def tail(first=prints[starts[-1] :]):
                        yield first
                        for more_keys, more_prints in source:
                            same = int(np.searchsorted(more_keys, open_key, side="right"))
                            yield more_prints[:same]
                            if same < len(more_keys):
                                rest.append((more_keys[same:], more_prints[same:]))
                                return

                    yield from long_run(tail())
                    keys, prints = rest[0] if rest else (np.empty(0, np.int64), np.empty(0, "<u8"))
                    if not rest:
                        ended = True
                    continue
                yield from _short(keys, prints, starts[:-1], sizes[:-1])
                keys, prints = keys[starts[-1] :], prints[starts[-1] :]
            else:
                yield from _short(keys, prints, starts, sizes)

    def _short(keys, prints, starts, sizes) -> Iterator[pa.RecordBatch]:
        if not len(starts):
            return
        small = np.repeat((sizes > 1) & (sizes <= SHORT_RUN), sizes)
        end = starts[-1] + sizes[-1]
        pairs = shifted(keys[:end][small], prints[:end][small])
        if len(pairs):
            yield _links(pairs)
        for start, size in zip(starts[sizes > SHORT_RUN].tolist(), sizes[sizes > SHORT_RUN].tolist()):
            yield from long_run(iter([prints[start : start + size]]))

    return run


def _block_pairs(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right in documents_of(batches, 16):
            links = across(np.frombuffer(left, "<u8"), np.frombuffer(right, "<u8"), distance)
            if links:
                yield pa.RecordBatch.from_arrays(_links(links).columns[:2], names=["a", "b"])

    return run


def near_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``a < b`` that connect all of the distinct fingerprints ``fp`` within ``distance`` bits of each other."""
    if not 0 <= distance <= MOST_DISTANCE:
        raise ValueError(f"two segments share a key up to {MOST_DISTANCE} bits, not {distance}")
    tables = golay_tables()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view("<u8")
            for at in range(0, len(own), 2048):
                keys, owners = pair_keys(own[at : at + 2048], tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int32)), pa.array(owners.view("<i8"))], names=["key", "fp"]
                )

    rows = prints.select("fp").mapInArrow(keyed, "key int, fp bigint")
    met = rows.repartition("key").sortWithinPartitions("key", "fp")
    found = written(met.mapInArrow(_runs(distance), "a bigint, b bigint, left binary, right binary"), "links")
    pairs = found.filter("left IS NOT NULL").select("left", "right")
    # one block pair is a fixed amount of work: deal them out evenly
    dealt = pairs.repartition(F.xxhash64("left", "right")).mapInArrow(_block_pairs(distance), "a bigint, b bigint")
    return found.filter("a IS NOT NULL").select("a", "b").union(dealt).distinct()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int = SEED) -> DataFrame:
    """``doc_id`` and ``fp`` (signed) of every row, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), shingle, seed) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(prints, "<u8").view("<i8"))], names=["doc_id", "fp"]
            )

    return written(id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint"), "prints")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hexadecimal) and ``component_id``.

    The component id is the smallest id that links lead to, null only if all
    ids of the component are.  Null and empty texts have fingerprint zero and
    are linked like any other; repeated rows, also with the same id, are in one
    component and have a row each.  An empty table gives no rows; other columns
    are dropped, whatever their names.  A text is hashed whole in one task,
    with some 100 bytes a word.
    """
    rows = fingerprints(docs, id_col, text_col, shingle)
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    stars = connected_components(near_links(prints, distance))
    rooted = prints.join(stars, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of")
    labels = rooted.join(least, equal_keys(rooted, least, {"root": "of"})).select(
        F.col("fp").alias("label"), "component_id"
    )
    return rows.join(labels, equal_keys(rows, labels, {"fp": "label"})).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever the names: one of each component.

    It is that with the smallest id, of equal ids one; a null id comes last.  Null texts count as empty, and texts without
    words are one component.  An empty table gives an empty one.
    """
    flat, place = numbered(docs), {c: f"c{i}" for i, c in enumerate(docs.columns)}
    source = written(flat.withColumn("uid", F.monotonically_increasing_id()), "rows")
    marked = simhash_components(source, "uid", place[text_col], shingle, distance)
    ids = source.select(F.col("uid").alias("of"), F.col(place[id_col]).cast("long").alias("id"))
    ranked = marked.join(ids, F.col("doc_id") == F.col("of"))
    first = ranked.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "of"))["of"].alias("stays")
    )
    gone = written(
        ranked.select("of").join(first, F.col("of") == F.col("stays"), "left_anti").withColumnRenamed("of", "gone"), "gone"
    )
    return source.join(gone, F.col("uid") == F.col("gone"), "left_anti").select(*flat.columns).toDF(*docs.columns)
