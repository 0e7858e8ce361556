"""Byte-level BPE in two tiers.

A pre-token that is itself in the vocabulary is found by a minimal perfect
hash: one displacement per bucket, one slot per token, and the token in that
slot is compared in full.  Any other pre-token is merged: its bytes are a
linked list and a heap gives the adjacent pair with the lowest rank, the
leftmost of equal ones.

Texts are worked on in blocks.  Within a block every different part of the
texts goes through the two tiers once, and the ids of all its texts are
gathered from these; a memory of bounded size keeps what was merged from
block to block.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tidemark.llm.chunks import Generations, Parts, Pool, blocks_of, clean_parts
from tidemark.llm.common import Rows, documents_of, id_and_text

BUCKET = 3  # tokens per bucket on average
BLOCK_CHARS = 6_000_000  # a block ends with the text that reaches this
KEPT_BYTES, KEPT_PIECES = 64, 250_000  # pre-tokens below this length are remembered, and how many in each half


def public_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """A minimal perfect hash over the vocabulary: as many slots as tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = len(ranks)
        self.buckets = self.size // BUCKET + 1
        self.shift = [0] * self.buckets
        self.tokens: list[bytes] = [b""] * self.size
        self.ranks: list[int] = [-1] * self.size
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for token in ranks:
            groups[self._hash(token)[0]].append(token)
        for bucket in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            group = groups[bucket]
            if len(group) < 2:
                break
            shift = 0
            while True:
                slots = {self._slot(token, shift) for token in group}
                if len(slots) == len(group) and all(self.ranks[s] < 0 for s in slots):
                    break
                shift += 1
            self.shift[bucket] = shift
            for token in group:
                self._fill(self._slot(token, shift), token, ranks)
        free = iter([s for s in range(self.size) if self.ranks[s] < 0])
        for bucket, group in enumerate(groups):
            if len(group) == 1:  # a lone token takes any free slot, noted as a negative number
                slot = next(free)
                self.shift[bucket] = -1 - slot
                self._fill(slot, group[0], ranks)

    def _fill(self, slot: int, token: bytes, ranks: dict[bytes, int]) -> None:
        self.tokens[slot], self.ranks[slot] = token, ranks[token]

    def _hash(self, token: bytes) -> tuple[int, int, int]:
        number = xxhash.xxh3_128_intdigest(token)
        return (number & 0xFFFFFFFF) % self.buckets, number >> 32 & 0xFFFFFFFF, number >> 64

    def _slot(self, token: bytes, shift: int) -> int:
        _, first, step = self._hash(token)
        return (first + shift * (step | 1) + shift * shift) % self.size

    def find(self, token: bytes) -> int:
        """Rank of the token, -1 if it is none."""
        number = xxhash.xxh3_128_intdigest(token)
        shift = self.shift[(number & 0xFFFFFFFF) % self.buckets]
        if shift < 0:
            slot = -1 - shift
        else:
            slot = ((number >> 32 & 0xFFFFFFFF) + shift * (number >> 64 | 1) + shift * shift) % self.size
        return self.ranks[slot] if self.tokens[slot] == token else -1


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of the tokens of a piece, by merging its bytes.

    ``after[i]`` is where the token at ``i`` ends and the next one begins; a
    place inside a token points to the last entry, which no pair ends with.  Heap
    entries are single numbers of rank, left token and end of the pair.
    """
    n, rank = len(piece), ranks.get
    after, before = [*range(1, n + 1), -1], [*range(-1, n)]
    bits = n.bit_length()
    low, wide = (1 << bits) - 1, 2 * bits
    heap = [r << wide | i << bits | i + 2 for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        left, end = entry >> bits & low, entry & low
        middle = after[left]
        if after[middle] != end:
            continue  # one of the two has been merged since
        after[left], after[middle], before[end] = end, n, left
        if end < n and (r := rank(piece[left : after[end]])) is not None:
            heappush(heap, r << wide | left << bits | after[end])
        first = before[left]
        if first >= 0 and (r := rank(piece[first:end])) is not None:
            heappush(heap, r << wide | first << bits | end)
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : after[at]]])
        at = after[at]
    return out


#: Per vocabulary, what a worker process has merged before, from task to task; of one vocabulary at a time.
MERGED: dict[bytes, Generations] = {}


class Encoder:
    def __init__(self, lookup: PerfectHash, pattern: str):
        self.lookup = lookup
        self.ranks = dict(zip(lookup.tokens, lookup.ranks))
        self.split = regex.compile(pattern).findall
        self.whole_words = pattern == public_pattern()
        self.texts = pa.array([token for _, token in sorted(zip(lookup.ranks, lookup.tokens))], pa.binary())
        name = hashlib.sha256(self.texts.buffers()[2]).digest()
        if name not in MERGED:
            MERGED.clear()
        self.known = MERGED.setdefault(name, Generations(KEPT_PIECES))

    def _piece(self, piece: str) -> list[int]:
        """The perfect hash first; what it does not hold is merged, or was merged before."""
        raw = piece.encode("utf-8")
        rank = self.lookup.find(raw)
        if rank >= 0:
            return [rank]
        ids = self.known.get(raw)
        if ids is None:
            ids = merged(raw, self.ranks)
            if len(raw) < KEPT_BYTES:  # the memory is bounded in bytes too
                self.known.put(raw, ids)
        return ids

    def _part(self, part: str | tuple[str]) -> list[int]:
        """Ids of the first part of a text, which is in a tuple, or of another one with its space."""
        if isinstance(part, tuple):
            pieces = self.split(part[0])
        elif self.whole_words and part.isalpha():
            return self._piece(" " + part)  # a space and letters are one pre-token
        else:
            pieces = self.split(" " + part)
        return [rank for piece in pieces for rank in self._piece(piece)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text ends."""
        parts = Parts()
        for text in texts:
            first, *rest = clean_parts(text) if text else ("",)
            parts.add([(first,), *rest])
        found = [self._part(part) for part in parts.different()]
        pool = Pool([np.fromiter(chain.from_iterable(found), np.uint32)], np.array([len(f) for f in found], np.int64))
        which, owner = parts.places()
        ids, counts = pool.take(which)
        return ids, np.cumsum(np.bincount(owner, counts, len(texts)).astype(np.int64))

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[memoryview]:
        """The bytes of texts whose ids stand one after the other."""
        if not len(ids):
            return [memoryview(b"")] * len(ends)
        tokens = self.texts.take(pa.array(ids))
        places = np.frombuffer(tokens.buffers()[1], np.int32, len(ids) + 1)
        edges, data = places[np.concatenate(([0], ends))].tolist(), memoryview(tokens.buffers()[2])
        return [data[a:b] for a, b in zip(edges, edges[1:])]


def _encoded(lookup: Broadcast, pattern: str, digests: bool, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(lookup.value, pattern)
        kind = pa.string() if digests else pa.binary()
        fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", kind), ("decoded", kind)]
        out = Rows(pa.schema(fields))
        for docs in blocks_of(documents_of(batches), block):
            ids, ends = encoder.encode([text for _, text in docs])
            raw, edges = memoryview(ids.astype("<u4").tobytes()), [0, *ends.tolist()]
            for (doc_id, _), a, b, decoded in zip(docs, edges, edges[1:], encoder.decode(ids, ends)):
                own = raw[4 * a : 4 * b]
                if digests:
                    out.add(doc_id, b - a, hashlib.sha256(own).hexdigest(), hashlib.sha256(decoded).hexdigest())
                else:
                    out.add(doc_id, b - a, bytes(own), bytes(decoded), size=2 * len(own))
                if out.full():
                    yield out.batch()
        yield from out.drain()

    return run


def bpe_round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False,
    block: int = BLOCK_CHARS,
) -> DataFrame:
    """Per document: ``doc_id, n_tokens, ids, decoded``; with ``digests`` the SHA-256 of the last two instead.

    Ids are little-endian unsigned 32-bit numbers, ``decoded`` the bytes they
    stand for.  Null and empty texts have no ids; rows with the same id, or
    none, are encoded each by itself; an empty table gives no rows; other
    columns are dropped, whatever their names.  A long text is encoded whole in
    one task, with some 60 bytes a token.  The vocabulary is read by the
    driver and its perfect hash, as large as the vocabulary, is broadcast.
    """
    lookup = docs.sparkSession.sparkContext.broadcast(PerfectHash(read_ranks(ranks_path)))
    kind = "string" if digests else "binary"
    schema = f"doc_id bigint, n_tokens bigint, ids {kind}, decoded {kind}"
    return id_and_text(docs, id_col, text_col).mapInArrow(_encoded(lookup, pattern, digests, block), schema)
