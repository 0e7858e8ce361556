"""Alignment of two tokenizers over the same bytes, by merge-path partitioning.

The tokens of both tokenizers end at ascending byte offsets.  Merging the two
lists gives, step by step, every stretch of bytes that one token of each
covers: an overlap.  Where both end, a group of tokens is complete.  The merge
is cut into pieces of equal work before it is done: the cut after ``d`` steps
takes ``i`` ends from A and ``d - i`` from B, and ``i`` is found by a binary
search along the diagonal ``d``, for all cuts at once.  Each piece emits its
overlaps and groups by itself; a group that a cut goes through is put together
again by numbering the groups across pieces.

Texts are worked on in blocks.  A block knows how many of its documents link a
pair of ids; these counts are added up over all blocks, and every block gets
the sums of its own pairs back, so that only different pairs of a block are
shuffled and never the links themselves.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.chunks import clean_parts, marked_words
from tidemark.llm.common import documents_of, id_and_text, packed, unpacked
from tidemark.llm.parts import BETWEEN, PartIds, byte_of_letter, different
from tidemark.session import written

SPACE = "▁"  # stands for a space in the pieces of B
BLOCK_CHARS = 3_000_000  # a block ends after the text that reaches this
STEPS = 65_536  # merge steps of a piece
CHUNK = 1 << 16  # characters that B encodes in one call
EXPANDED = 4096  # links of a group that are listed one by one; of larger groups, different pairs with their number


class Tokens:
    """Ids, byte lengths and the end of each part's tokens, of the parts of a block."""

    def __init__(self, ids: list[np.ndarray], ends: np.ndarray, lengths: np.ndarray):
        self.ids = np.concatenate(ids) if ids else np.empty(0, np.int64)
        self.ends = ends
        self.lengths = lengths[self.ids]

    def of(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and lengths of a sequence of parts, and how many each part has."""
        starts = np.concatenate(([0], self.ends[:-1]))
        counts = (self.ends - starts)[parts]
        places = np.repeat(starts[parts] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return self.ids[places], self.lengths[places], counts


class TwoTokenizers:
    """Encodes parts of texts by a byte-level BPE (A) and a piece BPE with byte fallback (B)."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side; no threads within one
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.parts = PartIds(self.a, 150_000)
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        raw = byte_of_letter()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_a[number] = bytes(raw[c] for c in token) if all(c in raw for c in token) else token.encode()
        self.bytes_b = [self._piece(n) for n in range(self.b.get_piece_size())]
        self.lengths_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(t) for t in self.bytes_b], np.int64)

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace(SPACE, " ").encode()

    def _pieces(self, text: str) -> tuple[np.ndarray, bool]:
        """B's ids of a text that begins with a space, and whether they stand for exactly its bytes."""
        ids = self.b.encode(text[1:], num_threads=1)  # it adds the space
        return np.array(ids, np.int64), b"".join(map(self.bytes_b.__getitem__, ids)) == text.encode()

    def encode(self, parts: list[str]) -> tuple[Tokens, Tokens, np.ndarray, np.ndarray]:
        """Tokens of both for parts with a space in front, the place of each part there, and which both give back.

        For B, parts that begin and end with other characters than white space
        are encoded many in one call: there no token of it reaches from one
        into the next.
        """
        firm = [n for n, p in enumerate(parts) if 1 < len(p) < CHUNK and not (p[1].isspace() or p[-1].isspace())]
        rest = sorted(set(range(len(parts))).difference(firm))
        found: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        good: list[bool] = []

        def alone(part: str) -> None:
            ids, same = self._pieces(part)
            found.append(ids)
            counts.append(np.array([len(ids)]))
            good.append(same)

        def together(some: list[str]) -> None:
            ids, same = self._pieces("".join(some))
            if same:
                ends, stops = np.cumsum([len(part.encode()) for part in some]), np.cumsum(self.lengths_b[ids])
                at = np.searchsorted(stops, ends)
                same = (stops[at] == ends).all()
            if not same:
                for part in some:
                    alone(part)
                return
            found.append(ids)
            counts.append(np.diff(at + 1, prepend=0))
            good.extend([True] * len(some))

        sizes = np.cumsum([len(parts[n]) for n in firm]) // CHUNK
        for some in np.split(np.array(firm, np.int64), np.flatnonzero(np.diff(sizes)) + 1):
            if len(some):
                together([parts[n] for n in some.tolist()])
        for n in rest:
            alone(parts[n])
        order = np.array(firm + rest, np.int64)
        place = np.empty(len(parts), np.int64)
        place[order] = np.arange(len(parts))
        ids_a, counts_a, good_a = self._of_a([parts[n] for n in order.tolist()])
        a = Tokens([ids_a], np.cumsum(counts_a), self.lengths_a)
        b = Tokens(found, np.cumsum(np.concatenate(counts)) if good else np.empty(0, np.int64), self.lengths_b)
        return a, b, place, np.array(good, bool) & good_a

    def _of_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A's ids of texts, how many each has, and which they give back."""
        pool, place = self.parts.of(texts)
        ids, counts = pool.take(place)
        good, ends = np.ones(len(texts), bool), np.cumsum(counts)
        sizes = np.diff(np.concatenate(([0], np.cumsum(self.lengths_a[ids])))[ends], prepend=0)
        tokens = list(map(self.bytes_a.__getitem__, ids.tolist()))
        raw = [text.encode() for text in texts]
        if sizes.tolist() != list(map(len, raw)) or b"".join(tokens) != b"".join(raw):
            edges = [0, *ends.tolist()]
            good[:] = [b"".join(tokens[x:y]) == own for own, x, y in zip(raw, edges, edges[1:])]
        return ids.astype(np.int64), counts, good


def diagonal_cuts(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> list[tuple[int, int]]:
    """Where the merge of two ascending lists stands after every ``steps`` of it, the start and the end included.

    Of equal values A's is first.  One binary search per diagonal, all at once.
    """
    total = len(a) + len(b)
    d = np.arange(0, total, steps)
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        taken = np.zeros(len(d), bool)
        taken[open_] = a[middle[open_]] <= b[d[open_] - 1 - middle[open_]]
        low, high = np.where(taken, middle + 1, low), np.where(open_ & ~taken, middle, high)
    return [*zip(low.tolist(), (d - low).tolist()), (len(a), len(b))]


def merge_piece(
    a: np.ndarray, b: np.ndarray, start: tuple[int, int], stop: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The overlaps of one piece of the merge: the numbers of both tokens, and whether a group ends there.

    Reads the two lists between the cuts, and one value before and after.
    """
    (i0, j0), (i1, j1) = start, stop
    mine, other = a[i0:i1], b[j0:j1]
    n = len(mine) + len(other)
    at_a = np.arange(len(mine)) + np.searchsorted(other, mine, side="left")
    from_a = np.zeros(n, np.int64)
    from_a[at_a] = 1
    end = np.empty(n, np.int64)
    end[at_a] = mine
    end[from_a == 0] = other
    i = i0 + np.cumsum(from_a) - from_a
    j = j0 + np.cumsum(1 - from_a) - (1 - from_a)
    before = max(a[i0 - 1] if i0 else 0, b[j0 - 1] if j0 else 0)
    real = np.diff(end, prepend=before) > 0
    i, j = i[real], j[real]
    return i, j, a[i] == b[j]


def overlaps(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlaps of two lists of token ends over the same bytes: token of A, token of B, group."""
    cuts, found, groups = diagonal_cuts(a, b, steps), [], 0
    for start, stop in zip(cuts, cuts[1:]):
        i, j, closes = merge_piece(a, b, start, stop)
        # numbers of the groups within the piece, from the one that is open at its cut on
        found.append((i, j, groups + np.cumsum(closes) - closes))
        groups += int(closes.sum())
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(column) for column in zip(*found))


def linked(
    ids_a: np.ndarray, ids_b: np.ndarray, counts_a: np.ndarray, counts_b: np.ndarray, doc: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of ids per document: the document, ``a * width + b``, and the number of links.

    ``counts_a`` and ``counts_b`` are the tokens of each group, ``doc`` its document.
    """
    if not len(counts_a):
        return (np.empty(0, np.int64),) * 3
    ends_a, ends_b = np.cumsum(counts_a), np.cumsum(counts_b)
    small = counts_a * counts_b <= EXPANDED
    group = np.repeat(np.arange(len(counts_a)), counts_a)
    tokens = np.flatnonzero(small[group])
    each = counts_b[group[tokens]]
    first = (ends_b - counts_b)[group[tokens]]
    places = np.repeat(first - np.cumsum(each) + each, each) + np.arange(each.sum())
    pairs, docs = np.repeat(ids_a[tokens], each) * width + ids_b[places], np.repeat(doc[group[tokens]], each)
    bits = int(doc.max()).bit_length()
    if small.all() and int(pairs.max()).bit_length() + bits < 63:  # both in one number, each once for one link
        span = np.int64(pairs.max()) + 1
        keys = np.sort(docs * span + pairs)
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        docs, pairs = np.divmod(keys[starts], span)
        return docs, pairs, np.diff(np.append(starts, len(keys)))
    pairs, docs, times = [pairs], [docs], [np.ones(len(places), np.int64)]
    for g in np.flatnonzero(~small).tolist():
        a, na = np.unique(ids_a[ends_a[g] - counts_a[g] : ends_a[g]], return_counts=True)
        b, nb = np.unique(ids_b[ends_b[g] - counts_b[g] : ends_b[g]], return_counts=True)
        pairs.append((a[:, None] * width + b).ravel())
        docs.append(np.full(len(a) * len(b), doc[g]))
        times.append((na[:, None] * nb).ravel())
    pairs, docs, times = np.concatenate(pairs), np.concatenate(docs), np.concatenate(times)
    order = np.lexsort((pairs, docs))
    pairs, docs, times = pairs[order], docs[order], times[order]
    new = np.concatenate(([True], (pairs[1:] != pairs[:-1]) | (docs[1:] != docs[:-1])))
    starts = np.flatnonzero(new)
    return docs[starts], pairs[starts], np.add.reduceat(times, starts)


class Speller:
    """Writes groups as ``a1,a2|b1;a3|b2,b3`` for whole blocks at once."""

    def __init__(self, ids: int):
        numbers = [str(n) for n in range(ids)]
        self.words = pa.array([(n + end).encode() for n in numbers for end in ("", ",", "|", ";")], pa.binary())

    def __call__(self, ids_a, ids_b, counts_a, counts_b, stops: np.ndarray) -> list[bytes]:
        """``stops``: the number of groups before the end of each document."""
        group_a, group_b = (np.repeat(np.arange(len(c)), c) for c in (counts_a, counts_b))
        ends_a, ends_b = np.cumsum(counts_a), np.cumsum(counts_b)
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        end = np.ones(len(ids_a), np.int64)
        end[ends_a - 1] = 2
        codes[np.arange(len(ids_a)) + (ends_b - counts_b)[group_a]] = 4 * ids_a + end
        end = np.ones(len(ids_b), np.int64)
        end[ends_b - 1] = 3
        end[(ends_b[stops[stops > 0] - 1]) - 1] = 0
        codes[np.arange(len(ids_b)) + ends_a[group_b]] = 4 * ids_b + end
        texts = self.words.take(pa.array(codes))
        offsets = np.frombuffer(texts.buffers()[1], np.int32, len(codes) + 1) if len(codes) else np.zeros(1, np.int32)
        data = memoryview(texts.buffers()[2]) if len(codes) else memoryview(b"")
        tokens = np.concatenate(([0], ends_a + ends_b))[stops]
        edges = offsets[np.concatenate(([0], tokens))].tolist()
        return [bytes(data[x:y]) for x, y in zip(edges, edges[1:])]


BLOCKS = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())),
    ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())),
    ("groups", pa.list_(pa.string())), ("n_pairs", pa.list_(pa.int64())), ("places", pa.binary()),
    ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())),
])
KINDS = (
    "block bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>,"
    " n_links array<bigint>, groups array<string>, n_pairs array<bigint>, places binary, times binary,"
    " pairs array<bigint>, docs array<bigint>"
)


def spaced_parts(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different parts of texts, a space in front of each; of all parts in turn, the place among these and the text."""
    even, odd, order = [], [], []
    for n, text in enumerate(texts):
        if (marked := marked_words(text, BETWEEN)) is not None:
            even.append(marked)
            order.append(n)
        elif text:
            odd.append((n, [" " + part for part in clean_parts(text)]))
    cut = pc.split_pattern(pa.array(even, pa.large_string()), BETWEEN)
    rest = pa.array([part for _, parts in odd for part in parts], pa.large_string())
    parts, which = different(pa.concat_arrays([cut.flatten(), rest]))
    sizes = np.concatenate((np.diff(cut.offsets.to_numpy()), np.array([len(own) for _, own in odd], np.int64)))
    order = np.array([*order, *[n for n, _ in odd]], np.int64)
    if odd:  # back to the order of the texts
        starts, back = np.cumsum(sizes) - sizes, np.argsort(order)
        order, sizes = order[back], sizes[back]
        which = which[np.repeat(starts[back] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
    return parts, which, np.repeat(order, sizes)


class BlockAligner:
    def __init__(self, path_a: str, path_b: str, digests: bool):
        self.tokenizers, self.digests = TwoTokenizers(path_a, path_b), digests
        self.width = len(self.tokenizers.bytes_b)
        self.spell = Speller(max(len(self.tokenizers.bytes_a), self.width))

    def __call__(self, number: int, docs: list[tuple[int | None, str]]) -> pa.RecordBatch:
        parts, which, owner = spaced_parts([text for _, text in docs])
        a, b, place, good = self.tokenizers.encode(parts)
        which = place[which]
        bad = np.zeros(len(docs), bool)
        bad[owner[~good[which]]] = True
        which, owner = which[~bad[owner]], owner[~bad[owner]]
        ids_a, lengths_a, per_part_a = a.of(which)
        ids_b, lengths_b, per_part_b = b.of(which)
        ends_a, ends_b = np.cumsum(lengths_a), np.cumsum(lengths_b)
        i, j, group = overlaps(ends_a, ends_b)
        n = int(group[-1]) + 1 if len(group) else 0
        group_a, group_b = np.empty(len(ids_a), np.int64), np.empty(len(ids_b), np.int64)
        group_a[i], group_b[j] = group, group
        counts_a, counts_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        doc_a = np.repeat(owner, per_part_a)
        doc = doc_a[np.cumsum(counts_a) - 1]  # of each group
        n_docs = len(docs)
        n_groups = np.bincount(doc, minlength=n_docs)
        written_out = self.spell(ids_a, ids_b, counts_a, counts_b, np.cumsum(n_groups))
        if self.digests:
            written_out = [hashlib.sha256(w).hexdigest().encode() if w else b"" for w in written_out]
        of, pairs, times = linked(ids_a, ids_b, counts_a, counts_b, doc, self.width)
        different, places, holding = np.unique(pairs, return_inverse=True, return_counts=True)
        n_links = np.zeros(n_docs, np.int64)
        np.add.at(n_links, doc, counts_a * counts_b)
        row = [
            number, [d for d, _ in docs], np.bincount(doc_a, minlength=n_docs),
            np.bincount(np.repeat(owner, per_part_b), minlength=n_docs), n_groups, n_links,
            [w.decode() for w in written_out], np.bincount(of, minlength=n_docs), packed(places), packed(times),
            different, holding,
        ]
        arrays = [pa.array([v], f.type) for v, f in zip(row, BLOCKS)]
        return pa.RecordBatch.from_arrays(arrays, schema=BLOCKS)


def _aligned(path_a: str, path_b: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, waiting, size = BlockAligner(path_a, path_b, digests), [], 0
        number = TaskContext.get().partitionId() << 32
        for doc_id, text in documents_of(batches):
            waiting.append((doc_id, text))
            size += len(text) + 64
            if size >= BLOCK_CHARS:
                yield align(number, waiting)
                waiting, size, number = [], 0, number + 1
        if waiting:
            yield align(number, waiting)

    return run


def _summed(blocks: pa.Table, known: pa.Table) -> pa.Table:
    """Rows of the documents of a block, with the corpus-wide counts of its pairs."""
    row = {name: blocks.column(name)[0] for name in blocks.column_names}
    order = np.argsort(known.column("place").to_numpy())
    count = known.column("count").to_numpy()[order]
    best = known.column("best").to_numpy()[order]
    n_pairs = np.array(row["n_pairs"].as_py(), np.int64)
    total = int(n_pairs.sum())
    places, times = (unpacked(row[c].as_py(), total) for c in ("places", "times"))
    edges = np.concatenate(([0], np.cumsum(n_pairs)))

    def per_document(values: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(values)))[edges])

    return pa.table({
        "doc_id": row["doc_ids"].values, "n_a": row["n_a"].values, "n_b": row["n_b"].values,
        "n_groups": row["n_groups"].values, "n_links": row["n_links"].values,
        "n_best": per_document(times * best[places]) if total else np.zeros(len(n_pairs), np.int64),
        "count_sum": per_document(times * count[places]) if total else np.zeros(len(n_pairs), np.int64),
        "groups": row["groups"].values,
    })


def link_counts(blocks: DataFrame, width: int) -> DataFrame:
    """Every linked pair of ids: ``pair`` (``a * width + b``), ``count`` of documents, ``best`` (1 if no other of its A id has more).

    One A id has as many pairs as B has ids at most, whatever the data.
    """
    pairs = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("one"))
    counts = written(pairs.groupBy(F.col("one.pairs").alias("pair")).agg(F.sum("one.docs").alias("count")), "counts")
    most = counts.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("count").alias("most"))
    joined = counts.withColumn("of", F.expr(f"pair div {width}")).join(most, F.col("of") == F.col("a"))
    return joined.select("pair", "count", (F.col("count") == F.col("most")).cast("bigint").alias("best"))


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    A encodes a space and the text, B the text, to which it adds the space.
    ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids between two byte offsets where
    tokens of both end; with ``digests`` its SHA-256.  All pairs of an A and a
    B token of one group are links; the count of a pair of ids is the number
    of documents that hold it linked.  ``n_best`` are the links whose count is
    the highest of their A id, ``count_sum`` adds the counts of all links.

    Null and empty texts, and texts that one of the two does not give back
    byte by byte, have no tokens: zeros and an empty string.  Rows with the
    same id, or none, are aligned and counted each by itself; an empty table
    gives no rows; all other columns are dropped, whatever their names.  A long
    text is a block of its own and worked on whole in one task, with some 200
    bytes a token.
    """
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    both = id_and_text(docs, id_col, text_col)
    blocks = written(both.mapInArrow(_aligned(path_a, path_b, digests), KINDS), "aligned")
    counts = written(link_counts(blocks, width), "links")
    asked = blocks.select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    known = asked.join(counts, "pair").select("of", "place", "count", "best")
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
    return blocks.drop("pairs", "docs").groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_summed, schema)
