"""Katz backoff language model.

The outcomes are the words, the end of a text and the unknown word.  Word
counts are discounted by Good-Turing, and what that frees is the probability
of the unknown word.  Above the words stands a bigram model: a word seen after
its predecessor has its discounted share of the count; otherwise the model
backs off to the word alone, times a weight that makes the probabilities after
every predecessor add up to one exactly.

The most frequent words, the end and the unknown word are classes of 16 bits.
A bigram of two classes is a number of 32 bits, and all that depends on one
class (counts, backoff weights) is a table of fixed size.  Every other word is
listed: it has a number of its own above the classes, and a bigram with such a
word is a number of 64 bits.  If a number of frequent words is asked for, all
other words are one class together instead, unknown ones included, and each
has its share of the class by its own discounted count.

Texts are cut into blocks of tokens.  A block asks the parts of the word list
for the numbers and counts of its different words that are no classes, and
later the parts of the bigram table for the counts of its different bigrams,
so repeated ones are shuffled once a block, and parts take blocks one after
the other.  Bigrams of two classes, and those of a class and a listed word,
are in the part of their hash; those after a listed word are in the part of
that word's hash, which so knows its weight.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Rows, documents_of, packed, picked, unpacked
from tidemark.session import Scratch, scratch, written

RARE, EDGE = 0, 1  # the class of words without number; the start of a text as predecessor, its end as token
FREQUENT = 65_534  # words that are classes, the most frequent ones; with the two above, 16 bits
CLASSES = 1 << 16  # numbers of listed words begin here
DEPTH = 5  # counts up to here are discounted by Good-Turing
BLOCK_TOKENS = 1_500_000
PART_TOKENS = 2_000_000  # tokens of the corpus for each part of the bigram table
MOST_PARTS = 4096  # of 2 ** 32 bigrams a part then has a million at most, however large the corpus
LIST_WORDS = 200_000  # listed words for each part of the list
KNOWN_WORDS = 400_000  # different words counted by a task before they are passed on


def tokens_of(text: str) -> list[bytes]:
    """Words of the contract, A-Z in lower case; on bytes both are exactly that."""
    return text.encode("utf-8").lower().split()


def discounts(spectrum: np.ndarray, total: int, depth: int = DEPTH) -> np.ndarray:
    """Katz's factors: by count up to ``depth``, and last that of all greater counts.

    ``spectrum[r]`` is the number of things counted ``r`` times.  Good-Turing
    needs all counts up to one above the depth to occur and to give factors
    between 0 and 1; the depth is lowered until they do.  If none will do, all
    counts get one factor that frees the share of the things counted once, or
    one count in all if these are none or everything.
    """
    n = [int(x) for x in spectrum]
    for top in range(depth, 1, -1):
        if not all(n[1 : top + 2]):
            continue
        common = (top + 1) * n[top + 1] / n[1]
        if common >= 1:
            continue
        factors = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, top + 1)]
        if all(0 < f < 1 for f in factors):
            return np.array([0.0, *factors, *[1.0] * (depth + 1 - top)])
    freed = n[1] / total if 0 < n[1] < total else 1 / (total + 1)
    return np.array([0.0, *[1 - freed] * (depth + 1)])


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return counts * factors[np.minimum(counts, len(factors) - 1)]


@dataclass(frozen=True)
class ClassModel:
    """What depends on single classes and on single counts; sent to the tasks."""

    counts: np.ndarray  # of each class
    alone: np.ndarray  # probability of each class alone
    norm: np.ndarray  # what the discounted counts after each class are divided by
    weight: np.ndarray  # of backing off after each class
    word_factors: np.ndarray
    bigram_factors: np.ndarray
    unknown: float  # probability of the unknown word alone
    tokens: int
    distinct: int

    def scores(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log10 probability of the second class of each bigram after the first, given the bigrams' counts."""
        first, second = (keys >> 16).astype(np.int64), (keys & 0xFFFF).astype(np.int64)
        with np.errstate(divide="ignore"):
            seen = np.log10(discounted(counts, self.bigram_factors) / self.norm[first])
            backed_off = np.log10(self.weight[first] * self.alone[second])
        return np.where(counts > 0, seen, backed_off)

    def listed_alone(self, counts: np.ndarray) -> np.ndarray:
        """Probability alone of words outside the classes by their counts; 0 is an unknown word."""
        return np.where(counts > 0, discounted(counts, self.word_factors) / max(self.tokens, 1), self.unknown)

    def base_logs(self, counts: np.ndarray) -> np.ndarray:
        """Log10 of the add-a-tenth probability of tokens counted so often."""
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))


@dataclass(frozen=True)
class Vocabulary:
    words: DataFrame  # word, n
    frequent: list[bytes]
    listed: DataFrame  # part, size, words, counts; the words that are no classes, one row a part
    first: np.ndarray  # number of the first listed word of each part
    whole: bool  # bigrams of listed words are counted; else these are one class
    counts: np.ndarray  # of each class
    alone: np.ndarray  # probability of each class alone
    factors: np.ndarray
    unknown: float
    tokens: int
    distinct: int

    @property
    def outcomes(self) -> int:
        return int((self.alone > 0).sum()) + self.whole * (self.distinct - int((self.counts > 0).sum()))


@dataclass(frozen=True)
class KatzModel:
    vocabulary: Vocabulary
    bigrams: DataFrame  # part, size, keys, counts, and sums per predecessor; one row a part
    parts: int  # of bigrams of two classes; the parts after these are of those with a listed word
    listed_parts: int
    classes: ClassModel

    @property
    def words(self) -> DataFrame:
        return self.vocabulary.words

    @property
    def frequent(self) -> list[bytes]:
        return self.vocabulary.frequent


def unknown_share(factors: np.ndarray, spectrum: np.ndarray, tokens: int) -> float:
    """Probability of the unknown word: what the discounts of all words free; 1 without tokens."""
    if not tokens:
        return 1.0
    low = np.arange(len(spectrum)) * spectrum
    low = low[: DEPTH + 1]
    freed = float((low * (1 - factors[: DEPTH + 1])).sum()) + (1 - float(factors[-1])) * (tokens - int(low.sum()))
    return freed / tokens


# word counts ------------------------------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        arrays = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
        seen.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for (text,) in documents_of(batches):
        seen.update(tokens_of(text))
        if len(seen) >= KNOWN_WORDS:
            yield out()
    if seen:
        yield out()


# words to numbers -------------------------------------------------------------------------------

LIST = "part int, size bigint, words binary, counts binary"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each part of the list, from its words in order."""
    schema = pa.schema([("part", pa.int32()), ("size", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])
    current, words, counts = None, [], []

    def row() -> pa.RecordBatch:
        values = [current, len(words), _joined(words), _wide(np.array(counts, np.int64))]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    for part, word, n in documents_of(batches, 8192):
        if part != current and words:
            yield row()
            words, counts = [], []
        current = part
        words.append(word.encode())
        counts.append(n)
    if words:
        yield row()


def _joined(words: list[bytes]) -> bytes:
    """The words, without line feeds by their nature, behind their length in bytes."""
    raw = b"\n".join(words)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _split(raw: bytes) -> list[bytes]:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True).split(b"\n")


class _Numbers(dict):
    """Words to classes; other words to numbers above these, by their appearance in the block."""

    def __init__(self, frequent: list[bytes]):
        super().__init__((w, n + 2) for n, w in enumerate(frequent))
        self.others: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = CLASSES + len(self.others)
        self.others.append(word)
        return number

    def renew(self) -> list[bytes]:
        others, self.others = self.others, []
        for word in others:
            del self[word]
        return others


BLOCKS = pa.schema([
    ("block", pa.int64()), ("uids", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
    ("learns", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("numbers", pa.binary()),
    ("parts", pa.list_(pa.int32())), ("word_sizes", pa.list_(pa.int64())), ("words", pa.list_(pa.binary())),
])
PIECES = (
    "block bigint, uids array<bigint>, doc_ids array<bigint>, learns array<boolean>, sizes array<bigint>, numbers binary"
)
BLOCK_COLUMNS = PIECES + ", parts array<int>, word_sizes array<bigint>, words array<binary>"
ENCODED = PIECES + ", listed bigint, counts binary"


def _blocks(frequent: list[bytes], parts: int, limit: int):
    """Cuts texts into pieces, each after the token before it, and blocks of these of some ``limit`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, numbers = TaskContext.get().partitionId() << 40, _Numbers(frequent)
        find, waiting, size, n_blocks = numbers.__getitem__, [], 0, 0

        def row() -> pa.RecordBatch:
            others = numbers.renew()
            of = [zlib.crc32(w) % parts for w in others]
            order = sorted(range(len(others)), key=lambda i: (of[i], others[i]))
            rank = np.empty(len(others), np.uint32)
            rank[order] = np.arange(len(others), dtype=np.uint32)
            own, sizes = np.unique(np.array(of, np.int64), return_counts=True)
            ends = np.cumsum(sizes).tolist()
            lists = [_joined([others[i] for i in order[a:b]]) for a, b in zip([0, *ends], ends)]
            tokens = np.concatenate([p[3] for p in waiting])
            far = tokens >= CLASSES
            tokens[far] = CLASSES + rank[tokens[far] - CLASSES]
            values = [
                base + n_blocks, *([p[i] for p in waiting] for i in range(3)), [len(p[3]) for p in waiting],
                packed(tokens), own.tolist(), sizes.tolist(), lists,
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BLOCKS)], schema=BLOCKS)

        for uid, (doc_id, text, learns) in enumerate(documents_of(batches), base):
            words = tokens_of(text)
            for start in range(0, len(words) + 1, limit):
                own = words[max(start - 1, 0) : start + limit]
                ends = start + limit > len(words)
                piece = np.full((not start) + len(own) + ends, EDGE, np.uint32)
                piece[int(not start) : int(not start) + len(own)] = np.fromiter(map(find, own), np.uint32, len(own))
                waiting.append((uid, doc_id, learns, piece))
                size += len(piece)
                if size >= limit:
                    yield row()
                    waiting, size, n_blocks = [], 0, n_blocks + 1
        if waiting:
            yield row()

    return run


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and counts of each block's words, from the rows of a part: its list first, then the blocks that ask."""
    schema = pa.schema([("of", pa.int64()), ("part", pa.int32()), ("places", pa.binary()), ("counts", pa.binary())])
    out, current, places, counts = Rows(schema), None, {}, np.zeros(1, np.int64)
    for part, block, n, raw, known in documents_of(batches, 16):
        if part != current:
            current, places, counts = part, {}, np.zeros(1, np.int64)
        if block is None:
            places = {w: i for i, w in enumerate(_split(raw), 1)}
            counts = np.concatenate(([0], _narrow(known, n)))
            continue
        found = np.array([places.get(w, 0) for w in _split(raw)], np.int64)
        values = packed(found), _wide(counts[found])
        out.add(block, part, *values, size=sum(map(len, values)))
        if out.full():
            yield out.batch()
    yield from out.drain()


def _numbered(first: np.ndarray):
    """The words of a block by their numbers in the list; unknown ones by the class of words without number."""
    names = [f.split()[0] for f in ENCODED.split(", ")]

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        sizes = blocks.column("sizes")[0].as_py()
        parts, word_sizes = blocks.column("parts")[0].as_py(), blocks.column("word_sizes")[0].as_py()
        found = {p: (a, c) for p, a, c in zip(*(answers.column(c).to_pylist() for c in ("part", "places", "counts")))}
        numbers, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for part, n in zip(parts, word_sizes):
            places = unpacked(found[part][0], n)
            numbers.append(np.where(places > 0, first[part] + places - 1, RARE))
            counts.append(_narrow(found[part][1], n))
        numbers, counts = np.concatenate(numbers), np.concatenate(counts)
        tokens = unpacked(blocks.column("numbers")[0].as_py(), sum(sizes))
        far = tokens >= CLASSES
        tokens[far] = numbers[tokens[far] - CLASSES]
        known = np.flatnonzero(numbers >= CLASSES)
        known = known[np.argsort(numbers[known])]
        last = [packed(tokens), len(known), _wide(counts[known])]
        kinds = [pa.binary(), pa.int64(), pa.binary()]
        kept = [blocks.column(c).combine_chunks() for c in names[:5]]
        return pa.table(dict(zip(names, [*kept, *(pa.array([v], t) for v, t in zip(last, kinds))])))

    return run


def encode(texts: DataFrame, vocabulary: Vocabulary, block: int) -> DataFrame:
    """``doc_id, text, learns`` as blocks of numbers, with the counts of their listed words in order of the numbers."""
    parts, null = len(vocabulary.first), F.lit(None)
    with scratch(texts.sparkSession) as own:
        blocks = written(texts.mapInArrow(_blocks(vocabulary.frequent, parts, block), BLOCK_COLUMNS), "blocks")
        asked = blocks.select("block", F.explode(F.arrays_zip("parts", "word_sizes", "words")).alias("cell"))
        kinds = ["part", "block", "size", "words", "counts"]
        asked = asked.select("cell.parts", "block", "cell.word_sizes", "cell.words", null.cast("binary")).toDF(*kinds)
        table = vocabulary.listed.select("part", null.cast("bigint").alias("block"), "size", "words", "counts")
        rows = table.union(asked).repartition(parts, "part").sortWithinPartitions("part", F.col("block").asc_nulls_first())
        answers = rows.mapInArrow(_looked_up, "of bigint, part int, places binary, counts binary")
        plain = blocks.drop("words").groupBy("block").cogroup(answers.groupBy("of"))
        return own.keep(written(plain.applyInArrow(_numbered(vocabulary.first), ENCODED), "numbers"))


# bigrams ----------------------------------------------------------------------------------------

def pairs_of(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Firsts and seconds of sequences that each begin with the token before their first one."""
    joined = np.concatenate(sequences)
    ends = np.cumsum([len(s) for s in sequences])[:-1]
    return np.delete(joined[:-1], ends - 1), np.delete(joined[1:], ends - 1)


class Block:
    """Bigrams of a block of numbers: ``near`` ones of two classes, the others with a listed word."""

    def __init__(self, sizes: list[int], numbers: bytes, listed: int, counts: bytes, whole: bool, only: list[bool] | None = None):
        sequences = np.split(unpacked(numbers, sum(sizes)), np.cumsum(sizes)[:-1])
        self.listed = np.unique(np.concatenate(sequences))
        self.listed, self.listed_counts = self.listed[self.listed >= CLASSES], _narrow(counts, listed)
        self.sequences = sequences if only is None else [s for s, own in zip(sequences, only) if own]
        if not self.sequences:
            self.sequences = [np.empty(0, np.int64)]
        self.first, self.second = pairs_of(self.sequences)
        # without whole bigrams the listed words are one class
        a, b = (n if whole else np.where(n < CLASSES, n, RARE) for n in (self.first, self.second))
        self.near = (a < CLASSES) & (b < CLASSES)
        self.near_keys = (a[self.near] << 16 | b[self.near]).astype(np.uint32)
        self.far_keys = a[~self.near].astype(np.uint64) << np.uint64(32) | b[~self.near].astype(np.uint64)

    def count(self, numbers: np.ndarray) -> np.ndarray:
        """How often listed words were counted; 0 for others."""
        found = np.zeros(len(numbers), np.int64)
        far = numbers >= CLASSES
        found[far] = self.listed_counts[np.searchsorted(self.listed, numbers[far])]
        return found


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)
    return (mixed * np.uint64(parts) >> np.uint64(32)).astype(np.uint16)


def far_part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of a listed word and all its successors, or else of the bigram."""
    first = keys >> np.uint64(32)
    mixed = np.where(first >= CLASSES, first, keys) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    return (mixed * np.uint64(parts) >> np.uint64(32)).astype(np.uint32)


def _in_parts(of: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of ascending keys by part, ascending within it; and the edges of the parts."""
    order = np.argsort(of, kind="stable")
    return order, np.searchsorted(of[order], np.arange(parts + 1))


def _keys_packed(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint32(0)))


def _keys_unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked(raw, n)).astype(np.uint32)


def _far_packed(keys: np.ndarray) -> bytes:
    steps = np.diff(keys, prepend=np.uint64(0))
    return packed(np.concatenate((steps & np.uint64(0xFFFFFFFF), steps >> np.uint64(32))))


def _far_unpacked(raw: bytes, n: int) -> np.ndarray:
    both = unpacked(raw, 2 * n).astype(np.uint64)
    return np.cumsum(both[:n] | both[n:] << np.uint64(32), dtype=np.uint64)


CELLS = "part int, size bigint, keys binary, counts binary, alone binary"


def _train_cells(whole: bool, parts: int, listed_parts: int):
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    schema = pa.schema([(c.split()[0], t) for c, t in zip(CELLS.split(", "), kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for learns, *rest in documents_of(batches, 1):
            block, out = Block(*rest, whole, learns), Rows(schema)
            keys, counts = np.unique(block.near_keys, return_counts=True)
            order, edges = _in_parts(part_of(keys, parts), parts)
            keys, counts = keys[order], counts[order]
            for part, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
                if b > a:
                    out.add(part, b - a, _keys_packed(keys[a:b]), packed(counts[a:b]), None)
            keys, counts = np.unique(block.far_keys, return_counts=True)
            order, edges = _in_parts(far_part_of(keys, listed_parts), listed_parts)
            keys, counts = keys[order], counts[order]
            alone = block.count((keys & np.uint64(0xFFFFFFFF)).astype(np.int64))
            for part, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
                if b > a:
                    out.add(parts + part, b - a, _far_packed(keys[a:b]), packed(counts[a:b]), _wide(alone[a:b]))
            yield from out.drain()

    return run


PARTS = (
    "part int, size bigint, keys binary, counts binary, n array<bigint>, context array<int>, seen array<bigint>,"
    " lower array<double>, " + ", ".join(f"m{r} array<bigint>" for r in range(1, DEPTH + 1)) + ", listed_lower binary"
)


def _wide(counts: np.ndarray) -> bytes:
    """Counts of any size: their low and high 32 bits."""
    return packed(np.concatenate((counts & 0xFFFFFFFF, counts >> 32)))


def _narrow(raw: bytes, n: int) -> np.ndarray:
    both = unpacked(raw, 2 * n)
    return both[:n] | both[n:] << 32


def _merged_parts(vocabulary: Vocabulary, parts: int):
    names = [f.split()[0] for f in PARTS.split(", ")]
    alone, factors, tokens = vocabulary.alone, vocabulary.factors, max(vocabulary.tokens, 1)

    def row(part: int, keys: np.ndarray, counts: np.ndarray, second: np.ndarray) -> pa.RecordBatch:
        spectrum = np.bincount(counts[counts <= DEPTH + 1], minlength=DEPTH + 2)
        if part < parts:
            first, lower, listed_lower = (keys >> 16).astype(np.int64), alone[keys & 0xFFFF], None
        else:
            first, after = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            lower = np.where(after < CLASSES, alone[np.minimum(after, CLASSES - 1)], discounted(second, factors) / tokens)
            far = first >= CLASSES
            k = np.unique(first[far], return_inverse=True)[1]
            listed_lower = pa.compress(np.bincount(k, lower[far]).tobytes(), codec="zstd", asbytes=True)
            first, lower, low = first[~far], lower[~far], counts[~far]
        if part < parts:
            low = counts
        context, place = np.unique(first, return_inverse=True)
        k = len(context)
        values = [
            part, len(keys), _keys_packed(keys) if part < parts else _far_packed(keys), _wide(counts), spectrum,
            context.astype(np.int32), np.bincount(place, minlength=k), np.bincount(place, lower, k),
            *[np.bincount(place[low == r], minlength=k) for r in range(1, DEPTH + 1)], listed_lower,
        ]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                 pa.list_(pa.int64()), pa.list_(pa.float64()), *[pa.list_(pa.int64())] * DEPTH, pa.binary()]
        arrays = [pa.array([v.tolist() if isinstance(v, np.ndarray) else v], t) for v, t in zip(values, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size, current = 0, None

        def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            keys, counts, second = (np.concatenate(of) for of in zip(*held))
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return keys[starts], np.add.reduceat(counts, starts), second[order][starts] if len(second) else second

        for part, n, raw, counts, second in documents_of(batches, 16):
            if part != current and held:
                yield row(current, *joined())
                held, size = [], 0
            current = part
            if part < parts:
                held.append((_keys_unpacked(raw, n), unpacked(counts, n), np.empty(0, np.int64)))
            else:
                held.append((_far_unpacked(raw, n), unpacked(counts, n), _narrow(second, n)))
            size += n
            if size > 4_000_000:  # many blocks: what is held becomes one list of different bigrams
                held = [joined()]
                size = 0
        if held:
            yield row(current, *joined())

    return run


def _spectrum(table: DataFrame, column: str, size: int) -> list[int]:
    """How many rows have each small count: one row to the driver."""
    found = table.agg(*[F.count_if(F.col(column) == r) for r in range(1, size)]).first()
    return [0, *found]


def most_frequent(words: DataFrame, limit: int) -> list:
    """The words counted most, equal ones by their letters.

    Sorting for the first rows lets every task send that many to the driver.
    The number of words per power of two of the count, 64 rows, tells below
    which count none can be among them.
    """
    steps = words.groupBy(F.floor(F.log2("n")).alias("step")).agg(F.count("*").alias("words")).collect()
    least, found = 0, 0
    for step, n in sorted(map(tuple, steps), reverse=True):
        least, found = step, found + n
        if found >= limit:
            break
    return words.filter(F.col("n") >= 1 << least).orderBy(F.desc("n"), "word").limit(limit).collect()


def learn_words(texts: DataFrame, frequent: int | None) -> Vocabulary:
    """The words of ``text``, counted, and the list of those that are no classes."""
    limit = min(FREQUENT if frequent is None else frequent, FREQUENT)
    partial = texts.mapInArrow(_counted, "word string, n bigint")
    words = written(partial.groupBy("word").agg(F.sum("n").alias("n")), "words")
    n_docs = texts.count()
    known, n_words = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    tokens, distinct = n_words + n_docs, known + (n_docs > 0)
    top = most_frequent(words, limit)
    names, counts = [r["word"].encode() for r in top], np.zeros(CLASSES, np.int64)
    counts[2 : 2 + len(top)] = [r["n"] for r in top]
    counts[EDGE] = n_docs

    # the words after the last class in the order of most_frequent
    last = top[-1] if top else None
    after = (F.col("n") < last["n"]) | (F.col("n") == last["n"]) & (F.col("word") > last["word"]) if top else F.lit(True)
    parts = 8 + known // LIST_WORDS
    rest = words.filter(after).select((F.crc32("word") % parts).cast("int").alias("part"), "word", "n")
    rows = rest.repartition(parts, "part").sortWithinPartitions("part", "word")
    listed, sizes = written(rows.mapInArrow(_listed, LIST), "list"), np.zeros(parts, np.int64)
    for r in listed.select("part", "size").collect():
        sizes[r["part"]] = r["size"]
    if sizes.sum() > (1 << 32) - CLASSES:
        raise ValueError("more different words than numbers of 32 bits")
    first = CLASSES + np.cumsum(sizes) - sizes

    spectrum = np.array(_spectrum(words, "n", DEPTH + 2))
    if 0 < n_docs < len(spectrum):
        spectrum[n_docs] += 1  # the end is counted as often as there are texts
    factors = discounts(spectrum, tokens)
    unknown, alone, whole = unknown_share(factors, spectrum, tokens), np.zeros(CLASSES), frequent is None
    if tokens:
        if not whole:
            counts[RARE] = n_words - int(counts[2:].sum())
        alone[1:] = discounted(counts[1:], factors) / tokens
        alone[RARE] = unknown if whole else max(1 - alone.sum(), unknown)
    else:
        alone[RARE] = alone[EDGE] = 1.0  # nothing is known: every token is certain
    return Vocabulary(words, names, listed, first, whole, counts, alone, factors, unknown, tokens, distinct)


def learn_bigrams(encoded: DataFrame, vocabulary: Vocabulary) -> KatzModel:
    """The bigrams of the pieces that are to be learnt from."""
    v = vocabulary
    parts, listed_parts = min(MOST_PARTS, 8 + v.tokens // PART_TOKENS), 8 + v.tokens // PART_TOKENS
    blocks = encoded.select("learns", "sizes", "numbers", "listed", "counts")
    cells = blocks.mapInArrow(_train_cells(v.whole, parts, listed_parts), CELLS)
    cells = cells.repartition(parts + listed_parts * v.whole, "part").sortWithinPartitions("part")
    bigrams = written(cells.mapInArrow(_merged_parts(v, parts), PARTS), "bigrams", "part")
    sums = bigrams.agg(*[F.sum(F.col("n")[r]) for r in range(1, DEPTH + 2)]).first()
    bigram_factors = discounts(np.array([0, *[s or 0 for s in sums]]), v.tokens)

    columns = ["context", "seen", "lower", *[f"m{r}" for r in range(1, DEPTH + 1)]]
    one = bigrams.select(F.explode(F.arrays_zip(*columns)).alias("of")).select("of.*")
    seen, lower, low = np.zeros(CLASSES, np.int64), np.zeros(CLASSES), np.zeros((DEPTH + 1, CLASSES), np.int64)
    for r in one.groupBy("context").agg(*[F.sum(c).alias(c) for c in columns[1:]]).collect():
        seen[r["context"]], lower[r["context"]] = r["seen"], r["lower"]
        low[1:, r["context"]] = r[3:]
    norm, weight = backoff(v.counts, seen, lower, low, bigram_factors, v.outcomes)
    classes = ClassModel(v.counts, v.alone, norm, weight, v.factors, bigram_factors, v.unknown, v.tokens, v.distinct)
    return KatzModel(v, bigrams, parts, listed_parts, classes)


def fit(docs: DataFrame, text_col: str = "text", frequent: int | None = None, block: int = BLOCK_TOKENS) -> KatzModel:
    """Learn from every row of ``docs``; a null text counts as empty.

    Bigrams of all words are counted, unless a number of ``frequent`` words is
    given (equally frequent ones by their letters): then the other words are one class.
    The driver gets the words that are classes, sums per class and single
    rows of sums, at most 65,536 rows each, and the size of each part of the list.
    """
    texts, own = picked(docs, text=(text_col, "string")).select(F.coalesce("text", F.lit("")).alias("text")), Scratch()
    vocabulary = learn_words(texts, frequent)
    with own.collect():
        encoded = encode(texts.select(F.lit(None).cast("bigint"), "text", F.lit(True)), vocabulary, block)
    model = learn_bigrams(encoded, vocabulary)
    own.drop(docs.sparkSession)
    return model


def backoff(
    counts: np.ndarray, seen: np.ndarray, lower: np.ndarray, low: np.ndarray, factors: np.ndarray, outcomes: int
) -> tuple[np.ndarray, np.ndarray]:
    """What the discounted counts after each class are divided by, and the weight of backing off.

    ``seen`` classes follow it, with the probability ``lower`` alone; ``low[r]``
    of them ``r`` times.  If all counts are too great to be discounted, one
    more than the count divides them, so that something is left for the
    others; if no others are, the discounted counts are divided by their sum.
    """
    times = np.arange(len(low))[:, None] * low
    kept = (times * factors[: len(low), None]).sum(0) + factors[-1] * (counts - times.sum(0))
    everything = (seen >= outcomes) & (counts > 0)
    norm = np.where(everything, kept, np.where(kept >= counts, counts + 1, counts)).astype(float)
    norm = np.where(counts > 0, norm, 1.0)
    left = 1 - np.where(counts > 0, kept, 0) / norm
    weight = np.where(everything, 0.0, left / np.maximum(1 - lower, 1e-15))
    return norm, np.where(counts > 0, weight, 1.0)


# scoring ----------------------------------------------------------------------------------------

def _asking(whole: bool, parts: int, listed_parts: int):
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("size", pa.int64()), ("keys", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, *rest in documents_of(batches, 1):
            block, out = Block(*rest, whole), Rows(schema)
            near, far = np.unique(block.near_keys), np.unique(block.far_keys)
            for keys, of, n, base, pack in (
                (near, part_of, parts, 0, _keys_packed), (far, far_part_of, listed_parts, parts, _far_packed)
            ):
                order, edges = _in_parts(of(keys, n), n)
                keys = keys[order]
                for part, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
                    if b > a:
                        out.add(base + part, number, b - a, pack(keys[a:b]))
            yield from out.drain()

    return run


class _Part:
    """The bigrams of a part, and of its listed words what their counts are divided by and the weight of backing off."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, lower: bytes | None, factors: np.ndarray, outcomes: int):
        self.keys, self.counts = keys, counts
        self.contexts = self.norm = self.weight = np.empty(0)
        if lower is None:
            return
        first = keys >> np.uint64(32)
        far = first >= CLASSES
        self.contexts, place = np.unique(first[far], return_inverse=True)
        k, own = len(self.contexts), counts[far]
        low = np.array([np.bincount(place[own == r], minlength=k) for r in range(DEPTH + 1)])
        seen, total = np.bincount(place, minlength=k), np.zeros(k, np.int64)
        np.add.at(total, place, own)
        sums = np.frombuffer(pa.decompress(lower, 8 * k, codec="zstd", asbytes=True))
        self.norm, self.weight = backoff(total, seen, sums, low, factors, outcomes)

    def found(self, asked: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(asked), np.int64)
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.counts[at], 0)

    def backing_off(self, asked: np.ndarray) -> bytes:
        """Divisors and weights of the listed words that the bigrams begin with; all of these were counted."""
        at = np.searchsorted(self.contexts, contexts_of(asked))
        return pa.compress(np.concatenate((self.norm[at], self.weight[at])).tobytes(), codec="zstd", asbytes=True)


def contexts_of(keys: np.ndarray) -> np.ndarray:
    """The different listed words that ascending bigrams of 64 bits begin with."""
    first = keys >> np.uint64(32)
    return np.unique(first[first >= CLASSES])


def _answered(parts: int, factors: np.ndarray, outcomes: int):
    """Counts of each block's bigrams, from the rows of a part: its table first, then the blocks that ask."""
    schema = pa.schema([("of", pa.int64()), ("part", pa.int32()), ("answer", pa.binary()), ("weights", pa.binary())])
    none = _Part(np.empty(0, np.uint64), np.empty(0, np.int64), None, factors, outcomes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current, table = Rows(schema), None, none
        for part, block, n, raw, known, lower in documents_of(batches, 16):
            if part != current:
                current, table = part, none
            keys = _keys_unpacked(raw, n) if part < parts else _far_unpacked(raw, n)
            if block is None:
                table = _Part(keys, _narrow(known, n), lower, factors, outcomes)
                continue
            answer, weights = _wide(table.found(keys)), None if part < parts else table.backing_off(keys)
            out.add(block, part, answer, weights, size=len(answer) + len(weights or b""))
            if out.full():
                yield out.batch()
        yield from out.drain()

    return run


def _scored(model: ClassModel, whole: bool, parts: int, listed_parts: int):
    columns = ["uid", "doc_id", "n_tokens", "n_known", "base_score", "score"]

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = {c: blocks.column(c)[0].as_py() for c in blocks.column_names}
        block = Block(*(row[c] for c in ("sizes", "numbers", "listed", "counts")), whole)
        found = {p: (a, w) for p, a, w in zip(*(answers.column(c).to_pylist() for c in ("part", "answer", "weights")))}
        second, listed = block.second, block.second >= CLASSES
        times = np.where(listed, block.count(second), model.counts[np.minimum(second, CLASSES - 1)])
        times[second == RARE] = 0
        scores = np.empty(len(second))

        keys, place = np.unique(block.near_keys, return_inverse=True)
        order, edges = _in_parts(part_of(keys, parts), parts)
        counts = np.zeros(len(keys), np.int64)
        for part, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
            if b > a:
                counts[order[a:b]] = _narrow(found[part][0], b - a)
        scores[block.near] = model.scores(keys, counts)[place]
        if not whole:  # the class of other words is shared by their counts
            rare = listed | (second == RARE)
            scores[rare] += np.log10(model.listed_alone(times[rare]) / model.alone[RARE])

        keys, place = np.unique(block.far_keys, return_inverse=True)
        order, edges = _in_parts(far_part_of(keys, listed_parts), listed_parts)
        first, after = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        counts, near = np.zeros(len(keys), np.int64), np.minimum(first, CLASSES - 1)
        norm, weight = model.norm[near], model.weight[near]
        for part, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
            if b > a:
                own, (answer, weights) = order[a:b], found[parts + part]
                counts[own] = _narrow(answer, b - a)
                contexts = contexts_of(keys[own]).astype(np.int64)
                both = np.frombuffer(pa.decompress(weights, 16 * len(contexts), codec="zstd", asbytes=True)).reshape(2, -1)
                far = own[first[own] >= CLASSES]
                at = np.searchsorted(contexts, first[far])
                norm[far], weight[far] = both[0, at], both[1, at]
        alone = np.where(after < CLASSES, model.alone[np.minimum(after, CLASSES - 1)], model.listed_alone(block.count(after)))
        with np.errstate(divide="ignore"):
            logs = np.log10(np.where(counts > 0, discounted(counts, model.bigram_factors) / norm, weight * alone))
        scores[~block.near] = logs[place]

        sizes = np.array(row["sizes"], np.int64)
        starts = np.cumsum(sizes - 1) - (sizes - 1)
        return pa.table(dict(zip(columns, [
            pa.array(row["uids"], pa.int64()), pa.array(row["doc_ids"], pa.int64()), sizes - 1,
            np.add.reduceat((times > 0).astype(np.int64), starts), np.add.reduceat(model.base_logs(times), starts),
            np.add.reduceat(scores, starts),
        ])))

    return run


def scores(encoded: DataFrame, model: KatzModel) -> DataFrame:
    """What ``score`` returns, from blocks of numbers."""
    null, whole = F.lit(None), model.vocabulary.whole
    blocks = encoded.select("block", "sizes", "numbers", "listed", "counts")
    cells = blocks.mapInArrow(_asking(whole, model.parts, model.listed_parts), "part int, block bigint, size bigint, keys binary")
    asked = cells.select("*", null.cast("binary").alias("counts"), null.cast("binary").alias("listed_lower"))
    table = model.bigrams.select("part", null.cast("bigint").alias("block"), "size", "keys", "counts", "listed_lower")
    rows = table.union(asked).repartition(model.parts + model.listed_parts * whole, "part")
    rows = rows.sortWithinPartitions("part", F.col("block").asc_nulls_first())
    answered = _answered(model.parts, model.classes.bigram_factors, model.vocabulary.outcomes)
    answers = rows.mapInArrow(answered, "of bigint, part int, answer binary, weights binary")
    sums = "uid bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = _scored(model.classes, whole, model.parts, model.listed_parts)
    own = encoded.drop("learns").groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(scored, sums)
    names = ("n_tokens", "n_known", "base_score", "score")
    whole = own.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in names])
    return whole.select("doc_id", "n_tokens", "n_known", F.lit(model.classes.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def score(
    docs: DataFrame, model: KatzModel, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK_TOKENS
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities of the whole text with its end: by the
    model, and by single counts with a tenth added to each.  Null and empty
    texts are one token, the end.  Rows with the same id, or none, are scored
    each by itself; an empty table gives no rows; other columns are dropped,
    whatever their names.  A model that learnt from no text takes every token
    as certain (0).  A long text is cut into pieces of ``block`` tokens, each
    after the token before it, and their scores are added up.
    """
    both = picked(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    texts = both.select("doc_id", F.coalesce("text", F.lit("")), F.lit(False))
    return scores(encode(texts, model.vocabulary, block), model)


def fit_and_score(
    docs: DataFrame, learns_col: str, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK_TOKENS
) -> DataFrame:
    """``score`` of all rows by a ``fit`` to those whose ``learns_col`` is true; the texts are numbered once for both."""
    texts = picked(docs, doc_id=(id_col, "long"), text=(text_col, "string"), learns=(learns_col, "boolean"))
    texts = texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("learns", F.lit(False)).alias("learns"))
    vocabulary = learn_words(texts.filter("learns").select("text"), None)
    encoded = encode(texts, vocabulary, block)
    return scores(encoded, learn_bigrams(encoded, vocabulary))
