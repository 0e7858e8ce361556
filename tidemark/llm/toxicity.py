"""Toxic severity by cumulative-link ordinal regression.

A document's words are hashed to sparse features.  One weight vector is
shared by all thresholds: P(grade > j) = s(w x - t_j), with t_1 < t_2 < ...
The expected severity is the sum of these over j.

The labels say toxic or not; severities are made of them.  Grade 0 is not
toxic.  Toxic rows are graded by the density of telling words (those far
more frequent in toxic than in other rows): grade 1 up to the median, grade
2 above it.  A table whose labels have grades already is used as it is.

The model is fitted on at most ``sample`` labelled rows, those with the
smallest hash of their id; every document is scored over its whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.chunks import Memo
from tidemark.llm.common import Rows, documents_of, id_and_text, picked

SAMPLE = 12_000  # labelled rows the model is fitted on
BITS = 18  # of a feature's number
ROUNDS = 300
RARE = 600  # a feature counts if one of so many rows has it, and two rows at least
TELLING = 6.0  # times more frequent in toxic rows
LIMIT = 0.35  # probability of any toxicity from which a document counts as toxic; set on labelled rows held out
_WORD = re.compile(r"[^\W\d_]+")


class Hasher:
    def __init__(self, bits: int = BITS):
        self.mask, self.known = (1 << bits) - 1, Memo()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the features and their counts."""
        known, found = self.known.get, []
        for word in _WORD.findall((text or "").lower()):
            number = known(word)
            if number is None:
                number = xxhash.xxh32_intdigest(word.encode("utf-8")) & self.mask
                self.known.put(word, number)
            found.append(number)
        numbers, counts = np.unique(np.array(found, np.int64), return_counts=True)
        return numbers, counts


def values(counts: np.ndarray) -> np.ndarray:
    """Damped counts of unit length, so that long texts weigh no more than short ones."""
    damped = 1 + np.log(counts)
    return damped / np.sqrt((damped * damped).sum()) if len(damped) else damped


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """P(grade > j) for each threshold j."""
        score = float(self.weights[numbers] @ values(counts))
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -60, 60)))


def thresholds_of(params: np.ndarray, n: int) -> np.ndarray:
    """The first threshold, and the others at distances that are exponentials."""
    return params[n] + np.concatenate(([0.0], np.cumsum(np.exp(params[n + 1 :]))))


def objective(
    params: np.ndarray, owner: np.ndarray, place: np.ndarray, x: np.ndarray, grades: np.ndarray, n: int, penalty: float
) -> tuple[float, np.ndarray]:
    """Mean log-likelihood of the grades less the penalty on the weights, and its gradient.

    The first ``n`` parameters are weights, the others make the thresholds;
    row ``owner[i]`` has the value ``x[i]`` of the feature ``place[i]``.
    """
    rows, levels = len(grades), len(params) - n
    everyone = np.arange(rows)
    score = np.bincount(owner, params[place] * x, rows)
    above = 1 / (1 + np.exp(np.clip(thresholds_of(params, n)[None, :] - score[:, None], -60, 60)))
    edges = np.hstack([np.ones((rows, 1)), above, np.zeros((rows, 1))])
    slopes = edges * (1 - edges)
    own = np.maximum(edges[everyone, grades] - edges[everyone, grades + 1], 1e-9)
    by_score = (slopes[everyone, grades] - slopes[everyone, grades + 1]) / own
    by_cut = np.zeros(levels + 2)
    np.add.at(by_cut, grades, -slopes[everyone, grades] / own)
    np.add.at(by_cut, grades + 1, slopes[everyone, grades + 1] / own)
    by_cut = by_cut[1:-1]
    tails = np.cumsum(by_cut[::-1])[::-1]
    gradient = np.concatenate([
        np.bincount(place, x * by_score[owner], n) / rows - penalty * params[:n],
        tails[:1] / rows, tails[1:] * np.exp(params[n + 1 :]) / rows,
    ])
    return float(np.log(own).mean() - penalty / 2 * (params[:n] ** 2).sum()), gradient


def fit_ordinal(
    rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, bits: int = BITS, rounds: int = ROUNDS,
    penalty: float = 1e-6,
) -> Ordinal:
    """Maximum likelihood by Adam; thresholds stay in order because their distances are exponentials.

    Rare features keep weight zero: they would only tell the rows apart.
    Without rows, or with one grade only, everything gets the lowest grade seen.
    """
    levels = int(grades.max()) if len(grades) else 0
    if levels == 0 or grades.min() == levels:
        low = -60.0 if levels else 60.0
        return Ordinal(np.zeros(1 << bits, np.float32), np.full(max(levels, 1), low))
    owner = np.repeat(np.arange(len(rows)), [len(n) for n, _ in rows])
    numbers, x = np.concatenate([n for n, _ in rows]), np.concatenate([values(c) for _, c in rows])
    common = np.bincount(numbers, minlength=1 << bits) >= max(2, len(rows) / RARE)
    kept = common[numbers]
    owner, x = owner[kept], x[kept]
    used, place = np.unique(numbers[kept], return_inverse=True)
    rates = np.clip([(grades > j).mean() for j in range(levels)], 1e-4, 1 - 1e-4)
    start = -np.log(rates / (1 - rates))
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    params = np.concatenate([np.zeros(len(used)), start[:1], gaps])
    first, second, n = np.zeros_like(params), np.zeros_like(params), len(used)
    for step in range(1, rounds + 1):
        _, up = objective(params, owner, place, x, grades, n, penalty)
        first, second = 0.9 * first + 0.1 * up, 0.999 * second + 0.001 * up * up
        params = params + 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << bits, np.float32)
    weights[used] = params[:n]
    return Ordinal(weights, thresholds_of(params, n))


def severity_grades(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Grades 0, 1 and 2 from labels 0 and 1; labels above 1 are grades already."""
    if not len(toxic) or toxic.max() != 1:
        return toxic
    size = 1 << bits
    bad, good = np.zeros(size), np.zeros(size)
    for (numbers, _), mark in zip(rows, toxic):
        (bad if mark else good)[numbers] += 1
    telling = (bad >= 3) & ((bad + 0.5) / (toxic.sum() + 1) > TELLING * (good + 0.5) / ((toxic == 0).sum() + 1))
    density = np.array([c[telling[n]].sum() / max(1, c.sum()) for n, c in rows])
    return np.where(toxic == 1, 1 + (density > np.median(density[toxic == 1])), 0)


def _features(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        out = Rows(pa.schema([("doc_id", pa.int64()), ("numbers", pa.binary()), ("counts", pa.binary()), ("toxic", pa.int64())]))
        for doc_id, text, toxic in documents_of(batches):
            numbers, counts = hasher(text)
            out.add(doc_id, numbers.astype("<i4").tobytes(), counts.astype("<i4").tobytes(), toxic, size=8 * len(numbers))
            if out.full():
                yield out.batch()
        yield from out.drain()

    return run


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE, bits: int = BITS,
) -> Ordinal:
    """The model from the labelled rows of ``docs``; rows without an id or label are not labelled.

    An id labelled twice counts once, with its highest label.
    """
    marks = picked(labels, of=(id_col, "long"), toxic=(label_col, "long")).dropna().filter("toxic >= 0")
    chosen = marks.groupBy("of").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("of"), "of").limit(sample)
    found = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))
    unique = found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    rows = unique.mapInArrow(_features(bits), "doc_id bigint, numbers binary, counts binary, toxic bigint").collect()
    rows.sort(key=lambda row: row["doc_id"])
    parts = [(np.frombuffer(r["numbers"], "<i4"), np.frombuffer(r["counts"], "<i4")) for r in rows]
    toxic = np.array([r["toxic"] for r in rows], np.int64)
    return fit_ordinal(parts, severity_grades(parts, toxic, bits), bits)


def _scores(model: Ordinal, bits: int, limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        out = Rows(pa.schema([
            ("doc_id", pa.int64()), ("expected_severity", pa.float64()), ("grade", pa.int32()), ("p_toxic", pa.float64()),
            ("toxic", pa.bool_()),
        ]))
        for doc_id, text in documents_of(batches):
            above = model.above(*hasher(text))
            grade = int((above >= limit).sum())
            out.add(doc_id, float(above.sum()), grade, float(above[0]), grade > 0)
            if out.full():
                yield out.batch()
        yield from out.drain()

    return run


def score(
    docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT
) -> DataFrame:
    """Per document: ``doc_id, expected_severity, grade, p_toxic, toxic``.

    ``grade`` counts the thresholds that are passed with a probability of
    ``limit`` or more, so a document has one above 0 if and only if it is
    ``toxic``.  A null or empty text has no features and gets the base rate.
    Repeated rows, also with the same id, are scored each by itself; an empty
    table gives no rows; other columns are dropped, whatever their names.  A
    text is scored whole in one task, with some 100 bytes a word.
    """
    bits = len(model.weights).bit_length() - 1
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _scores(model, bits, limit), "doc_id bigint, expected_severity double, grade int, p_toxic double, toxic boolean"
    )
