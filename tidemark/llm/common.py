"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """The same columns, named by position."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def picked(df: DataFrame, **wanted: tuple[str, str]) -> DataFrame:
    """Chosen columns under new names: ``picked(df, key=("doc_id", "long"))``.

    Every other column is dropped, whatever it is called.
    """
    places = {new: df.columns.index(old) for new, (old, _) in wanted.items()}
    return numbered(df).select(*[F.col(f"c{places[new]}").cast(kind).alias(new) for new, (_, kind) in wanted.items()])


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` of every row; null text counts as empty."""
    both = picked(df, doc_id=(id_col, "long"), text=(text_col, "string"))
    return both.withColumn("text", F.coalesce("text", F.lit("")))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


class Rows:
    """Collects output rows and hands them on as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit: int = 8 << 20, rows: int = 20_000):
        self.schema, self.limit, self.most = schema, limit, rows
        self.columns: list[list] = [[] for _ in schema]
        self.size = 0

    def add(self, *values, size: int = 0) -> None:
        for store, value in zip(self.columns, values):
            store.append(value)
        self.size += size

    def full(self) -> bool:
        return self.size >= self.limit or len(self.columns[0]) >= self.most

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema)]
        self.columns, self.size = [[] for _ in self.schema], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)

    def drain(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            yield self.batch()


#: What a worker process remembers from task to task, by a key of the operator that does; of one at a time.
REMEMBERED: dict = {}


def remembered(key, make):
    """What is remembered under the key, made first if there is nothing; what others remember goes."""
    forget(key)
    if key not in REMEMBERED:
        REMEMBERED[key] = make()
    return REMEMBERED[key]


def forget(but=None) -> None:
    """Workers run the tasks of one operator after those of another, which need not keep its memory meanwhile."""
    others = [key for key in REMEMBERED if key != but]
    for key in others:
        del REMEMBERED[key]
    if others:
        pa.default_memory_pool().release_unused()


def documents_of(batches: Iterator[pa.RecordBatch], step: int = 256, keeps=None) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, a few at a time, so that long texts are not all copied at once.

    Only what is remembered under the key ``keeps`` stays in the worker's memory.
    """
    forget(keeps)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield from zip(*[c.to_pylist() for c in part.columns])


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below ``2 ** 32`` as compressed bytes, low bytes first of all."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
