"""Exact duplicates by Grace hash deduplication.

Two passes of the same algorithm.  Within each input partition, records are
put into an open-addressing table that compares the complete content; once
the table holds its share of memory, records it does not know go to spill
files by bits of their hash, and each file is processed in the same way with
the next bits.  That leaves one group row per text and partition, so a text
with a third of all rows sends one row per task through the shuffle.  The
group rows then meet by content hash and go through the same tables.

Texts are equal when they are identical after every run of white space
became one space; null counts as empty.  Of equal texts the row with the
smallest id stays (a null id comes last; of rows with the same id, one).
"""

from __future__ import annotations

import hashlib
import os
import pickle
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import Rows, documents_of, numbered
from tidemark.operators.joins import equal_keys
from tidemark.session import written

TABLE_BYTES = 48 << 20  # content a table may hold before records are spilled
FAN_BITS = 4  # 16 spill files a level
_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def normalised(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8").translate(_BLANKS)
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    return raw


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.size = 0

    def find(self, hashed: int, content: bytes) -> int:
        """Number of the entry, -1 if there is none."""
        mask = len(self.slots) - 1
        at = hashed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        return -1

    def _place(self, entry: int) -> None:
        mask = len(self.slots) - 1
        at = self.hashes[entry] & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        self.slots[at] = entry

    def add(self, hashed: int, content: bytes) -> int:
        self.hashes.append(hashed)
        self.contents.append(content)
        self.size += len(content) + 100
        if 2 * len(self.contents) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for entry in range(len(self.contents)):
                self._place(entry)
        else:
            self._place(len(self.contents) - 1)
        return len(self.contents) - 1


def grace(
    records: Iterable[tuple[int, bytes, tuple]],
    on_record: Callable[[list, tuple], None],
    new_group: Callable[[tuple], list],
    folder: str,
    limit: int = TABLE_BYTES,
    level: int = 0,
) -> Iterator[tuple[bytes, list] | None]:
    """Group records of (hash, content, payload) by content.

    ``new_group`` makes the state of a new group and ``on_record`` adds a
    record to it.  Yields None after each record, so that a caller can hand
    on what it has, and (content, state) once a group is complete.
    """
    seen, states, files = ContentTable(), [], {}
    for hashed, content, payload in records:
        entry = seen.find(hashed, content)
        if entry < 0 and seen.size >= limit:
            # spilled texts never enter this table later: it takes no more entries
            spread = (hashed >> (64 - FAN_BITS * (level % 15 + 1))) & ((1 << FAN_BITS) - 1)
            if spread not in files:
                files[spread] = open(os.path.join(folder, f"{level}-{len(files)}-{os.urandom(6).hex()}"), "w+b")
            pickle.dump((hashed, content, payload), files[spread], protocol=5)
        else:
            if entry < 0:
                entry = seen.add(hashed, content)
                states.append(new_group(payload))
            on_record(states[entry], payload)
        yield None
    for content, state in zip(seen.contents, states):
        yield content, state
    del seen, states
    for file in files.values():
        file.seek(0)
        yield from grace(_spilled(file), on_record, new_group, folder, limit, level + 1)
        file.close()
        os.unlink(file.name)


def _spilled(file) -> Iterator[tuple[int, bytes, tuple]]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _order(doc_id, uid: int) -> tuple:
    return doc_id is None, doc_id or 0, uid


def _local(limit: int, text_at: str, row_type: pa.DataType) -> Callable:
    """Pass one: rows -> one member row per record and one group row per text of the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("kind", pa.int8()), ("gid", pa.int64()), ("uid", pa.int64()), ("id", pa.int64()), ("n", pa.int64()),
             ("sha", pa.string()), ("row", row_type)]
        )
        out, base, groups = Rows(schema), TaskContext.get().partitionId() << 33, 0
        folder = tempfile.mkdtemp(prefix="grace-")

        def records():
            for n, (doc_id, row) in enumerate(documents_of(batches)):
                content = normalised(row[text_at])
                yield xxhash.xxh64_intdigest(content), content, (base + n, doc_id, row)

        def new_group(payload):
            nonlocal groups
            groups += 1
            return [base + groups, 0, None, None]  # number, records, order of the first, its row

        def on_record(state, payload):
            uid, doc_id, row = payload
            state[1] += 1
            if state[2] is None or _order(doc_id, uid) < state[2]:
                state[2], state[3] = _order(doc_id, uid), row
            out.add(0, state[0], uid, doc_id, None, None, None)

        try:
            for done in grace(records(), on_record, new_group, folder, limit):
                if done:
                    content, (gid, n, (no_id, doc_id, uid), row) = done
                    sha = hashlib.sha256(content).hexdigest()
                    out.add(1, gid, uid, None if no_id else doc_id, n, sha, row, size=len(content))
                if out.full():
                    yield out.batch()
            yield from out.drain()
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    return run


def _global(limit: int, text_at: str, row_type: pa.DataType, rows: bool) -> Callable:
    """Pass two: group rows -> the row that stays (``rows``), or a verdict for each group row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("row", row_type)] if rows else
            [("gid", pa.int64()), ("keep_uid", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()),
             ("text_sha256", pa.string())]
        )
        out, folder = Rows(schema), tempfile.mkdtemp(prefix="grace-")

        def records():
            for gid, uid, doc_id, n, sha, row in documents_of(batches):
                content = normalised(row[text_at])
                yield xxhash.xxh64_intdigest(content), content, (gid, uid, doc_id, n, sha, row)

        def new_group(payload):
            return [[], 0, None, payload[5], payload[4]]  # group rows, records, order of the first, its row, hash

        def on_record(state, payload):
            gid, uid, doc_id, n, _, row = payload
            state[0].append(gid)
            state[1] += n
            if state[2] is None or _order(doc_id, uid) < state[2]:
                state[2], state[3] = _order(doc_id, uid), row if rows else None

        try:
            for done in grace(records(), on_record, new_group, folder, limit):
                if done:
                    content, (gids, n, (no_id, doc_id, uid), row, sha) = done
                    if rows:
                        out.add(row, size=len(content))
                    else:
                        for gid in gids:
                            out.add(gid, uid, None if no_id else doc_id, n, sha)
                if out.full():
                    yield out.batch()
            yield from out.drain()
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    return run


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    return to_arrow_schema(df.select(name).schema).field(0).type


def _groups(docs: DataFrame, id_col: str, text_col: str, limit: int) -> tuple[DataFrame, str]:
    """Member and group rows of pass one, written to the shared folder; the place of the text in a row."""
    flat, places = numbered(docs), {c: f"c{docs.columns.index(c)}" for c in (id_col, text_col)}
    source = flat.select(
        F.col(places[id_col]).cast("long").alias("id"), F.struct(*flat.columns).alias("row")
    )
    row = source.schema["row"].dataType.simpleString()
    kinds = f"kind tinyint, gid bigint, uid bigint, id bigint, n bigint, sha string, row {row}"
    local = _local(limit, places[text_col], _arrow_type(source, "row"))
    return written(source.mapInArrow(local, kinds), "exact"), places[text_col]


def _by_content(groups: DataFrame) -> DataFrame:
    return groups.filter("kind = 1").select("gid", "uid", "id", "n", "sha", "row").repartition("sha")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TABLE_BYTES
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Empty and null texts form one group.  A null id comes last; of rows with
    the same id and text one is kept, and each has a row.  An empty table gives
    no rows; other columns are dropped, whatever their names.  Texts are
    compared whole, one at a time.
    """
    narrow = numbered(docs).select(
        *[F.col(f"c{docs.columns.index(c)}").alias(n) for c, n in ((id_col, "doc_id"), (text_col, "text"))]
    )
    groups, text_at = _groups(narrow, "doc_id", "text", limit)
    verdicts = _by_content(groups).mapInArrow(
        _global(limit, text_at, _arrow_type(groups, "row"), False),
        "gid bigint, keep_uid bigint, keep_id bigint, group_size bigint, text_sha256 string",
    )
    members = groups.filter("kind = 0").select(F.col("gid").alias("of"), "uid", F.col("id").alias("doc_id"))
    joined = members.join(verdicts, equal_keys(members, verdicts, {"of": "gid"}))
    return joined.select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256"
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TABLE_BYTES
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever the names; as in ``exact_groups``.

    A text stays as it was, null included.  An empty table gives an empty one.
    """
    groups, text_at = _groups(docs, id_col, text_col, limit)
    row = groups.schema["row"].dataType.simpleString()
    kept = _by_content(groups).mapInArrow(_global(limit, text_at, _arrow_type(groups, "row"), True), f"row {row}")
    return kept.select("row.*").toDF(*docs.columns)
