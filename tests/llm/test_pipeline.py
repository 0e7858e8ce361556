"""The pipeline's stages, one after the other, against plain versions of what each decides."""

import glob
from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import exact, hosts, simhash
from tidemark.session import shared_dir


def plain_quality(rows):
    """Ids that stay: each document's measures, the hosts' shrunk odds, and how far strict rules are exceeded."""
    judged = []
    for row in rows:
        n, chars, symbols, lines, repeated = hosts.measures(row["text"])
        base = n < 10 or 100 * repeated > 20 * n
        strict = base or 10 * symbols > n or 10 * lines > n or not 2 * n <= chars <= 15 * n
        over = max(10 * symbols / max(n, 1), 10 * lines / max(n, 1), 2 * n / max(chars, 1), chars / (15 * max(n, 1)))
        judged.append((row["doc_id"], row["source"] or "", base, strict, over))
    found = {}
    for _, host, _, strict, _ in judged:
        docs, failed = found.get(host, (0, 0))
        found[host] = docs + 1, failed + strict
    n, f = len(judged), sum(failed for _, failed in found.values())
    mean = (f + 0.01) / (n + 1)
    spread = sum(failed * failed / docs for docs, failed in found.values()) / n - (f / n) ** 2
    between = spread - mean * (1 - mean) * len(found) / n
    strength = 10 if between <= 0 else min(1000, max(2, mean * (1 - mean) / between - 1))
    odds = {}
    for host, (docs, failed) in found.items():
        rate = (failed + mean * strength) / (docs + strength)
        odds[host] = rate / (1 - rate) / (mean / (1 - mean))
    return [i for i, host, base, strict, over in judged if not base and not (strict and over * odds[host] >= 1)]


def plain_near(rows, distance=4):
    """The smallest id of each group that links of near fingerprints connect."""
    prints = sorted((row["doc_id"], simhash.fingerprint(row["text"])) for row in rows)
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(prints):
        for j, b in prints[n + 1 :]:
            if (a ^ b).bit_count() <= distance:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [i for i, _ in prints if find(i) == i]


def plain_left(rows, span=200):
    """Texts without the bytes of strings of ``span`` bytes that start at two places; characters cut in two stay."""
    raws = {row["doc_id"]: row["text"].encode() for row in rows}
    seen = Counter(raw[i : i + span] for raw in raws.values() for i in range(len(raw) - span + 1))
    left = {}
    for doc, raw in raws.items():
        gone = bytearray(len(raw))
        for i in range(len(raw) - span + 1):
            if seen[raw[i : i + span]] > 1:
                gone[i : i + span] = b"\x01" * span
        text, at = "", 0
        for c in raw.decode():
            size = len(c.encode())
            text += "" if all(gone[at : at + size]) else c
            at += size
        left[doc] = text
    return left


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "exact dedup", "near dedup", "suffix dedup", "best-fit packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, sf).cache()
        rows = docs.collect()
        assert docs.columns == columns and 0 < len(rows) <= len(before)
        ids = sorted(r["doc_id"] for r in rows)
        if name == "quality rules":
            assert ids == sorted(plain_quality(before))
        elif name == "exact dedup":
            least = {}
            for row in before:
                key = exact.normalised(row["text"])
                least[key] = min(least.get(key, row["doc_id"]), row["doc_id"])
            assert ids == sorted(least.values())
        elif name == "near dedup":
            assert ids == plain_near(before)
        else:
            assert {r["doc_id"]: r["text"] for r in rows} == plain_left(before)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert sorted(r[0] for r in pieces.select("doc_id").distinct().collect()) == ids


def test_run_leaves_only_what_its_result_reads(spark, sf):
    place = shared_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{place}/*"))
    result = corpus_pipeline.run(spark, sf)
    left = {path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for path in set(glob.glob(f"{place}/*")) - before}
    assert left == {"pieces", "counts"}
    assert result.select("doc_id").distinct().count() > 100
    corpus_pipeline.LAST.drop(spark)
    assert set(glob.glob(f"{place}/*")) <= before


def test_stages_on_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, uid int, c0 string"
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long, "en", None, 1, "x"), (1, long, "en", None, 2, "y"), (None, None, None, "s", 3, None), (3, "", "en", "s", 4, "z"),
            (4, " ".join(f"other{i}" for i in range(60)), "en", "s", 5, "z")]
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.dtypes == frame.dtypes
            docs = spark.createDataFrame(out.collect(), schema)
        assert sorted(r["doc_id"] for r in docs.collect()) == ([1, 4] if frame.count() else [])
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


@pytest.mark.parametrize("own", [None, "1m"])
def test_stages_pass_texts_in_small_batches(spark, tmp_path, own):
    key, rows = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
    spark.range(0, 6000, 1, 1).selectExpr("id AS doc_id", "repeat('word', 1000) AS text", "'en' AS lang", "'s' AS source").write.parquet(
        f"{tmp_path}/documents"
    )
    docs = spark.read.parquet(f"{tmp_path}/documents")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    for name in corpus_pipeline.BATCHES:
        spark.conf.unset(name)
    try:
        if own:
            spark.conf.set(key, own)
        for _, stage in corpus_pipeline.STAGES[:2]:
            stage(spark, docs.limit(1), "")
            seen = [row["n"] for row in docs.mapInArrow(sizes, "n bigint").collect()]
            assert sum(seen) > 24_000_000 and max(seen) < (1.2e6 if own else 5e6)  # 24 MB in one batch by Spark's own limits
            assert spark.conf.get(rows) == "512" and spark.conf.get(key) == (own or str(4 << 20))
    finally:
        for name in corpus_pipeline.BATCHES:
            spark.conf.unset(name)
        corpus_pipeline.LAST.drop(spark)
