"""Every operator on tables with clashing columns, repeated ids, odd and long texts, and no rows."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, bpe, exact, hosts, katz, licenses, packing, periods, simhash, sites, suffixes, toxicity

#: Names that the operators use for columns of their own.
CLASHING = "uid of row key c0 c1 fp least gid kind sha z spans block part word n number length task common a.b host path"

LONG = " ".join(f"w{i % 5000}" for i in range(20_000))
TEXTS = [None, "", " \t", "one word", "one word", "a b c d e f g h", "a b c d e f g h", "été 漢字 x " * 30, LONG, LONG + " end",
         "all rights reserved cc by", "### !!! $$$ " * 20, "word\nword\nword\n", " ".join(f"word{i}" for i in range(40))]


def rows():
    return [(n // 2 if n != 7 else None, text) for n, text in enumerate(TEXTS)]


def plain(spark):
    return spark.createDataFrame(rows(), "doc_id bigint, text string")


def clashing(spark):
    names = CLASHING.split()
    frame = plain(spark)
    extra = [F.lit(f"x{n}").alias(name) for n, name in enumerate(names)]
    return frame.select(*extra[:12], "doc_id", *extra[12:], "text")


def labels(spark):
    return spark.createDataFrame([(n, n % 2, n % 2) for n in range(6)], "doc_id bigint, quality int, toxic int")


def tokenizer(name):
    return public_tokenizers.path(name)


OPERATORS = {
    "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels(d.sparkSession))),
    "packing": lambda d: packing.pack(d, tokenizer("byte_bpe_50k.json")).select("doc_id", "piece", "start", "length", "ids_crc32"),
    "simhash": simhash.simhash_components,
    "exact": exact.exact_groups,
    "hosts": lambda d: hosts.host_rules(d.withColumn("source", F.lit(None).cast("string")), ["doc_id"]).drop("row"),
    "licenses": licenses.license_scan,
    "suffixes": suffixes.repeat_digests,
    "bpe": lambda d: bpe.bpe_round_trip(d, tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True),
    "periods": lambda d: periods.periodic_runs(d, digests=True),
    "katz": lambda d: katz.score(d, katz.fit(d)).select("doc_id", "n_tokens", "n_known", F.round("score", 6)),
    "alignment": lambda d: alignment.align_tokenizers(d, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), digests=True),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns_change_nothing(spark, name):
    def found(frame):
        return sorted((tuple(r) for r in OPERATORS[name](frame).collect()), key=repr)

    want = found(plain(spark))
    assert len(want) >= len(TEXTS) and found(clashing(spark)) == want
    assert OPERATORS[name](clashing(spark).limit(0)).collect() == []


@pytest.mark.parametrize("keep", [exact.exact_dedup, simhash.near_dedup, suffixes.remove_repeats, hosts.quality_filter])
def test_filters_keep_all_columns(spark, keep):
    frame = clashing(spark).withColumn("source", F.lit("s"))
    got = keep(frame)
    assert got.dtypes == frame.dtypes
    kept = got.collect()
    assert 0 < len(kept) <= len(TEXTS)
    for row in kept:
        assert [row[c] for c in CLASHING.split()] == [f"x{n}" for n in range(len(CLASHING.split()))]
    assert keep(frame.limit(0)).collect() == []


def test_site_quality_on_odd_tables(spark):
    frame = clashing(spark).withColumns({"source": F.lit(None).cast("string"), "lang": F.lit("l")})
    assert sites.site_quality(frame, labels(spark)).count() == len(TEXTS)
    assert sites.site_quality(frame.limit(0), labels(spark)).collect() == []
