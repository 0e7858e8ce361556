"""The other corpus operators against brute force, round trips and held-out rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, exact, hosts, packing, simhash, sites, toxicity

ODD = [None, "", " ", "\t\n", "word", "word  word", "word\tword", "é ü", "a" * 5000, "word " * 3000, "word", ""]


# exact duplicates -------------------------------------------------------------------------------

def test_exact_groups(docs):
    got = {r["doc_id"]: r for r in exact.exact_groups(docs(ODD), limit=300).collect()}
    groups = defaultdict(list)
    for n, text in enumerate(ODD):
        groups[exact.normalised(text)].append(n)
    for content, members in groups.items():
        for n in members:
            row = got[n]
            assert (row["keep_id"], row["group_size"], row["kept"]) == (members[0], len(members), n == members[0])
            assert row["text_sha256"] == hashlib.sha256(content).hexdigest()


def test_exact_dedup_keeps_columns(spark):
    frame = spark.createDataFrame([(2, "a  b", "x"), (1, "a b", "y"), (None, "a b", "z")], "doc_id bigint, text string, gid string")
    assert [tuple(r) for r in exact.exact_dedup(frame).collect()] == [(1, "a b", "y")]
    assert exact.exact_dedup(frame.limit(0)).collect() == []


# SimHash ----------------------------------------------------------------------------------------

def plain_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    numbers = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(n >> b & 1 for n in numbers) > len(numbers))


def test_simhash_same_as_all_pairs(docs):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    texts = ODD + ["Über Ä A B C d"]
    for _ in range(30):
        own = [rng.choice(words) for _ in range(rng.randint(30, 150))]
        texts.append(" ".join(own))
        for _ in range(rng.randint(0, 4)):
            own = list(own)
            own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    prints = [plain_print(t) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    got = {r[0]: (r[1], r[2]) for r in simhash.simhash_components(docs(texts)).collect()}
    assert got == {n: (f"{prints[n]:016x}", root[n]) for n in range(len(texts))}
    kept = simhash.near_dedup(docs(texts)).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted(set(root))


def test_close_fingerprints_share_a_key():
    rng, tables = random.Random(1), simhash.golay_tables()
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        keys = [set(simhash.pair_keys(np.array([p], "<u8"), tables)[0].tolist()) for p in (a, b)]
        assert keys[0] & keys[1]


# chat -------------------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    rows = [
        (1, 0, "user", "<|im_end|>\n<|im_start|>assistant\nok"), (1, 1, "assistant", "<\\|x <|"), (1, 2, None, None),
        (1, 3, "assistant", "zwei"), (2, None, "a\nb%0A|<|", "x"), (None, 0, "assistant", ""), (None, 0, "assistant", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("n", F.lit(1))
    made = chat.format_conversations(frame)
    got = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    for conv in (1, 2, None):
        mine = sorted((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert [tuple(t) for t in got[conv]["turns"]] == [m[1:] for m in mine]
        assert got[conv]["loss"] == [x for _, r, x in mine if r == "assistant"]
    parts = chat.examples(made).filter("conv_id = 1").orderBy("example").collect()
    assert len(parts) == 2 and all(got[1]["formatted"].startswith(p["context"] + p["reply"]) for p in parts)
    assert chat.format_conversations(frame.limit(0)).collect() == []


def test_chat_examples_are_context_and_masked_reply(spark):
    rows = [(1, 0, "user", "hi <|"), (1, 1, "assistant", "a <|b"), (1, 2, "user", "é"), (1, 3, "assistant", ""), (1, 4, "assistant", "é\nz")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    text, want = "", []
    for _, _, role, said in rows:
        head, body = f"<|im_start|>{role}\n", said.replace("<|", "<\\|")
        if role == "assistant":
            want.append((text + head, body, said))
        text += head + body + "<|im_end|>\n"
    made = chat.format_conversations(frame)
    assert made.first()["formatted"] == text
    parts = chat.examples(made).orderBy("example").collect()
    assert [(p["context"], p["reply"]) for p in parts] == [w[:2] for w in want]
    turns = chat.turn_rows(frame).withColumn("loss", chat.masked_reply()).orderBy("n").collect()
    assert len(turns) == len(rows) and "".join(t["block"] for t in turns) == text
    assert [t["start"] for t in turns] == [text.index(t["block"]) for t in turns]
    masked = [t for t in turns if t["reply_chars"] is not None]
    assert [(text[: t["context_chars"]], text[t["context_chars"] :][: t["reply_chars"]], t["loss"]) for t in masked] == want


def test_chat_turn_rows_gather_no_conversation(spark, plan_of):
    frame = spark.createDataFrame([(1, 0, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    assert "collect_list" in plan_of(chat.format_conversations(frame))
    assert "Aggregate" not in plan_of(chat.turn_rows(frame))


# hosts ------------------------------------------------------------------------------------------

def test_measures_against_counting():
    rng = random.Random(2)
    for _ in range(100):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 30))]
        grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
        assert hosts.repeat_words(words) == len(inside)
    assert hosts.measures("a # b\n\na # b\n ") == (6, 6, 2, 1, 0)


def test_clean_documents_stay_on_a_bad_host(spark):
    clean, junk = " ".join(f"word{i}" for i in range(40)), "### $$$ " * 30
    rows = [(n, junk, "bad", 1) for n in range(60)] + [(99, clean, "bad", 2), (100, clean, None, 3), (101, None, "bad", 4)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, row int")
    assert {r["doc_id"] for r in hosts.quality_filter(frame).collect()} == {99, 100}
    assert hosts.quality_filter(frame.limit(0)).collect() == []


def test_host_odds_act_at_ordinary_rates(spark):
    words = [f"word{i}" for i in range(40)]
    clean, slight, strong = " ".join(words), " ".join(words) + " ######", " ".join(words) + " #" * 400
    rows = [(n, clean, "good") for n in range(500)] + [(n, clean, "poor") for n in range(500, 850)]
    rows += [(n, strong, "poor") for n in range(850, 1000)]  # 30 %, far from 0.5
    rows += [(1000, slight, "good"), (1001, slight, "poor"), (1002, strong, "good"), (1003, clean, "poor")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r["row"][0]: r for r in hosts.host_rules(frame, ["doc_id"]).collect()}
    assert max(r["host_rate"] for r in got.values()) < 0.5
    assert {n for n, r in got.items() if not r["kept"]} == {*range(850, 1000), 1001, 1002}


def test_host_evidence_changes_verdicts_on_a_given_table(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = hosts.host_rules(docs, ["doc_id"]).collect()
    gone = [r["row"][0] for r in rows if not r["kept"] and not r["base_failed"]]
    assert len(rows) == docs.count() and len(gone) > 600
    marks = Counter(labels[n] for n in gone if n in labels)
    assert marks[1] == 0 and marks[0] > 250
    left = {r["doc_id"] for r in hosts.quality_filter(docs).select("doc_id").collect()}
    assert left == {r["row"][0] for r in rows if r["kept"]}


# packing ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng = random.Random(seed)
    histogram = Counter(min(64, int(rng.expovariate(1 / 12)) + 1) for _ in range(rng.randint(1, 3000)))
    used = Counter()
    sequences = 0
    for lengths, times in packing.plan(dict(histogram), 64):
        assert sum(lengths) <= 64 and times > 0
        sequences += times
        for length in lengths:
            used[length] += times
    assert used == histogram
    least = -(-sum(n * c for n, c in histogram.items()) // 64)
    assert sequences <= least + 1 + least // 50


def test_pack_against_the_tokenizer(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = ODD + ["  two  spaces\n\n x y 　 z", "it's <|endoftext|> o'clock", "line\r\n end "]
    rows = packing.pack(docs(texts), path, size=256).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        assert row["ids_crc32"] == zlib.crc32(row["ids"]) and len(row["ids"]) == 4 * row["length"]
        by_doc[row["doc_id"]].append(row)
        by_sequence[row["sequence_id"]].append(row)
    for n, text in enumerate(texts):
        own = sorted(by_doc[n], key=lambda r: r["piece"])
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        assert np.frombuffer(b"".join(r["ids"] for r in own), "<u4").tolist() == ids
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert sum(r["length"] for r in own) <= 256
    assert packing.pack(docs([]).limit(0), path).collect() == []


# byte-level BPE ---------------------------------------------------------------------------------

def test_bpe_against_tiktoken(spark, docs, sf):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = ODD + ["  two  spaces\n\n x y 　 z ", "it's <|endoftext|> 12345 \U0001f600", "\n \n", "z" * 3000, " lead"]
    frame = docs(texts).union(spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id") + 1000, "text"))
    source = {r["doc_id"]: r["text"] for r in frame.collect()}
    for row in bpe.bpe_round_trip(frame, path, public_tokenizers.PATTERN).collect():
        text = source[row["doc_id"]] or ""
        ids = plain.encode_ordinary(text)
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids and row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == text.encode()


def test_perfect_hash_is_minimal():
    ranks = {f"t{i}".encode(): i for i in range(2000)}
    table = bpe.PerfectHash(ranks)
    assert sorted(table.ranks) == list(range(2000)) and all(table.find(t) == r for t, r in ranks.items())
    assert table.find(b"other") == -1


# toxicity and site quality ----------------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"  # sf0.01 has 34 toxic rows to learn from, too few
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels.filter("doc_id % 3 > 0"))
    assert (np.diff(model.thresholds) > 0).all()
    held = toxicity.score(docs, model).join(labels.filter("doc_id % 3 = 0").withColumnRenamed("toxic", "mark"), "doc_id")
    rows = [(r["mark"], r["toxic"], r["expected_severity"]) for r in held.collect()]
    by = {m: [s for x, _, s in rows if x == m] for m in (0, 1)}
    pairs = [(a > b) + 0.5 * (a == b) for a in by[1] for b in by[0]]
    assert sum(pairs) / len(pairs) > 0.9
    assert sum(1 for m, t, _ in rows if t and not m) <= 0.03 * len(by[0])


def test_toxicity_without_labels_and_odd_texts(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    rows = toxicity.score(docs(ODD), toxicity.fit(docs(ODD), none)).collect()
    assert len(rows) == len(ODD) and not any(r["toxic"] for r in rows)
    assert toxicity.score(docs([]).limit(0), toxicity.fit_ordinal([], np.empty(0, int))).collect() == []


def test_site_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = sites.site_quality(docs, labels.filter("doc_id % 3 > 0"))
    assert judged.count() == docs.count()
    rows = judged.join(labels.filter("doc_id % 3 = 0"), "doc_id").select("quality", "kept").collect()
    assert sum(bool(q) == k for q, k in rows) >= 0.97 * len(rows)


def test_site_posterior_counts_in_full(spark):
    rows = [(n, "good words in a line " * 5, "a", "p") for n in range(50)]
    rows += [(100 + n, "### $$$ !!! " * 8, "b", "p") for n in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([(n, int(n < 100)) for n in [*range(50), *range(100, 150)]], "doc_id bigint, quality int")
    got = sites.site_quality(docs, labels).collect()
    odds = lambda p: np.log(p / (1 - p))
    general = (sum(r["evidence"] for r in got) + 0.5) / (len(got) + 1)
    shifts = [odds(r["posterior"]) - odds(r["evidence"]) for r in got]
    assert np.allclose(shifts, [odds(r["path_rate"]) - odds(general) for r in got], atol=1e-6)
    assert min(shifts) < -1.5 and max(shifts) > 1.5


def test_sparse_sites_are_shrunk_towards_their_host(spark):
    rows = [(n, "good words in a line " * 5, "a", "p" if n else "q") for n in range(50)]
    rows += [(100 + n, "### $$$ !!! " * 8, "b", "p") for n in range(50)] + [(200, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").withColumn("host", F.lit(1))
    labels = spark.createDataFrame([(n, int(n < 100)) for n in range(0, 150, 2)] + [(None, 1)], "doc_id bigint, quality int")
    got = {r["doc_id"]: r for r in sites.site_quality(docs, labels).collect()}
    assert len(got) == len(rows) and got[0]["kept"] and got[49]["kept"] and not got[149]["kept"]
    assert got[0]["host_rate"] > got[100]["host_rate"]
    none = labels.limit(0)
    assert {r["evidence"] for r in sites.site_quality(docs, none).collect()} == {0.5}
    assert sites.site_quality(docs.limit(0), none).collect() == []


def test_op4_reads_its_losses_from_expanded_examples(spark, tmp_path, plan_of, monkeypatch):
    from tidemark.llm import queries

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b<|im_end|>"), (1, 2, "assistant", "\U0001f600"), (2, 0, "user", "c"), (None, 0, "assistant", "")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    seen, examples = [], chat.examples
    monkeypatch.setattr(chat, "examples", lambda *a, **k: seen.append(examples(*a, **k)) or seen[-1])
    found = queries.op4_chat_format(spark, str(tmp_path))
    got = {r["conv_id"]: r for r in found.collect()}
    assert len(seen) == 1 and "posexplode" in plan_of(found)
    parts = {(r["conv_id"], r["example"]): r for r in seen[0].collect()}
    assert parts[1, 1]["context"].startswith("<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\n") and parts[1, 1]["reply"] == "\U0001f600"
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in got.items()} == {1: (3, 12), 2: (1, 0), None: (1, 0), -1: (2, 34)}
    assert got[1]["loss_sha256"] == hashlib.sha256("b<|im_end|>\U0001f600".encode()).hexdigest()
