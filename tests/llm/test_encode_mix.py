import os
import random

import numpy as np
import pytest

from tidemark.llm import encode
from tidemark.llm.encode import DEFAULT_VOCAB, ByteBPE, encode_texts
from tidemark.llm.mix import mix_sources, mixture_shares, splitting_tree, token_sizes

tokenizers = pytest.importorskip("tokenizers")
pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_VOCAB), reason="no vocabulary files here")


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(DEFAULT_VOCAB)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def samples():
    rng = random.Random(5)
    parts = [*"aaabcdesrtvlm'''  \n\t .,-0123éß中国文字，。１２　\xa0​́😀", "'s", "'re", "<|endoftext|>", " '", "''", "  ", "\r\n", "the ", "𝐀", "ﬁ"]
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    out += ["".join(rng.choice(every) if rng.random() < 0.5 else rng.choice(parts) for _ in range(20)) for _ in range(3000)]
    return out + ["", " ", "\n\n", "a" * 5000, " " * 3000, "ab" * 777, "aaa" * 101 + "b", "'", "''s's", "'ll", "x'"]


def test_ids_equal_the_library(reference):
    texts = samples()
    enc = ByteBPE(DEFAULT_VOCAB)
    raw = [t.encode() for t in texts]
    at = np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)
    ids, n = enc.encode(np.frombuffer(b"".join(raw), np.uint8), at)
    ends = np.append(0, np.cumsum(n))
    assert [ids[ends[i] : ends[i + 1]].tolist() for i in range(len(texts))] == reference(texts)


def test_long_texts_are_cut_without_a_trace(reference):
    enc = ByteBPE(DEFAULT_VOCAB)
    rng = random.Random(6)
    parts = ["word", " two", "'s", "\n", "\n\n", " ", "中", "文字", "。", "\u3000", "12", "é", "\nA", "a\n'll", "\t", "x\ny"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 80))) for _ in range(1500)] + ["a" * 300, "中文" * 200, "\n" * 50]
    want = reference(texts)
    cut = 0
    for t, w in zip(texts, want, strict=True):
        raw = np.frombuffer(t.encode(), np.uint8)
        for size in (1, 7, 40):
            cut += len(enc.safe_cuts(raw, size)) - 2
            ids, n = enc.encode_long(raw, size)
            assert ids.tolist() == w and n.tolist() == [len(w)]
    assert cut > 1000


def test_colliding_hashes_stay_apart(monkeypatch):
    raw = np.frombuffer(b"the cat the dog the catalogue of words", np.uint8)
    start = np.array([0, 4, 8, 12, 16, 20, 30, 33])
    length = np.diff(np.append(start, len(raw)))
    monkeypatch.setattr(encode.pd, "factorize", lambda h: (np.zeros(len(h), np.int64), None))
    codes, rep = encode._factorize(raw, start, length)
    pieces = [raw[s : s + n].tobytes() for s, n in zip(start, length, strict=True)]
    assert [pieces[rep[c]] for c in codes] == pieces


@pytest.mark.parametrize("slice_bytes", [1, 50, 2_000_000])
def test_encode_texts(spark, reference, slice_bytes):
    texts = ["one two", None, "", " ", "中文，很长" * 50, "one two", "<|endoftext|>", "x" * 20_000]
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "k bigint, t string, ids string")
    out = {r.k: r for r in encode_texts(df, key="k", text="t", counts=True, slice_bytes=slice_bytes).collect()}
    want = reference([t or "" for t in texts])
    assert [out[i].ids for i in range(len(texts))] == want and [out[i].n_tokens for i in range(len(texts))] == [len(w) for w in want]
    assert encode_texts(df.limit(0), key="k", text="t").count() == 0


def test_bytes_that_are_no_utf8(spark, reference):
    raws = [b"one \xff two", b"\xe4\xb8", b"\xad fine", b"caf\xc3\xa9", b"\x80\x80", b"\xed\xa0\x80 x", b"", "中文".encode()[:-1] * 40]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(raws)], "k bigint, b binary").selectExpr("k", "CAST(b AS STRING) AS t")
    want = reference([b.decode("utf-8", "replace") for b in raws])
    for size in (30, 2_000_000):
        got = {r.k: r.ids for r in encode_texts(df.coalesce(1), key="k", text="t", slice_bytes=size).collect()}
        assert [got[i] for i in range(len(raws))] == want


def test_the_vocabulary_is_sent(spark):
    from pyspark import SparkFiles

    assert encode._sent(spark.sparkContext, DEFAULT_VOCAB) == DEFAULT_VOCAB and os.path.exists(SparkFiles.get(os.path.basename(DEFAULT_VOCAB)))


def test_splitting_tree_keeps_quotas():
    rng = np.random.default_rng(1)
    deal = splitting_tree([100, 0, 37, 5], 7, rng)
    assert deal.sum(axis=0).tolist() == [100, 0, 37, 5] and set(deal.sum(axis=1)) <= {20, 21}
    assert splitting_tree([0, 0], 3, rng).sum() == 0


SIZES = "doc bigint, source string, n_tokens bigint"
TARGETS = "source string, target_share double, max_repeat int"


def test_mixture_meets_shares_and_caps(spark):
    rows = [(i, "big", 10) for i in range(4000)] + [(10_000 + i, "small", 10) for i in range(200)] + [(20_000 + i, None, 10) for i in range(50)] + [(30_000, "big", 0)]
    sizes = spark.createDataFrame(rows, SIZES)
    targets = spark.createDataFrame([("big", 0.75, 1), ("small", 0.25, 3), ("absent", 0.1, 2), (None, 0.5, 1)], TARGETS)
    mix = mix_sources(sizes, targets, key="doc", shards=8, blocks=512)
    got = mix.collect()
    uses = {}
    for r in got:
        uses[r.doc, r.source] = uses.get((r.doc, r.source), 0) + 1
    assert max(v for (_, s), v in uses.items() if s == "big") == 1 and max(v for (_, s), v in uses.items() if s == "small") == 3
    tokens = {s: sum(r.n_tokens for r in got if r.source == s) for s in ("big", "small")}
    assert tokens["small"] == 6000 and tokens["small"] / sum(tokens.values()) == pytest.approx(0.25, abs=0.01)
    assert {r.source for r in got} == {"big", "small"} and all(r.n_tokens for r in got)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.position)
    assert len(by_shard) == 8 and all(sorted(p) == list(range(1, len(p) + 1)) for p in by_shard.values())
    assert len({(r.doc, r.copy_no) for r in got}) == len(got)
    again = mix_sources(sizes, targets, key="doc", shards=8, blocks=512)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
    report = {r.source: r for r in mixture_shares(mix, targets, sizes, key="doc").collect()}
    assert report["small"].max_copies == 3 and report["absent"].tokens == 0 and report[None].available_tokens == 500
    assert report["big"].actual_share + report["small"].actual_share == pytest.approx(1.0)


def test_mixture_beyond_what_there_is(spark):
    sizes = spark.createDataFrame([(i, "a", 5) for i in range(40)] + [(100 + i, "b", 5) for i in range(40)], SIZES)
    targets = spark.createDataFrame([("a", 0.9, 2), ("b", 0.1, 1)], TARGETS)
    got = mix_sources(sizes, targets, key="doc", total=10_000, shards=3, blocks=64).collect()
    assert sum(r.n_tokens for r in got if r.source == "a") == 400  # all it may, twice
    assert sum(r.n_tokens for r in got if r.source == "b") == 200


def test_mixture_of_nothing(spark):
    sizes, targets = spark.createDataFrame([], SIZES), spark.createDataFrame([], TARGETS)
    mix = mix_sources(sizes, targets, key="doc")
    assert mix.count() == 0 and mixture_shares(mix, targets, sizes, key="doc").count() == 0
    with pytest.raises(ValueError):
        mix_sources(sizes, spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], TARGETS), key="doc", max_sources=1)


def test_token_sizes_fold_sources(spark):
    df = spark.createDataFrame([(1, " News ", "one two"), (2, None, None), (3, " ", "x")], "doc bigint, source string, body string")
    assert sorted((r.doc, r.source, r.n_tokens) for r in token_sizes(df, key="doc", text="body", source="source").collect()) == [(1, "news", 2), (2, None, 0), (3, None, 1)]


def test_any_number_of_shards_holds_rows(spark):
    from tidemark.llm.mix import levels

    assert levels(64) == (1, 64) and levels(512) == (1, 512)
    for n in (513, 100_000, 10_000_000):
        groups, within = levels(n)
        assert groups * within >= n > groups * (within - 1)
    rows = spark.range(2_000_000).selectExpr("id AS doc", "CASE WHEN id % 4 = 0 THEN 'a' ELSE 'b' END AS source", "CAST(1 + id % 3 AS BIGINT) AS n_tokens")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1)], TARGETS)
    mix = mix_sources(rows, targets, key="doc", shards=100_000)
    per = mix.groupBy("shard", "source").count().groupBy("shard").agg({"count": "sum", "source": "count"}).collect()
    groups, within = levels(100_000)
    assert len(per) == groups * within and min(r["sum(count)"] for r in per) >= 2
    assert max(r["sum(count)"] for r in per) < 120  # the mean is 20
    uses = mix.groupBy("doc").count()
    assert uses.where("count > 2 OR (count > 1 AND doc % 4 != 0)").isEmpty()
