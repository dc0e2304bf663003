import random

import numpy as np
import pytest

from tidemark.llm.spans import _thinned, anchors, covered, equal_runs, rolling_hash, shared_chars, shared_parts, shared_spans

L = 40


def brute(docs, least):
    where = {}
    for k, t in docs:
        if t:
            for i in range(len(t) - least + 1):
                where.setdefault(t[i : i + least], set()).add(k)
    out = {}
    for k, t in docs:
        hit = [(i, i + least) for i in range(len(t or "") - least + 1) if len(where[t[i : i + least]]) > 1]
        if hit:
            out[k] = covered(hit)
    return out


def documents(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop汉字 é😀") for _ in range(n))
    passages = [word(n) for n in (39, 40, 41, 80, 200)]
    hot = word(75)
    docs = []
    for i in range(60):
        parts = [word(rng.randint(0, 120))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            a = rng.randint(0, 20)
            parts += [p[a:] if rng.random() < 0.3 else p, word(rng.randint(0, 50))]
        if i % 2:
            parts += [hot, word(9)]
        docs.append((i, "".join(parts)))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (102, None), (103, ""), (104, "short"), (105, "z" * 500), (106, "y" + "z" * 90), (107, "ab" * 300), (108, "q" * 70)]
    return docs


@pytest.mark.parametrize(("seed", "cap"), [(1, 4), (2, 2), (3, 50)])
def test_shared_chars_match_brute_force(spark, seed, cap):
    docs = documents(seed)
    df = spark.createDataFrame([(k, t, "x") for k, t in docs], "k bigint, t string, ident string")
    got = {r.k: r.shared_chars for r in shared_chars(df, key="k", text="t", least=L, cap=cap, buckets=3).collect()}
    assert got == brute(docs, L)


def test_spans_are_verbatim(spark):
    docs = documents(5)
    df = spark.createDataFrame(docs, "k bigint, t string")
    texts = {r.i: r.t for r in df.selectExpr("xxhash64(t, length(t)) AS i", "t").collect()}
    parts = shared_parts(df, text="t", least=L, cap=50, buckets=2).collect()
    pairs = [r for r in parts if r.partner is not None]
    assert pairs
    for r in pairs:
        n = r.end - r.start
        assert n >= L and texts[r.ident][r.start : r.end] == texts[r.partner][r.partner_start : r.partner_start + n]
        before = r.start and r.partner_start and texts[r.ident][r.start - 1] == texts[r.partner][r.partner_start - 1]
        assert not before  # maximal


def test_nothing_shared(spark):
    s = "k bigint, t string"
    assert shared_chars(spark.createDataFrame([], s), key="k", text="t", least=L).count() == 0
    assert shared_chars(spark.createDataFrame([(1, "ab" * 400), (2, None)], s), key="k", text="t", least=L).count() == 0
    twice = spark.createDataFrame([(None, "x1" * 50), (None, "x1" * 50)], s)
    assert [r.shared_chars for r in shared_chars(twice, key="k", text="t", least=L).collect()] == [100, 100]


def test_every_window_goes_by_an_anchor():
    rng = np.random.default_rng(1)
    cp = rng.integers(97, 100, 3000).astype(np.uint32)
    starts = np.array([0, 700, 701, 1500])
    at, key, is_block = anchors(cp, starts, 20, 14)
    chosen = set(at.tolist())
    ends = [*starts[1:], len(cp)]
    for a, b in zip(starts, ends, strict=True):
        for i in range(a, b - 20 + 1):
            assert any(p in chosen for p in range(i, i + 7))
    assert is_block.any() and (key == rolling_hash(cp, 14)[at]).all()


def test_helpers():
    assert covered([(0, 5), (3, 8), (10, 12), (10, 11)]) == 10
    assert equal_runs(np.array([1, 2, 3, 9, 5]), np.array([1, 2, 3, 8, 5]), 2) == [(0, 3)]
    long = "".join(chr(97 + i % 26) for i in range(1000))
    h = rolling_hash(np.frombuffer(long.encode("utf-32-le"), np.uint32), 30)
    assert len({int(x) for x in h[:26]}) == 26 and h[0] == h[26]


def test_whole_copies_are_spans_of_each_document(spark):
    docs = documents(6) + [(200, "only copied " * 9), (201, "only copied " * 9), (None, "only copied " * 9)]
    df = spark.createDataFrame(docs, "k bigint, t string")
    rows = shared_spans(df, key="k", text="t", least=L, buckets=2).collect()
    per: dict = {}
    for r in rows:
        per.setdefault(r.k, []).append((r.start, r.end))
    assert {k: covered(v) for k, v in per.items()} == brute(docs, L)
    whole = [r for r in rows if r.partner == r.ident]
    groups: dict = {}
    for r in whole:
        assert (r.start, r.end, r.partner_start) == (0, len(dict(docs)[r.k]), 0)
        groups.setdefault(r.ident, set()).add(r.k)
    assert sorted(map(sorted, (g - {None} for g in groups.values()))) == [[3, 100, 101], [200, 201]] and len(whole) == 6


def crowded(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop汉字 é😀") for _ in range(n))
    hot, longer, other = word(1500), word(900), word(120)
    docs = [(i, f"{word(30 + i)}#{i}{hot}{chr(0x4E00 + i)}{word(30)}") for i in range(12)]
    docs += [(20 + i, word(9 + i) + longer + hot + longer[::-1] * (i % 2) + word(7)) for i in range(3)]
    docs += [(30 + i, word(20) + hot[60 * (i % 3) : 200] + word(20) + other + word(5)) for i in range(8)]
    return docs + documents(seed)


@pytest.mark.parametrize("hot", [1000, 2, 0])
def test_crowded_passages_keep_spans_and_links(spark, monkeypatch, hot):
    from tidemark.llm import spans

    monkeypatch.setattr(spans, "_HOT", hot)
    docs = crowded(7)
    df = spark.createDataFrame(docs, "k bigint, t string")
    rows = shared_parts(df, text="t", least=L, buckets=3).collect()
    texts = {r.i: r.t for r in df.selectExpr("xxhash64(t, length(t)) AS i", "t").where("length(t) >= 40").collect()}
    of = {t: i for i, t in texts.items()}
    got: dict = {}
    by_class: dict = {}
    for r in rows:
        if r.partner is None:
            by_class.setdefault(r["class"], []).append(r)
            assert r.end - r.start >= r.class_chars >= L
            continue
        n, a, b = r.end - r.start, texts[r.ident], texts[r.partner]
        assert a[r.start : r.end] == b[r.partner_start : r.partner_start + n]
        assert not (r.start and r.partner_start and a[r.start - 1] == b[r.partner_start - 1])
        assert a[r.end : r.end + 1] != b[r.partner_start + n : r.partner_start + n + 1] or r.end == len(a)
        got.setdefault((r.ident, r.partner), set()).update(range(r.start, r.end - L + 1))
    for members in by_class.values():
        assert len({texts[r.ident][r.start : r.start + r.class_chars] for r in members}) == 1
        for r in members:
            for o in {o.ident for o in members} - {r.ident}:
                got.setdefault((r.ident, o), set()).update(range(r.start, r.end - L + 1))
    where: dict = {}
    for i, t in texts.items():
        for p in range(len(t) - L + 1):
            where.setdefault(t[p : p + L], {}).setdefault(i, []).append(p)
    want: dict = {}
    for at in where.values():
        for i, places in at.items():
            for o in at.keys() - {i}:
                want.setdefault((i, o), set()).update(places)
    assert got == want
    crowd = [r for r in rows if r.partner is None]
    assert len(crowd) < 15 * len(texts)


def test_a_crowded_passage_is_one_row_in_each_text(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    hot = word(500)
    docs = [(i, f"{word(25 + i)}{chr(0x4E00 + i)}{hot}{chr(0x5E00 + i)}{word(30)}") for i in range(9)]
    docs += [(20 + i, f"{'z' * (90 + i)}{i}") for i in range(7)]
    df = spark.createDataFrame(docs, "k bigint, t string")
    rows = shared_spans(df, key="k", text="t", least=L, buckets=3).where("partner IS NULL").collect()
    assert sorted((r.k, r.start, r.end) for r in rows) == [(i, 26 + i, 526 + i) for i in range(9)] + [(20 + i, 0, 90 + i) for i in range(7)]
    assert len({r["class"] for r in rows}) == 2


def test_thinned_rows_tell_their_bucket():
    key = np.array([5] * 9 + [6] * 9 + [7, 7], np.uint64)
    ident = np.array([*range(9), *([1] * 9), 1, 2])
    pos = np.arange(20)
    sent, hot = _thinned(key, ident, pos, 4)
    assert sorted(hot.tolist()) == list(range(9))  # one text alone is no crowd
    told = [i for i in sent.tolist() if i < 9]
    assert len(told) == 5 and len({ident[i] for i in told}) > 1 and any(pos[i] & 1 for i in told) and set(range(9, 20)) <= set(sent.tolist())
    for at in range(9):  # a block is told wherever it stands
        places = np.arange(20) * 2 + (np.arange(20) == at)
        told = [i for i in _thinned(key, ident, places, 4)[0].tolist() if i < 9]
        assert len(told) == 5 and at in told and 8 in told
    assert [len(x) for x in _thinned(key[:0], ident[:0], pos[:0], 4)] == [0, 0]


@pytest.mark.parametrize(("coarse", "held", "hot"), [(2, 50, 1000), (4096, 200, 3), (3, 90, 0)])
def test_packing_changes_no_result(spark, monkeypatch, coarse, held, hot):
    from tidemark.llm import spans

    monkeypatch.setattr(spans, "_HOT", hot)
    monkeypatch.setattr(spans, "_COARSE", coarse)
    monkeypatch.setattr(spans, "_HELD", held)
    docs = documents(8)
    df = spark.createDataFrame(docs, "k bigint, t string")
    assert {r.k: r.shared_chars for r in shared_chars(df, key="k", text="t", least=L, buckets=7).collect()} == brute(docs, L)
