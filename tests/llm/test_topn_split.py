import random

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm.split import pieces_of, split_texts
from tidemark.llm.topn import top_n_per_group

S = "g string, h int, score double, id string, rank_in_group int, count int"
def order():
    return [F.desc("score"), F.asc_nulls_last("id")]



def brute(rows, n):
    groups = {}
    for r in rows:
        groups.setdefault(r[:2], []).append(r)
    return sorted((str(k), [x[3] for x in sorted(v, key=lambda r: (r[2] is None, -(r[2] or 0), r[3] is None, r[3] or ""))[:n]]) for k, v in groups.items())


def found(df):
    got = {}
    for r in df.collect():
        got.setdefault((r.g, r.h), []).append((r.rank_in_group, r.id))
    return sorted((str(k), [i for _, i in sorted(v, key=lambda x: x[0])]) for k, v in got.items())


@pytest.mark.parametrize(("heavy", "broadcast"), [(10_000, 100), (40, 100), (40, 0), (0, 100)])
def test_top_n_matches_brute_force(spark, heavy, broadcast):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 8 + ["a", None, "b"]), rng.choice([1, None]), rng.choice([None, 1.0, 2.0, 2.5, -3.0]), rng.choice([None, *map(str, range(50))]), 7, 8) for _ in range(600)]
    df = spark.createDataFrame(rows, S)
    assert found(top_n_per_group(df, ["g", "h"], order(), 5, heavy_rows=heavy, max_broadcast=broadcast)) == brute(rows, 5)


def test_top_n_of_repeats_and_nothing(spark):
    df = spark.createDataFrame([("a", 1, 1.0, "x", 0, 0)] * 9, S)
    assert [r.rank_in_group for r in top_n_per_group(df, ["g", "h"], order(), 3).collect()] == [1, 2, 3]
    assert top_n_per_group(df.limit(0), ["g", "h"], order(), 3).count() == 0
    assert top_n_per_group(df, ["count"], order(), 2, heavy_rows=3).count() == 2


TEXT = st.text(alphabet="ab c.。\n，1汉é́_", max_size=300)


@settings(max_examples=600, deadline=None)
@example("______", 5, 0)
@example("é́́́́́́́́́", 5, 4)
@example("é́́́́́́́́́" * 9, 6, 3)
@given(TEXT, st.integers(5, 40), st.integers(0, 4))
def test_pieces_join_to_the_text(text, limit, overlap):
    pieces, forced = pieces_of(text, limit, overlap)
    assert all(b - a <= limit for a, b, _ in pieces)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (_, b, level), (a, _, _) in zip(pieces, pieces[1:], strict=False):
        assert a == b - overlap and level >= 0
    joined = text[: pieces[0][1]] + "".join(text[a + overlap : b] for a, b, _ in pieces[1:])
    assert joined == text
    run = best = 0
    for c in text:
        run = run + 1 if c.isalnum() else 0
        best = max(best, run)
    if len(text) > limit:
        assert forced == (best > limit)


def test_cuts_prefer_coarse_boundaries():
    text = ("一句话。" * 20 + "\n\n") * 3
    pieces, forced = pieces_of(text, 100, 10)
    assert not forced and [text[b - 1] for _, b, _ in pieces[:-1]] == ["\n"] * (len(pieces) - 1)
    assert pieces_of("x" * 2001, 2000, 150)[1] and not pieces_of("x" * 2000 + " y", 2000, 150)[1]


def test_split_texts(spark):
    rows = [(1, "a " * 3000, 5), (2, None, 1), (3, "", 2), (None, "short", 3), (4, "汉" * 10_000, 4), (4, "汉" * 10_000, 4)]
    df = spark.createDataFrame(rows, "k bigint, t string, piece_no int")
    out = split_texts(df, key="k", text="t", limit=2000, overlap=150).collect()
    assert {r.k for r in out} == {1, None, 4}
    assert {r.forced for r in out if r.k == 4} == {1} and {r.forced for r in out if r.k == 1} == {0}
    assert [(r.piece, r.boundary) for r in out if r.k is None] == [("short", "end")]
    assert all(len(r.piece) <= 2000 and r.end - r.start == len(r.piece) for r in out)
    assert split_texts(df.limit(0), key="k", text="t").count() == 0
    with pytest.raises(ValueError):
        split_texts(df, key="k", text="t", limit=10, overlap=10)
