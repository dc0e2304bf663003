import random

import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import plans
from tidemark.llm.dedupe import ChunkStore, chunk_ends, chunk_table
from tidemark.llm.plans import agreeing, claims_of
from tidemark.llm.wording import Wording, agree, claim_of, learn_wording, number, slips, stated_number, tokens

SIZES = {"least": 6, "average": 8, "most": 32}
SMALL = {"least": 8, "average": 16, "most": 48, "coverage": 0.5}


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=600))
def test_chunks_tile_the_content(raw):
    ends = chunk_ends(raw, **SIZES)
    assert ends == sorted(set(ends)) and (ends[-1] if ends else 0) == len(raw)
    assert all(b - a <= 32 for a, b in zip([0, *ends], ends, strict=False))


def test_chunks_resynchronise():
    rng = random.Random(1)
    body = bytes(rng.randrange(32, 127) for _ in range(5000))
    cut = lambda raw: {raw[a:b] for e in [chunk_ends(raw, **SIZES)] for a, b in zip([0, *e], e, strict=False)}
    a, b = cut(body), cut(b"inserted at the front " + body)
    assert len(a & b) > 0.9 * len(a)


def never(pairs):
    return pairs.where(F.lit(False))


def near(pairs):
    return pairs.where(F.levenshtein("content", "other_content") <= 3)


def covers(new, old):
    a, b = (chunk_table(t.encode(), least=8, average=16, most=48) for t in (new, old))
    return sum(n for h, n in a.items() if h in b) / max(1, len(new.encode()))


def decide(store, spark, rows, agrees=near, **more):
    df = spark.createDataFrame([(k, c, "extra", 5) for k, c in rows], "no bigint, body string, repeats string, k int")
    return {r.no: r.repeats for r in store.ingest(df, key="no", content="body", agrees=agrees, **more).collect()}


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n))


def test_batches_against_history(spark, tmp_path):
    rng = random.Random(2)
    base = [words(rng, 40) for _ in range(6)]
    store = ChunkStore(spark, str(tmp_path / "s"), **SMALL)
    first = decide(store, spark, [(1, base[0]), (2, base[1]), (3, base[0]), (4, None), (5, "")])
    assert first == {1: None, 2: None, 3: 1, 4: None, 5: 4}
    changed = base[1][:200] + "X" + base[1][201:]
    assert covers(changed, base[1]) > 0.5
    second = decide(store, spark, [(6, changed), (7, base[2]), (8, changed), (9, base[2] + "!")])
    assert second == {6: 2, 7: None, 8: 2, 9: 7}
    assert decide(store, spark, []) == {}
    assert decide(store, spark, [(11, base[2] + "?")], never) == {11: None}


def test_a_store_goes_on_where_another_left_it(spark, tmp_path):
    rng = random.Random(4)
    base = [words(rng, 30) for _ in range(3)]
    assert decide(ChunkStore(spark, str(tmp_path / "s"), **SMALL), spark, [(1, base[0]), (2, base[1])], name="a") == {1: None, 2: None}
    again = ChunkStore(spark, str(tmp_path / "s"), **SMALL)
    assert decide(again, spark, [(3, base[0] + "!"), (4, base[2])], name="b") == {3: 1, 4: None}
    # a batch that comes again gives what it gave and adds nothing; so does one of another store object
    assert decide(again, spark, [(3, base[0] + "!"), (4, base[2])], name="b") == {3: 1, 4: None}
    third = ChunkStore(spark, str(tmp_path / "s"), **SMALL)
    assert third.commits == {"a": 0, "b": 1}
    assert decide(third, spark, [(1, base[0]), (2, base[1])], name="a") == {1: None, 2: None}
    # a part without a commit is what a lost driver left: it is not read, and written anew
    spark.createDataFrame([(9, 9)], "k bigint, repeats bigint").write.parquet(str(tmp_path / "s/decisions/part=000002"))
    assert decide(third, spark, [(5, base[2] + "?")], name="c") == {5: 4}


def test_history_is_not_shuffled_nor_read_outside_the_pairs(spark, tmp_path, monkeypatch):
    from tidemark.llm import dedupe

    plans_seen = {}
    real = dedupe.written
    monkeypatch.setattr(dedupe, "written", lambda df, name: (plans_seen.__setitem__(name, df._jdf.queryExecution().executedPlan().toString()), real(df, name))[1])
    rng = random.Random(5)
    base = [words(rng, 30) for _ in range(20)]
    store = ChunkStore(spark, str(tmp_path / "s"), **SMALL)
    decide(store, spark, list(enumerate(base)))
    decide(store, spark, [(50, base[3] + "!")])
    assert "Exchange hashpartitioning" not in plans_seen["dedupe-hits"] and "ReadSchema: struct<h:bigint,guard:string,k:bigint>" in plans_seen["dedupe-hits"]
    assert "GreaterThanOrEqual(k,3)" in plans_seen["dedupe-near"] and "LessThanOrEqual(k,3)" in plans_seen["dedupe-near"]


def test_guards_keep_rows_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, "the same text", "a"), (2, "the same text", "b"), (3, "the same text", "a"), (4, "the same text", None), (5, "the same text!", "b")], "no bigint, body string, g string")
    store = ChunkStore(spark, str(tmp_path / "s"))
    assert {r.no: r.repeats for r in store.ingest(df, key="no", content="body", guard="g", agrees=near).collect()} == {1: None, 2: None, 3: 1, 4: None, 5: 2}


def test_where_batches_end_does_not_matter(spark, tmp_path):
    rng = random.Random(9)
    base = [words(rng, 20) for _ in range(8)]
    rows = []
    for i in range(60):
        t = rng.choice(base)
        p = rng.randrange(len(t))
        rows.append((i, t if rng.random() < 0.5 else t[:p] + rng.choice("xyz") + t[p + 1 :]))
    one = decide(ChunkStore(spark, str(tmp_path / "a"), **SMALL), spark, rows)
    many: dict = {}
    store = ChunkStore(spark, str(tmp_path / "b"), **SMALL)
    for at in range(0, 60, 20):
        many |= decide(store, spark, rows[at : at + 20])
    assert one == many
    brute, kept = {}, []
    for k, t in rows:
        hit = [j for j, u in kept if u == t or (covers(t, u) >= 0.5 and sum(a != b for a, b in zip(t, u, strict=True)) <= 3)]
        brute[k] = hit[0] if hit else None
        if not hit:
            kept.append((k, t))
    assert one == brute


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_batches(spark, tmp_path, n):
    assert len(decide(ChunkStore(spark, str(tmp_path / "s")), spark, [(1, "x")] * n)) == n


def test_normal_forms():
    assert [t.text for t in tokens("２０２４ 年第３ 季度,up 10.0 per  cent by Q3’s 1,234,567.50")] == ["2024", "年", "第", "3", "季", "度", ",", "up", "10", "%", "by", "q3", "’", "s", "1234567.5"]
    assert tokens(None) == tokens(" ") == []
    assert [number(x) for x in ("007.50", "0", "1,000", "0.0")] == ["7.5", "0", "1000", "0"]
    assert [stated_number(x) for x in ('"1,767.5"', "9.50", "[1]", None, "n/a", "true")] == ["1767.5", "9.5", None, None, None, None]
    assert [slips(a, b) for a, b in (("abcd", "abdc"), ("abcd", "abc"), ("abcd", "abxy"), ("", "a"), ("a", "a"), ("abcd", "axcd"))] == [1, 1, 2, 1, 0, 1]


SCHEMA = "record_no bigint, batch_no int, claim string, company string, metric string, period string, value_json string"


def corpus():
    """Claims in invented words: nothing of them stands in the library."""
    rng = random.Random(3)
    forms = ("{c} noted {m} at {v} krel in {p}, {d} {x}% against {p} past", "In {p}, {m} at {c} was {v} krel - {d} {x}% against {p} past", "the {m} noted by {c} in {p} came to {v} krel, {d} {x}%")
    metrics = {"m1": "blor output", "m2": "sund cover", "m3": "tark"}
    out = []
    for i in range(900):
        c = "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(4)) + rng.choice([" worm", " felt", " lint"])
        m, p = rng.choice(list(metrics)), rng.choice(["q1 2031", "q2 2031", "q3 2032"])
        out.append((i, 0, rng.choice(forms).format(c=c.title(), m=metrics[m], v=f"{rng.uniform(100, 9999):,.1f}", p=p, d=rng.choice(["grown", "shrunk"]), x=round(rng.uniform(1, 60), 1)), c.title(), m, p, None))
    return out


def test_wording_is_learned(spark):
    w = Wording(tuple(r) for r in learn_wording(spark.createDataFrame(corpus(), SCHEMA)).collect())
    assert {"noted", "krel", "grown", "shrunk", "against", "the"} <= w.said - set(w.values[0]) - set(w.values[1])
    assert w.values[0]["blor"] == w.values[0]["output"] == {"m1"} and w.values[0]["sund"] == {"m2"} and w.values[0]["tark"] == {"m3"}
    assert w.values[1]["q1"] == {"q1 2031"} and w.values[1]["2032"] == {"q3 2032"}
    assert not {"worm", "felt", "lint"} & w.said  # parts of names, however common
    assert learn_wording(spark.createDataFrame([], SCHEMA)).count() == 0
    assert learn_wording(spark.createDataFrame([(1, 0, None, None, None, None, None)], SCHEMA)).count() == 0


def test_claims_in_other_words(spark, tmp_path):
    rows = corpus()
    learned = [tuple(r) for r in learn_wording(spark.createDataFrame(rows, SCHEMA)).collect()]
    n = len(rows)
    first = (n, 0, "Vabodi Felt noted blor output at 4,321.5 krel in q1 2031, grown 7.7% against q1 2031 past", "Vabodi Felt", "m1", "q1 2031", "4321.5")
    texts = [
        (n + 1, "the blor output noted by VABODI felt in q1 2031 came to 4321.50 krel, grown 7.7 per cent - q1 2031", n),
        (n + 2, "In q1 2031, blor output at Vabodi Felt was 4,321.5 krel - grown 7.7% against q1 2031 past", n),
        (n + 3, "Vabodi Felt noetd blor output at 4,321.5 krel in q1 2031, grown 7.7% aganst q1 2031 past", n),
        (n + 4, "Vabdoi Felt noted blor output at 4,321.5 krel in q1 2031, grown 7.7% against q1 2031 past", n),
        (n + 5, first[2].replace("grown", "shrunk"), None),
        (n + 6, first[2].replace("q1", "q2"), None),
        (n + 7, first[2].replace("4,321.5", "4,321.6"), None),
        (n + 8, first[2].replace("Felt", "Worm"), None),
        (n + 9, first[2].replace("blor output", "sund cover"), None),
        (n + 10, "Vabodi Felt is moving house", None),
        (n + 11, "Vabodi  felt IS moving house", n + 10),
        (n + 12, "Vabodi Felt is not moving house", None),
        (n + 13, None, None),
        (n + 14, " ", None),
    ]
    store = ChunkStore(spark, str(tmp_path / "s"))
    names = {"key": "record_no", "content": "content", "guard": "guard", "about": "about", "agrees": agreeing(spark, learned)}
    store.ingest(claims_of(spark.createDataFrame([*rows, first], SCHEMA), learned), **names)
    late = claims_of(spark.createDataFrame([(k, 1, t, None, None, None, None) for k, t, _ in texts], SCHEMA), learned)
    got = {r.record_no: r.repeats for r in store.ingest(late, **names).collect()}
    assert got == {k: want for k, _, want in texts}


def test_columns_decide_where_both_state_them():
    w = Wording([("rose", None, None), ("fell", None, None), ("sales", 0, "s"), ("q1", 1, "p1"), ("q2", 1, "p2")])
    c = lambda text, *cols: claim_of(text, *(*cols, None, None, None, None)[:4], w)
    t = "Acme Glass sales rose 3.5% to 77.25 in q1"
    assert agree(c(t), c(t), w) and agree(c(t, "Acme Glass", "s"), c(t), w)
    assert not agree(c(t, "Acme", "s"), c(t, "Acme", "p"), w) and not agree(c(t, "Acme Glass"), c(t, "Apex Water"), w)
    assert not agree(c(t, None, "other"), c(t), w) and not agree(c(t, None, None, "p2"), c(t), w) and agree(c(t, None, None, "P1"), c(t), w)
    assert not agree(c(t.replace("q1", "q2")), c(t), w)
    assert agree(c(t, "Acme Glass"), c(t, "Acme Galss"), w) and not agree(c(t), c(t.replace("rose", "fell")), w)


def test_batches_of_the_queries(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(plans, "ingest_all", lambda store, batches, **names: seen.extend(batches))
    plans.p6_decisions(spark, DATA)
    assert [n for n, _ in seen] == [f"batch-{i}-{i}" for i in range(24)]
    assert [{r.batch_no for r in b.select("batch_no").collect()} for _, b in seen] == [{i} for i in range(24)]
    assert plans.spans_of([(0, 50), (1, 4), (2, 5), (3, 2), (5, 30), (6, 1)], 10) == [(0, 0), (1, 2), (3, 3), (5, 5), (6, 6)]
    assert plans.spans_of([(0, 1), (1, 1), (2, 1)], 10) == [(0, 0), (1, 2)] and plans.spans_of([(7, 9)], 10) == [(7, 7)]


def test_together_or_one_by_one(spark):
    key = lambda df: sorted((r.record_no, r.repeats or 0) for r in df.collect())
    one = key(plans.p6_decisions(spark, DATA))
    assert one == key(plans.decisions(spark, DATA, plans.AT_ONCE)) and any(r for _, r in one)
