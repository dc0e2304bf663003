"""History, trailing totals and instants against brute force, with their edge cases."""

import datetime as dt
import random

from conftest import DATA, rows_of

from tidemark.operators.history import entity_history, snapshot_diff
from tidemark.operators.instants import normalise_instants
from tidemark.operators.rolling import standing_rows, trailing_totals
from tidemark.plans import problems

H = "scope string, subject string, predicate string, object string, confidence string, snap string, got timestamp, vf string, vt string, _seq string, change string"
ARGS = {"keys": ["subject", "predicate"], "attributes": ["object", "confidence"], "snapshot": "snap", "scope": "scope", "received": "got", "stated_from": "vf", "stated_to": "vt"}


def at(n):
    return dt.datetime(2026, 1, 1) + dt.timedelta(hours=n)


def brute_history(rows):
    dates = {}
    best = {}
    for r in rows:
        if r[5] is None:
            continue
        dates.setdefault(r[0], set()).add(r[5])
        rank = tuple((x is not None, x if x is not None else "") for x in (r[6], r[3], r[4], (r[7] or "").strip() or None, (r[8] or "").strip() or None))
        k = (r[0], r[1], r[2], r[5])
        if k not in best or rank > best[k][0]:
            best[k] = (rank, r)
    out = []
    for ent in {k[:3] for k in best}:
        days = sorted(dates[ent[0]])
        state = [best.get((*ent, d), (None, None))[1] for d in days]
        runs, i = [], 0
        while i < len(days):
            if state[i] is None:
                i += 1
                continue
            j = i
            while j + 1 < len(days) and state[j + 1] is not None and state[j + 1][3:5] == state[i][3:5]:
                j += 1
            run = state[i : j + 1]
            vf = min([r[7].strip() for r in run if r[7] and r[7].strip()], default=days[i])
            vt = min([r[8].strip() for r in run if r[8] and r[8].strip()], default=None)
            runs.append([i, j, vf, vt, run[0]])
            i = j + 1
        for n, (i, j, vf, vt, r) in enumerate(runs):
            if vt is None:
                nxt = runs[n + 1] if n + 1 < len(runs) else None
                vt = nxt[2] if nxt and nxt[0] == j + 1 else days[j + 1] if j + 1 < len(days) else "99991231"
            out.append((*ent, r[3], r[4], vf, vt))
    return out


def test_history_matches_brute_force(spark):
    rng = random.Random(4)
    pick = lambda *x: rng.choice(x)
    rows = []
    for _ in range(900):
        rows.append((pick("a", "b", None), pick("s1", "s2", "s3", None), pick("p", "q", None), pick("x", "y", None), pick("low", "high", None), pick(*[f"2026010{i}" for i in range(1, 9)], None), pick(at(1), at(2), at(3), None), pick(None, None, " ", "20250101", "20251201"), pick(None, None, None, "20260301"), "extra", "extra"))
    rows += rows[:50]
    got = entity_history(spark.createDataFrame(rows, H), **ARGS).drop("version_no")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([tuple(r) for r in got.collect()], key=key) == sorted(brute_history(rows), key=key)


def test_history_of_nothing(spark):
    out = entity_history(spark.createDataFrame([], H), **ARGS)
    assert out.count() == 0
    assert out.columns == ["scope", "subject", "predicate", "object", "confidence", "version_no", "valid_from", "valid_to"]


def test_history_without_broadcast_is_the_same(spark):
    rows = [("a", f"s{i % 7}", "p", f"o{i % 3}", "low", f"202601{i % 9 + 10}", at(i), None, None, "", "") for i in range(80)]
    df = spark.createDataFrame(rows, H)
    assert rows_of(entity_history(df, **ARGS)) == rows_of(entity_history(df, max_calendar_rows=1, **ARGS))


def test_snapshot_diff_classifies(spark):
    state = spark.createDataFrame([("k", 1, "x"), ("k", 2, "y"), ("n", 2, None), ("n", 3, None)], "k string, seq int, v string")
    got = {(r.k, r.seq): r.change for r in snapshot_diff(state, ["k"], ["v"], "seq").collect()}
    assert got == {("k", 1): "inserted", ("k", 2): "changed", ("k", 3): "deleted", ("n", 2): "inserted", ("n", 3): None, ("n", 4): "deleted"}


def test_trailing_totals_match_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(100, 180)]), rng.choice([None, float("nan"), 1.5, -2.25, 10.0])) for _ in range(150)]
    daily = spark.createDataFrame(rows, "e string, d int, v double").selectExpr("*", "1 AS _v", "2 AS _a", "3 AS total_7")
    got = {(r.e, r.d): r for r in trailing_totals(daily, entity="e", day="d", value="v", periods=(7, 30)).collect()}
    days = {}
    for e, d, v in rows:
        if d is not None:
            days.setdefault(e, {}).setdefault(d, []).append(v)
    want = {}
    for e, by in days.items():
        for d in range(min(by), max(by) + 1):
            for n in (7, 30):
                inside = [v for k in range(d - n + 1, d + 1) for v in by.get(k, []) if v is not None and v == v]
                active = sum(any(v is not None and v == v for v in by.get(k, [])) for k in range(d - n + 1, d + 1))
                want.setdefault((e, d), []).append((sum(inside), active))
    assert got.keys() == want.keys()
    for k, ((s7, a7), (s30, a30)) in want.items():
        r = got[k]
        assert abs(r.total_7 - s7) < 1e-9 and abs(r.total_30 - s30) < 1e-9 and abs(r.avg_30 - s30 / 30) < 1e-9
        assert (r.active_days_7, r.active_days_30) == (a7, a30)


def test_trailing_totals_of_nothing(spark):
    assert trailing_totals(spark.createDataFrame([], "e string, d int, v double"), entity="e", day="d", value="v").count() == 0


def test_standing_rows(spark):
    df = spark.createDataFrame([("a", at(1), 1.0), ("a", at(2), 5.0), ("a", at(2), 5.0), ("a", at(2), 3.0), (None, None, None)], "k string, t timestamp, v double")
    assert rows_of(standing_rows(df, ["k"], "t", ["v"])) == [(None, None), ("a", 5.0)]


CLOCKS = [("ny", "America/New_York", "mdy"), ("ldn", "Europe/London", "dmy"), ("cn", "Asia/Shanghai", "ymd"), ("odd", "Nowhere/City", "dmy")]
CASES = [
    ("2026-03-08 02:30:00", "ny", "2026-03-08T07:30:00"),  # skipped: moved by the gap
    ("2025-11-02 01:30:00", "ny", "2025-11-02T05:30:00"),  # twice: the first
    ("Nov 2, 2025 1:30 AM EST", "ny", "2025-11-02T06:30:00"),
    ("2026-03-29", "ldn", "2026-03-29T00:00:00"),
    ("07/06/2026 04:05", "ldn", "2026-06-07T03:05:00"),
    ("07/06/2026 4:05 PM", "ny", "2026-07-06T20:05:00"),
    ("07/06/2026 04:05", "cn", None),  # the order of day and month isn't known
    ("2026年1月8日 上午12:24:40", "cn", "2026-01-07T16:24:40"),
    ("２０２６年１月８日 下午１２：２４：４０", "cn", "2026-01-08T04:24:40"),
    ("2026-01-08t10:00:00.1234567z", "ny", "2026-01-08T10:00:00.123456"),
    ("  20260108T101112+0530 ", "cn", "2026-01-08T04:41:12"),
    ("2026-01-08 10:00:00 America/New_York", "cn", "2026-01-08T15:00:00"),
    ("2026-01-08 10:00:00 Mars/Base", "cn", None),
    ("1767866400", "ny", "2026-01-08T10:00:00"),
    ("1767866400123", None, "2026-01-08T10:00:00.123"),
    ("1767866400123456", "none", "2026-01-08T10:00:00.123456"),
    ("17678664001", "ny", None),
    ("Thu, 08 Jan 2026 10:00:00 -0500", None, "2026-01-08T15:00:00"),
    ("2026-02-30", "ny", None),
    ("2026-13-01 10:00", "ny", None),
    ("2026-01-08 25:00:00", "ny", None),
    ("2026-01-08 13:00 PM", "ny", None),
    ("2026-01-08 10:60:00", "ny", None),
    ("2026-01-08 10:00:00", "none", None),
    ("2026-01-08 10:00:00", "odd", None),
    ("unknown", "ny", None),
    ("", "ny", None),
    (None, "ny", None),
    ("x" * 50_000, "ny", None),
]


def test_instants(spark):
    values = spark.createDataFrame([(i, v, s, "keep", 9) for i, (v, s, _) in enumerate(CASES)], "i int, v string, s string, zone string, _ti_t int")
    clocks = spark.createDataFrame([(*c, "x") for c in CLOCKS], "source_name string, zone_id string, date_order string, v string")
    out = normalise_instants(values, clocks, value="v", source="s")
    got = {r.i: r for r in out.collect()}
    for i, (v, s, want) in enumerate(CASES):
        us = None if want is None else int((dt.datetime.fromisoformat(want) - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
        assert got[i].utc_us == us, (v, s, want, got[i])
        assert got[i]["_ti_t"] == 9
    assert out.columns == ["i", "v", "s", "_ti_t", "utc_us", "zone", "pattern"]


def test_instants_hold_in_any_session_zone(spark):
    values = spark.createDataFrame([("2026-03-08 02:30:00", "ny"), ("2026-07-01", "ldn")], "v string, s string")
    clocks = spark.createDataFrame(CLOCKS, "source_name string, zone_id string, date_order string")
    before = rows_of(normalise_instants(values, clocks, value="v", source="s"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert rows_of(normalise_instants(values, clocks, value="v", source="s")) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_instants_of_nothing(spark):
    values = spark.createDataFrame([], "v string, s string")
    clocks = spark.createDataFrame([], "source_name string, zone_id string, date_order string")
    assert normalise_instants(values, clocks, value="v", source="s").count() == 0


def test_found_queries_have_their_columns(spark):
    assert problems.p1_found(spark, DATA).dtypes == [(c, "string") for c in ("subject_id", "predicate", "object_id", "confidence", "valid_from", "valid_to")]
    assert problems.p2_found(spark, DATA).dtypes == [("security_id", "string"), ("cal_date", "string")]
    assert problems.p5_found(spark, DATA).dtypes == [("record_no", "bigint"), ("field_name", "string"), ("utc_us", "bigint")]
