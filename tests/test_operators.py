"""Reference-style checks of single operators on small hand-made frames, with their edge cases."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.contracts import ContractError, Registry, TemporalPolicy, UsagePolicy, default_registry, parse_contract
from tidemark.functions import exprs
from tidemark.operators import catalog, evidence, features, ingest, quality, relations, textsearch
from tidemark.operators.windows import last_partitions, open_days, strict_window, window_coverage
from tidemark.sources import parsers
from tidemark.sources.tables import TableStore, append_records, write_raw

DAYS = ["20260618", "20260622", "20260623", "20260624", "20260625", "20260626"]


def calendar(spark):
    rows = [("SSE", d, "1") for d in DAYS] + [("SSE", "20260620", "0"), ("SZSE", "20260621", "1"), ("SSE", "20260626", "1")]
    return spark.createDataFrame(rows, "exchange string, cal_date string, is_open string")


def bars(spark, rows):
    return spark.createDataFrame(rows, "security_id string, trade_date string, pct_chg string, volume string, amount string, close double")


def test_momentum_ranks_and_drops_absent_entities(spark):
    rows = [("a", "20260625", "1", "10", "100", 1.0), ("a", "20260626", "9", "20", "300", 1.0), ("b", "20260625", "1", "10", "100", 1.0), ("b", "20260626", "-1", "x", None, 1.0), ("c", "20260625", "5", "1", "1", 1.0), (None, "20260626", "50", "1", "1", 1.0)]
    out = features.daily_momentum(bars(spark, rows), as_of="20260626", window=2).collect()
    assert [r.security_id for r in out] == ["a", "b"]
    assert out[0].window_return_pct == pytest.approx((1.01 * 1.09 - 1) * 100)
    assert out[0].amount_excess == 0.5 and out[1].latest_amount == 0.0 and out[1].latest_volume is None
    assert out[0].return_rank == 1.0 and out[1].return_rank == 0.5


def test_features_of_nothing_have_the_full_schema(spark):
    empty = bars(spark, [])
    assert features.daily_momentum(empty, as_of="x", window=1).count() == 0
    assert "momentum_score" in features.daily_momentum(empty, as_of="x", window=1).columns
    strength = features.window_strength(empty.withColumnRenamed("security_id", "index_id"), as_of="x", window=1, source_dataset="s", entity="index_id", activity="amount")
    assert strength.count() == 0 and "strength_score" in strength.columns
    assert features.concept_strength(empty.selectExpr("security_id AS concept_id", "trade_date", "pct_chg", "'n' AS name"), as_of="x", window=1).count() == 0


def test_market_strength_attaches_the_latest_value(spark):
    rows = bars(spark, [("i", "20260626", "1", "1", "5", 2.0), ("j", "20260626", "2", "1", "5", 3.0)]).withColumnRenamed("security_id", "index_id")
    basic = spark.createDataFrame([("i", "20260625", 9.0), ("i", "20260626", 100000.0)], "index_id string, trade_date string, total_mv double")
    out = {r.index_id: r for r in features.market_strength(rows, basic, as_of="20260626", window=1).collect()}
    assert out["i"].latest_total_mv == 100000.0 and out["j"].latest_total_mv is None


def test_limit_sentiment(spark):
    limits = spark.createDataFrame([("a", "20260626", "U"), ("b", "20260626", "涨停"), ("c", "20260626", "跌停板"), ("d", "20260625", None)], "security_id string, trade_date string, limit string")
    pool = spark.createDataFrame([("20260626", "3天2板", 1.0, 5.0, 2e8), ("20260626", "首板", 0.0, None, None), ("20260624", "7板", None, None, 9e9)], "trade_date string, board_tag string, open_num double, limit_order double, limit_amount double")
    out = {r.trade_date: r for r in features.limit_sentiment(limits, pool, as_of="20260626", window=3).collect()}
    assert sorted(out) == ["20260624", "20260625", "20260626"]
    r = out["20260626"]
    assert (r.limit_up_count, r.limit_down_count, r.ths_limit_up_count, r.max_board_height) == (2, 1, 2, 2)
    assert r.sentiment_score == pytest.approx(4 - 3 + 4 + 20 + 2 - 0.5)
    assert out["20260624"].max_board_height == 7 and out["20260624"].sentiment_score == pytest.approx(2 + 70 + 50)


def test_unknown_and_doubled_features_raise():
    with pytest.raises(ValueError):
        features.build_feature("no.such")
    with pytest.raises(ValueError):
        features.register_feature("ashare.daily_momentum", features.daily_momentum)


def test_close_return_falls_back(spark):
    df = spark.createDataFrame([("a", 1, None, 2.0), ("a", 2, None, 3.0), ("b", 1, 10.0, 1.0), ("c", 1, None, 4.0), ("d", 1, None, 0.0), ("d", 2, None, 4.0)], "k string, n int, p double, c double")
    got = dict(rows_of(df.groupBy("k").agg(features.close_return(F.col("p"), F.col("c"), F.col("n")).alias("r"))))
    assert got["a"] == pytest.approx(50.0) and got["b"] == pytest.approx(10.0) and got["c"] == 0.0 and got["d"] == 0.0


def test_rank_pct(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 1.0), ("g", 3.0), ("g", None), ("one", None)], "g string, v double")
    got = sorted(r.p for r in df.select(exprs.rank_pct("v", ["g"]).alias("p")).collect())
    assert got == pytest.approx([0.0, 0.5, 0.5, 1.0, 1.0])


def test_distributed_ranks_are_the_same(spark):
    import random

    from tidemark.operators.ranks import with_ranks

    rng = random.Random(8)
    rows = [(rng.choice(["g", None]), i, rng.choice([None, *range(12)]), rng.random()) for i in range(300)] + [("one", 999, None, 1.0)]
    df = spark.createDataFrame([(g, i, float(v) if v is not None else None, w) for g, i, v, w in rows], "g string, i int, v double, w double")
    for by in (["g"], []):
        one, many = (sorted((r.i, round(r.a, 9), round(r.b, 9)) for r in with_ranks(df, {"a": "v", "b": "w"}, by, distributed=d).collect()) for d in (False, True))
        assert one == many


def test_strict_window_never_borrows(spark):
    rows = spark.createDataFrame([("a", d) for d in DAYS if d != "20260625"], "security_id string, trade_date string")
    got = sorted(r.trade_date for r in strict_window(rows, calendar(spark), "20260626", 5).collect())
    assert got == ["20260622", "20260623", "20260624", "20260626"]
    assert strict_window(rows, calendar(spark), "20200101", 5).count() == 0
    assert [r.trade_date for r in open_days(calendar(spark), "20260623", 2).collect()] == ["20260623", "20260622"]


def test_coverage_statuses(spark):
    meta = [("full", d, "ok") for d in DAYS] + [("gap", d, "ok") for d in DAYS if d != "20260625"] + [("bad", d, "degraded" if d == "20260626" else None) for d in DAYS] + [("late", "20260701", "ok")]
    df = spark.createDataFrame(meta, "dataset_id string, partition_date string, quality_status string")
    got = {r.dataset_id: r for r in window_coverage(df, calendar(spark), "20260626", 5).collect()}
    assert {k: r.status for k, r in got.items()} == {"full": "ok", "gap": "partial_window", "bad": "degraded_input", "late": "missing"}
    assert got["gap"].missing == ["20260625"] and got["gap"].available == 4
    free = {r.dataset_id: r.status for r in window_coverage(df, calendar(spark), "20260626", 6, strict=False).collect()}
    assert free == {"full": "ok", "gap": "partial_window", "bad": "degraded_input", "late": "missing"}


def test_last_partitions_counts_partitions(spark):
    df = spark.createDataFrame([("2026-01-01", "a"), ("20260102", "a"), ("20260102", "b"), ("20260103", None)], "d string, k string")
    assert rows_of(last_partitions(df, ["d", "k"], 2, as_of="20260102").select("d", "k")) == [("20260102", "a"), ("20260102", "b")]
    assert rows_of(last_partitions(df, ["d"], 1)) == [("20260103", None)]


def test_keep_last_and_flags(spark):
    rows = [("k", "0", "20260101", 100.0, 1), ("k", "1", "20250101", 120.0, 2), (None, None, None, 5.0, 3), (None, None, None, 6.0, 4)]
    df = spark.createDataFrame(rows, "id string, update_flag string, ann_date string, total double, n int")
    assert rows_of(ingest.keep_last(df, ["id"], ordinal="n").select("id", "total")) == [(None, 6.0), ("k", 120.0)]
    assert ingest.keep_last(df, ["missing"]).count() == 4
    assert ingest.keep_last(df.limit(0), ["id"]).count() == 0


def test_recipe(spark):
    raw = spark.createDataFrame([("1", "x", "20260101"), ("1", "2.5", "20260101"), ("2", "nan", "20260102"), ("3", "7", None)], "ts_code string, vol string, trade_date string")
    r = ingest.Recipe("r", "ashare.daily", {"ts_code": "security_id", "vol": "volume"}, ("volume",))
    out = ingest.run_recipe(raw, r, ["trade_date", "security_id"], {"trade_date": "20260101"})
    assert rows_of(out.select("security_id", "volume")) == [("1", 2.5)]


def test_templates():
    got = ingest.resolve({"a": "${params.n}", "b": ["x-${partition.d}-${params.n}", 3]}, partition={"d": "D"}, params={"n": 7})
    assert got == {"a": 7, "b": ["x-D-7", 3]}
    with pytest.raises(ValueError):
        ingest.resolve("${params.absent}", partition={}, params={})


def test_table_quality_order(spark):
    c = parse_contract("t.x|core_fact|d|d,k|v|v,w|eod,final,post_close,exact|forbid_empty|context|trade_execution")
    df = lambda rows, s="d string, k string, v double, w double": spark.createDataFrame(rows, s)
    status = lambda d, p={"d": "1"}: quality.table_quality(d, c, p).first().status
    assert status(df([("1", "a", 1.0, 1.0)])) == "ok"
    assert status(df([("1", "a", 1.0, 1.0)]), {}) == "partition_mismatch"
    assert status(df([("2", "a", 1.0, 1.0)])) == "partition_mismatch"
    assert status(df([(None, "a", 1.0, 1.0)])) == "partition_mismatch"
    assert status(df([("1", "a")], "d string, k string")) == "schema_mismatch"
    assert status(df([("1", None, 1.0, 1.0), ("1", None, 2.0, 1.0)])) == "primary_key_violation"
    assert status(df([])) == "empty"
    assert status(df([("1", "a", 1.0)], "d string, k string, v double")) == "degraded"
    assert rows_of(quality.mismatch_counts(df([("2", "a", 1.0, 1.0), (None, "b", 1.0, 1.0)]), {"d": "1"})) == [("d", 2)]


def test_feature_quality(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 1.0)], "a double, b double")
    q = lambda f, cols, inputs=None: quality.feature_quality(f, cols, inputs or {}).first()
    assert q(df, ["a"]).status == "ok"
    assert q(df, ["a", "b"]).reason == "analysis columns below non-null threshold"
    assert q(df, ["c"]).reason == "missing analysis columns"
    assert q(df.limit(0), ["a"]).reason == "empty feature partition"
    assert q(df, ["a"], {"x": ("optional", "missing")}).status == "ok"
    assert q(df, ["a"], {"x": ("degrade_if_missing", "missing")}).reason == "degraded feature inputs"
    assert q(df, ["a"], {"x": ("required", "missing")}).reason == "required feature inputs are not usable"


def test_contracts():
    reg = default_registry()
    assert len(reg) == 66 and reg.require("ashare.daily").window_key() == "trade_date"
    assert reg.require("ashare.main_business").window_key() is None
    assert reg.require("ashare.main_business").usage.permits("company_business_exposure")
    assert not reg.require("ashare.daily").usage.permits("company_business_exposure")
    with pytest.raises(ContractError):
        reg.require("none")
    with pytest.raises(ContractError):
        UsagePolicy(("a",), ("a",))
    with pytest.raises(ContractError):
        TemporalPolicy("never", "final", "x", "exact")
    with pytest.raises(ContractError):
        Registry([reg.require("ashare.daily")] * 2)


def test_catalog(spark):
    found = catalog.search_contracts(default_registry().frame(spark), ["sec_filings", " "]).collect()
    assert [r.dataset_id for r in found] == ["global.sec_filings"] and found[0].score == 20
    df = spark.createDataFrame([("a", "ok"), ("a", "warning"), ("b", "missing"), ("c", "ok"), ("d", None)], "k string, status string")
    assert {r.k: r.status for r in catalog.roll_up(df, ["k"]).collect()} == {"a": "degraded", "b": "blocked", "c": "ok", "d": "ok"}
    name, parts = catalog.parse_ref(F.col("r"))
    refs = spark.createDataFrame([("x:a=1,b=2=3",), ("bare",), ("y:broken",)], "r string").select(name.alias("n"), parts.alias("m")).collect()
    assert [(r.n, r.m) for r in refs] == [("x", {"a": "1", "b": "2=3"}), ("bare", {}), ("y", {})]
    docs = spark.createDataFrame([(1, '{"a": [{"b": {}}, 3], "c": null}'), (2, "no json"), (3, None), (4, "[]")], "k int, j string")
    assert [r.path for r in catalog.walk_objects(docs, "k", "j").collect()] == ["$", "$.a[0]", "$.a[0].b"]


SRC = "source_ref struct<source_type:string,source_name:string,source_url:string,published_at:string,query_time:string>"


def test_evidence(spark):
    s = f"claim string, topic string, metric string, period string, value_json string, confidence string, maturity string, n int, {SRC}"
    src = ("vendor", "v", "u", "p", "q1")
    rows = [("c", "t", None, None, None, "high", "fetched", 1, src), ("c", "t", None, None, None, "high", "fetched", 2, (*src[:4], "q2")), ("c", "t", "", None, None, "high", "fetched", 3, src), (" ", "t", None, None, None, "high", "fetched", 4, src), ("c", "t", None, None, None, "sure", "fetched", 5, None)]
    df = spark.createDataFrame(rows, s).withColumn("id", evidence.evidence_id())
    ids = {r.n: r.id for r in df.collect()}
    assert ids[1] == ids[2] and ids[1] != ids[3]  # the query time doesn't count, null isn't blank
    assert {r.n: r.problem for r in evidence.problems(df).collect()} == {1: None, 2: None, 3: None, 4: "claim is required", 5: "invalid confidence"}
    new = evidence.new_records(df, df.where("n = 3"), id_column="id", ordinal="n")
    assert sorted(r.n for r in new.collect()) == [1, 4, 5]
    assert evidence.new_records(df.limit(0), df, id_column="id", ordinal="n").count() == 0


def test_evidence_builders(spark):
    one = lambda d, cols, vals, **k: evidence.evidence_from(d, spark.createDataFrame([vals], cols), **k).collect()
    [r] = one("ashare.income_statement", "security_id string, period string, total_revenue double, n_income double", ("1.SH", "20251231", 5.0, None))
    assert r.claim == "Tushare income_statement reports 1.SH period 20251231: total_revenue=5.0." and r.source_ref.published_at == "20251231"
    [r] = one("ashare.main_business", "item_name string, sales double", ("Glass", 2.0), partition={"security_id": "1.SH", "period": "2025", "segment_type": "P"})
    assert "1.SH 2025 product segment 'Glass' with sales 2.0 CNY." in r.claim and r.unit == "CNY"
    [r] = one("global.sec_companyfacts", "cik string, concept string, unit string, end_date string, filed_date string, source_url string, value double, form string", ("7", "Cash", "USD", "d1", "d2", "u", 1.5, "10-K"))
    assert r.claim == "SEC companyfacts reports CIK 7 (7) Cash=1.5 USD for period ending d1, filed d2 on form 10-K."
    [r] = one("ashare.shareholder_trades", "ann_date string, security_id string, holder_name string, in_de string, change_vol double", ("d", "s", "h", "in", 3.0))
    assert r.claim == "Tushare stk_holdertrade reports s shareholder h increase event announced on d: change_vol=3.0 shares."
    [r] = one("industry.eastmoney_report_index", "report_id string, title string, source_url string, published_at string", ("1", "T", "u", "2026-01-02 10:00"))
    assert r.source_ref.source_name == "Eastmoney Report API" and r.source_ref.published_at == "2026-01-02" and "unknown industry" in r.claim
    assert one("ashare.announcement_text", "announcement_id string, security_id string, title string, publish_date string, source_url string, parse_status string", ("a", "s", "t", "d", "u", "parse_error")) == []
    assert one("no.such", "a int", (1,)) == []
    assert one("ashare.repurchase_events", "ann_date string, security_id string, process_status string, low_limit double", ("d", "s", "done", 1.0))[0].claim.endswith("process_status=done, price_limit=1.0- CNY/share.")
    assert one("ashare.earnings_forecast_events", "ann_date string, security_id string, period string, forecast_type string, p_change_min double", ("d", "s", "p", "up", 1.0))[0].claim.endswith("forecast_type=up; p_change_min=1.0.")


ENT = "struct<entity_type:string,entity_id:string,name:string,market_scope:string>"


def test_relations(spark):
    s = f"relation_id string, subject {ENT}, predicate string, object_ref {ENT}, confidence string, claim string, valid_from string, source_ref struct<evidence_id:string,raw_ref:string,source_name:string,source_url:string,published_at:string,query_time:string>, tags array<string>"
    node, firm = ("product", "product:battery", "Battery", "cn"), ("company", "company:x", "X", None)
    ok = ("e", "r", None, None, None, None)
    rows = [("1", firm, "supplies_to", node, "high", "c", "2025", ok, ["curated"]), ("2", node, "has_component", firm, "low", "c", None, ok, None), ("3", firm, "likes", node, None, None, None, (None, None, None, "u", None, None), [])]
    df = spark.createDataFrame(rows, s)
    assert {r.relation_id: r.problem for r in relations.problems(df).collect()} == {"1": None, "2": None, "3": "invalid predicate"}
    assert sorted((r.relation_id, r.direction) for r in relations.neighbourhood(df, "BATTERY").collect()) == [("1", "incoming"), ("2", "outgoing"), ("3", "incoming")]
    assert [r.relation_id for r in relations.search(df, tag="curated").collect()] == ["1"]
    assert relations.search(df, limit=2).count() == 2 and relations.search(df, limit=0).count() == 3
    terms = {r.term for r in relations.alias_terms(df).collect()}
    assert terms == {"product:battery", "battery", "company:x", "x"}
    assert rows_of(relations.entities(df))[0][3] == 3
    assert df.select(relations.relation_key().alias("k")).distinct().count() == 3


def test_text_search(spark):
    t = spark.createDataFrame([(1, "ok", "a.b A.B a.b"), (2, "empty_text", "a.b"), (3, None, "xa.ba.bx"), (4, "ok", None), (5, "ok", " "), (6, "ok", "İİ a.b" )], "announcement_id int, parse_status string, text string")
    got = rows_of(textsearch.snippets(t, " A.b ", context=1).select("announcement_id", "match_start", "match_text", "snippet"))
    assert got == [(1, 0, "a.b", "a.b "), (1, 4, "A.B", " A.B "), (1, 8, "a.b", " a.b"), (3, 1, "a.b", "xa.ba"), (3, 4, "a.b", "ba.bx"), (6, 3, "a.b", " a.b")]
    assert textsearch.snippets(t, "A.B", case_sensitive=True).count() == 1
    with pytest.raises(ValueError):
        textsearch.snippets(t, " ")
    a = spark.createDataFrame([("年度报告", "s"), (None, "s")], "title string, security_id string")
    assert textsearch.announcement_search(a, category="财务报告").count() == 1
    with pytest.raises(ValueError):
        textsearch.announcement_search(a, category="x")


def test_parsers(spark):
    one = lambda text: spark.createDataFrame([(text,)], "body string")
    f = [""] * 36
    f[1], f[2], f[3], f[6], f[30] = "name", "000001", "-", "12", "oddtime"
    q = parsers.local_quotes(one('v_sz000001="' + "~".join(f) + '";v_bad="1";'), "body", snapshot_at="s", source_url="u").collect()
    assert len(q) == 1 and q[0].security_id == "000001.SZ" and q[0].price is None and q[0].volume == 12.0 and q[0].quote_time == "oddtime"
    assert parsers.local_quotes(one(None), "body", snapshot_at="s", source_url="u").count() == 0
    t = parsers.ticker_map(one('{"0": {"cik_str": 7, "ticker": "ab", "title": "T"}, "1": {"cik_str": null, "ticker": "x", "title": "y"}}'), "body").collect()
    assert [(r.cik, r.ticker) for r in t] == [("0000000007", "AB")]
    got = parsers.select_records(one('{"x": {"a": 1}}'), "body", "x", {"a": "a", "b": "b"}).collect()
    assert [tuple(r) for r in got] == [("1", None)]
    assert parsers.select_records(one("junk"), "body", "x", {"a": "a"}).count() == 0


def test_expressions(spark):
    df = spark.createDataFrame([("20260501",), ("20260430",), ("20261101",), ("20260901",)], "d string")
    assert [r[0] for r in df.select(exprs.due_period(F.col("d"))).collect()] == ["20260331", "20250930", "20260930", "20260630"]
    one = spark.createDataFrame([(1767866400123,)], "ms bigint")
    assert one.select(exprs.milliseconds_iso(F.col("ms"))).first()[0] == "2026-01-08T18:00:00+08:00"
    assert one.select(exprs.pad_cik(F.lit("CIK 320193"))).first()[0] == "0000320193"
    assert one.select(exprs.pad_cik(F.lit(None))).first()[0] == ""


def test_store_round_trip(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), registry=Registry([parse_contract("t.x|core_fact|d|d,k|v|v|eod,final,post_close,exact|forbid_empty|context|trade_execution"), parse_contract("t.two|core_fact|d,k|d,k|v|v|eod,final,post_close,exact|forbid_empty|context|trade_execution")]))
    frame = lambda d, *ks: spark.createDataFrame([(d, k, float(i)) for i, k in enumerate(ks)], "d string, k string, v double")
    with pytest.raises(ContractError):
        store.scan("t.x")
    for d in ("20260101", "20260102", "20260105"):
        store.publish("t.x", frame(d, "a", "b"), {"d": d}, lineage={"api": "x"})
    assert rows_of(store.read("t.x", {"d": "20260102"}, ["d", "k"])) == [("20260102", "a"), ("20260102", "b")]
    assert {r.d for r in store.window("t.x", "20260104", 2).collect()} == {"20260101", "20260102"}
    assert {r.d for r in store.latest("t.x").collect()} == {"20260105"} and store.partitions("t.x").count() == 3
    with pytest.raises(ContractError):
        store.publish("t.x", frame("20260101", "a"), {"d": "20260101"})
    store.publish("t.x", frame("20260101", "z"), {"d": "20260101"}, refresh=True)
    assert rows_of(store.read("t.x", {"d": "20260101"}, ["k"])) == [("z",)]
    with pytest.raises(ContractError):
        store.publish("t.x", frame("20260109", "a", "a"), {"d": "20260109"})
    with pytest.raises(ContractError):
        store.matching("t.x", {"q": "1"})
    with pytest.raises(ContractError):
        store.read("t.two", {"d": "1"})
    store.publish("t.two", frame("1", "007:x/ü").withColumn("d", F.lit("1")), {"d": "1", "k": "007:x/ü"})
    assert rows_of(store.read("t.two", {"d": "1", "k": "007:x/ü"}, ["k"])) == [("007:x/ü",)]
    meta = {r.partition["d"]: r.rows for r in store.meta().where("dataset_id = 't.x'").collect()}
    assert meta == {"20260101": 1, "20260102": 2, "20260105": 2}
    plan = store.matching("t.x", {"d": "20260102"})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_pk_d" in plan


def test_append_and_raw(spark, tmp_path):
    s = "id string, n int"
    old = spark.createDataFrame([("a", 1)], s)
    got = append_records(spark.createDataFrame([("a", 2), ("b", 3), ("b", 4), (None, 5)], s), old, str(tmp_path / "r"), id_column="id", ordinal="n")
    assert rows_of(got) == [("b", 3)] and spark.read.schema(s).json(str(tmp_path / "r")).count() == 1
    path = write_raw(old, str(tmp_path), "src", "api", {"x": 1}, "t")
    assert spark.read.json(path).count() == 1
    with pytest.raises(Exception, match="exists|EXISTS"):
        write_raw(old, str(tmp_path), "src", "api", {"x": 1}, "t")
