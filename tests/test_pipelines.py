"""Recipes, pipelines, inventory, gates and the edges of the store."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.contracts import ContractError, Registry, default_registry, parse_contract
from tidemark.functions import exprs
from tidemark.operators import catalog, gates, ingest, inventory, textsearch
from tidemark.recipes import Pipeline, RecipeBook, Step, default_book, parse_pipeline, parse_recipe
from tidemark.sources.tables import TableStore, recorded, write_raw


def test_the_book_is_whole():
    book = default_book()
    assert len(book.recipes) == 65 and len(book.pipelines) == 24
    assert [r.recipe_id for r in book.recipes_for("ashare.daily")] == ["tushare.daily.to_ashare_daily"] and book.recipes_for("ashare.index_weights") == []
    r = book.require("tushare.hsgt_top10.to_ashare_hsgt_top10")
    assert r.fanout == {"market_type": ("1", "3")} and r.field_map == {"ts_code": "security_id"}
    assert sum(s.required for s in book.require_pipeline("ashare_core_eod_daily").steps) == 7
    for ask in (lambda: book.require("x"), lambda: book.require_pipeline("x"), lambda: book.add(r), lambda: book.add_pipeline(Pipeline("p", "d", "weekly", (Step("no"),)))):
        with pytest.raises(ContractError):
            ask()
    with pytest.raises(ContractError):
        RecipeBook([parse_recipe("a|nowhere|api|ashare.daily|s|1|||||")])
    for bad in ("a|cninfo|api|ashare.daily|s|1||k=1,2|5:2||", "a|cninfo|api|ashare.daily|s|1|||5:0||"):
        with pytest.raises(ValueError):
            parse_recipe(bad)
    assert parse_pipeline("p|d|weekly|a*,b|f").steps == (Step("a", True), Step("b"))


def test_plans_need_their_values():
    book = default_book()
    with pytest.raises(ValueError, match="partition.trade_date"):
        book.plan("ashare_core_eod_daily", {})
    [(no, step, recipe, requests)] = book.plan("ashare_share_pledge_weekly", {"end_date": "d"})
    assert (no, step.required, recipe.page_limit) == (0, False, 5000) and requests[2] == {"end_date": "d", "limit": 5000, "offset": 10000}


def test_replayed_answers(spark, tmp_path):
    s = "ts_code string, v int"
    one, two = (spark.createDataFrame([(c, i)], s) for i, c in enumerate("ab"))
    write_raw(one, str(tmp_path), "src", "api", {"market": "1"}, "t1", artifacts=spark.createDataFrame([("f.pdf", bytearray(b"abc"))], "name string, content binary"))
    path = write_raw(two, str(tmp_path), "src", "api", {"market": "3"}, "t2")
    rows = recorded(spark, str(tmp_path), "src", "api", s)
    recipe = ingest.Recipe("r", "ashare.daily", fanout={"market": ("1", "3", "7")}, api="api")
    got = ingest.fetch_rows(recipe, ingest.replay({"api": rows}), {"other": "x"})
    assert rows_of(got.select("ts_code", "market")) == [("a", "1"), ("b", "3")] and "_request" not in got.columns
    with pytest.raises(LookupError):
        ingest.replay({})("api", {})
    assert spark.read.json(path).count() == 1
    [kept] = spark.read.parquet(f"{tmp_path}/raw/src/api/*/_artifacts").collect()
    assert kept.bytes == 3 and kept.sha256.startswith("ba7816bf")


def test_pages_and_columns_of_parts(spark):
    recipe = ingest.Recipe("r", "ashare.daily", page_limit=2, max_pages=3, api="api")
    rows = spark.createDataFrame([(i, str(i)) for i in range(9)], "_at int, k string")
    assert ingest.fetch_rows(recipe, ingest.replay({"api": rows}, position="_at"), {}).count() == 6
    assert ingest.fetch_rows(recipe, ingest.replay({"api": rows.limit(0)}, position="_at"), {}).count() == 0
    parts = {"1": spark.createDataFrame([(1,)], "a int"), "2": spark.createDataFrame([("x", "own")], "b string, market string")}
    got = ingest.fetch_rows(ingest.Recipe("r", "d", fanout={"market": ("1", "2")}), lambda api, p: parts[p["market"]], {})
    assert rows_of(got.select("a", "b", "market")) == [(None, "x", "own"), (1, None, "1")]


def test_pipelines_stop_at_required_steps(spark):
    steps = [(i, Step(n, n == "b"), ingest.Recipe(n, "d")) for i, n in enumerate("abc")]

    def run(recipe):
        if recipe.recipe_id in broken:
            raise RuntimeError("gone\nfor good")
        return 7

    broken = {"a", "c"}
    out = ingest.run_pipeline(spark, steps, run, continue_on_error=True).collect()
    assert [(r.status, r.rows, r.error) for r in out] == [("failed", None, "gone"), ("ready", 7, ""), ("failed", None, "gone")]
    with pytest.raises(RuntimeError):
        ingest.run_pipeline(spark, steps, run)
    broken = {"b"}
    with pytest.raises(RuntimeError):
        ingest.run_pipeline(spark, steps, run, continue_on_error=True)


def test_first_answer(spark):
    def fail():
        raise OSError("down")

    none, some = spark.createDataFrame([], "a int"), spark.createDataFrame([(1,)], "a int")
    name, rows, tried = ingest.first_answer([("x", fail), ("y", lambda: none), ("z", lambda: some), ("w", fail)])
    assert name == "z" and rows.count() == 1 and tried == [("x", 0, "down"), ("y", 0, ""), ("z", 1, "")]
    assert ingest.first_answer([("y", lambda: none)])[0] == "y" and ingest.first_answer([("x", fail)])[:2] == ("", None) and ingest.first_answer([])[2] == []


def test_tasks(spark):
    pool = spark.createDataFrame([("a", 1), (" a ", 2), ("b", 3), (None, 4), (" ", 5)], "sid string, status int")
    there = spark.createDataFrame([("d1", "p", "a"), ("d1", "q", "b"), ("d1", "p", "a")], "dataset_id string, period string, sid string")
    ask = lambda **kw: rows_of(ingest.missing_tasks(pool, there, key="sid", datasets=["d1", "d2"], period="p", **kw).select("sid", "dataset_id", "status"))
    assert ask() == [("a", "d1", "skipped"), ("a", "d2", "todo"), ("b", "d1", "todo"), ("b", "d2", "todo")]
    assert {s for *_, s in ask(refresh=True)} == {"todo"} and ingest.missing_tasks(pool.limit(0), there, key="sid", datasets=["d1"], period="p").count() == 0


def held(spark, rows):
    return spark.createDataFrame(rows, "dataset_id string, partition map<string,string>, rows bigint, status string, published_at string")


def test_inventory_of_nothing_and_of_odd_rows(spark):
    contracts, recipes = default_registry().frame(spark), default_book().frame(spark)
    none = inventory.inventory_entries(held(spark, []), contracts, recipes)
    assert {(r.status, r.coverage) for r in none.collect()} == {("missing", "none")} and none.count() == 66
    rows = [
        ("ashare.daily", {"trade_date": "20260102"}, 5, "ok", ""), ("ashare.daily", {"trade_date": "20260105"}, 6, None, ""), ("no.such", {"x": "1"}, 1, "ok", ""),
        ("ashare.stock_basic", {"snapshot_date": "20260101"}, 3, "degraded", ""), ("ashare.income_statement", {"period": "20250930", "security_id": "s"}, 2, "ok", ""),
    ]
    at = lambda day: {r.dataset_id: r for r in inventory.inventory_entries(held(spark, rows), contracts, recipes, day).collect()}
    got = at("20260102")
    assert (got["ashare.daily"].status, got["ashare.daily"].coverage, got["ashare.daily"].active_rows) == ("ready", "full", 5)
    assert (got["ashare.stock_basic"].status, got["ashare.stock_basic"].coverage) == ("degraded", "latest_before")
    assert (got["ashare.income_statement"].coverage, got["ashare.income_statement"].active_partition) == ("partial", "period=20250930,security_id=s")
    assert at("20260105")["ashare.daily"].status == "missing"  # asked for, and its quality is unknown
    assert (at(None)["ashare.daily"].status, at(None)["ashare.daily"].coverage, at(None)["ashare.daily"].latest_rows) == ("ready", "latest", 6)
    assert at("20260103")["ashare.daily"].coverage == "none"  # exact contracts never fall back
    entries = inventory.inventory_entries(held(spark, rows), contracts, recipes, "20260102")
    plan = inventory.recovery_plan(entries, contracts, recipes, default_book().steps_frame(spark), limit=3).collect()
    assert len(plan) == 3 and plan[0].priority == 10
    every = inventory.recovery_plan(entries, contracts, recipes, default_book().steps_frame(spark), statuses=(), coverages=())
    assert every.count() == 66 and every.where("dataset_id = 'ashare.index_weights'").first().action == "manual"


def test_gates(spark):
    runs = spark.createDataFrame([("a", "20260103", None), ("b", "20260103", "not json"), ("c", "20260103", '{"as_of": "20260103", "data_gaps": "odd"}')], "run_id string, as_of string, output string")
    refs = spark.createDataFrame([("c", "mart", "t:trade_date=20260103"), ("c", "mart", "t:trade_date=20260103"), ("c", "feature", "t:as_of=20260101"), ("c", "relation", "r"), ("gone", "mart", "t:x=1"), ("c", "odd", "x")], "run_id string, kind string, ref string")
    known = spark.createDataFrame([("t",)], "name string")
    parts = spark.createDataFrame([("t", {"trade_date": "20260103"}, "ok")], "name string, partition map<string,string>, status string")
    ids = spark.createDataFrame([("r",), (None,)], "id string")
    resolved = gates.resolve_refs(refs, known, parts, ids, ids)
    assert sorted(r.status for r in resolved.where("run_id = 'c'").collect()) == ["missing", "ok", "ok", "ok"]
    got = {(r.run_id, r.gate): r.status for r in gates.run_gates(runs, resolved).collect()}
    assert len(got) == 15 and got["a", "output_gate"] == got["b", "output_gate"] == "not_evaluated" and got["a", "gap_gate"] == "warning"
    assert got["c", "freshness_gate"] == got["c", "data_refs_gate"] == "blocked" and got["c", "source_refs_gate"] == got["c", "gap_gate"] == "passed"
    assert {r.run_id: r.status for r in gates.run_status(gates.run_gates(runs, resolved)).collect()} == {"a": "degraded", "b": "degraded", "c": "blocked"}
    assert gates.run_gates(runs.limit(0), resolved).count() == 0


def test_dates(spark):
    df = spark.createDataFrame([("20260301", "2026-03-03"), ("20260303", "20260301"), ("odd", None)], "a string, b string")
    got = [r[0] for r in df.select(exprs.natural_dates(F.col("a"), F.col("b"))).collect()]
    assert got == [["20260301", "20260302", "20260303"], [], []]
    assert df.select(exprs.fetch_start(F.col("a"), 1)).first()[0] == "20260130"
    with pytest.raises(ValueError):
        exprs.fetch_start(F.col("a"), 0)


def test_search_words(spark):
    assert catalog.search_terms("") == [] and catalog.search_terms(" SEC ") == ["sec", "filings", "companyfacts", "ticker_cik"]
    assert catalog.search_terms("section") == ["section"] and "margin" in catalog.search_terms("看两融数据") and catalog.search_terms("a，b")[:3] == ["a", "b", "a，b"]
    df = spark.createDataFrame([("x.daily", "ready"), ("y.daily", "missing"), ("z", "ready")], "dataset_id string, status string")
    assert [tuple(r) for r in catalog.search_contracts(df, ["daily"]).collect()] == [("x.daily", 23, 1), ("y.daily", 20, 1)]


def test_snippets_stop_at_their_limit(spark):
    t = spark.createDataFrame([(2, None, "aa aaa"), (1, "ok", "xAax" * 3)], "announcement_id int, parse_status string, text string")
    got = textsearch.snippets(t, "aa", context=0, limit=4, order=["announcement_id"]).select("announcement_id", "match_start").collect()
    assert [tuple(r) for r in got] == [(1, 1), (1, 5), (1, 9), (2, 0)]


def test_newest_first(spark):
    df = spark.createDataFrame([("a", "20260101", 5), ("b", "20260102", None), ("c", None, 9)], "announcement_id string, publish_date string, t bigint")
    assert [r[0] for r in textsearch.newest_first(df).collect()] == ["b", "a", "c"]
    assert [r[0] for r in textsearch.newest_first(df, 2, instant="t").collect()] == ["c", "a"]


def test_contracts_know_their_words():
    for bad in ("t.x|no_role|d|d|v||eod,final,post_close,exact|forbid_empty|context|", "t.x|core_fact|d|d|v||eod,final,whenever,exact|forbid_empty|context|", "t.x|core_fact|d|d|v||eod,final,post_close,exact|forbid_empty|anything|"):
        with pytest.raises(ContractError):
            parse_contract(bad)
    assert parse_contract("t.x|core_fact|d|d|v||eod,revised,post_close,exact|forbid_empty|context|").temporal.finality == "revised"
    default_registry().check_dependencies({"f": ("ashare.daily",)})
    with pytest.raises(ContractError):
        default_registry().check_dependencies({"f": ("ashare.daily", "no.such")})


def test_publishing_checks_what_it_writes(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), registry=Registry([parse_contract("t.x|core_fact|d|d,k|v|v|eod,final,post_close,exact|forbid_empty|context|")]))
    frame = lambda d, *more: spark.createDataFrame([(d, "a", 1.0, *more)], "d string, k string, v double" + ", w int" * len(more))
    store.publish("t.x", frame("1"), {"d": "1"})
    store.publish("t.x", frame("2", 5), {"d": "2"})
    assert rows_of(store.scan("t.x").select("d", "w")) == [("1", None), ("2", 5)]
    with pytest.raises(ContractError):
        store.publish("t.x", frame("9"), {"d": "3"})
    assert rows_of(store.partitions("t.x")) == [("1",), ("2",)] and not list((tmp_path / "mart/_staged").iterdir())
    store.publish("t.x", frame("3").withColumn("v", F.lit("text")), {"d": "3"})
    with pytest.raises(ContractError, match="column v"):
        store.scan("t.x")


def test_clusters_must_name_a_shared_folder():
    from tidemark.session import shared_dir

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_payloads_of_vendors(spark):
    from tidemark.sources import parsers

    df = lambda *bodies: spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "n int, body string")
    assert parsers.industry_reports(df(None, "junk", "{}", '{"data": []}', '{"data": null}'), "body").count() == 0
    [r] = parsers.industry_reports(df('{"data": [{"infoCode": "", "title": null}]}'), "body").collect()
    assert (r.report_id, r.title, r.source_url) == ("", "", "https://data.eastmoney.com/report/")
    q = parsers.listed_quotes(df('{"data": {"diff": {"0": {"f12": "600001", "f2": "-"}, "1": {"f12": "odd", "f2": 3}}}}', '{"data": null}', None), "body", snapshot_at="s").collect()
    assert sorted((r.security_id, r.price) for r in q) == [("600001.SH", None), ("odd", 3.0)]
    pages = df(
        '{"announcements": [{"secCode": "600001", "announcementId": 5, "announcementTime": 1767225600000}, {"secCode": "000001", "announcementId": "5"}, {"secCode": "x", "announcementId": "6"}]}',
        '{"announcements": [{"secCode": "300001", "announcementId": ""}, {"secCode": "300001", "announcementId": null, "announcementTime": "odd"}, {"secCode": "000002", "announcementId": "5"}]}', "junk", None,
    )
    got = parsers.announcement_pages(pages, "body", ["n"]).collect()
    assert sorted((r.announcement_id, r.security_id, r.publish_date) for r in got) == [("", "300001.SZ", ""), ("", "300001.SZ", ""), ("5", "600001.SH", "20260101")]


def test_runs_without_much(spark, tmp_path):
    from tidemark.operators import runs

    made = spark.createDataFrame([("？？", "20260101", "t", None), ("A b!", "20260101", "t", "own-id")], "question string, as_of string, created_at string, run_id string")
    runs.record_runs(made, str(tmp_path / "r"))
    back = runs.replay_runs(spark, str(tmp_path / "r"))
    ids = sorted(r.run_id for r in back.collect())
    assert ids[0].startswith("20260101-run-") and ids[1] == "own-id" and runs.run_refs(back).count() == 0


def test_lookback(spark):
    a = spark.createDataFrame([("20260101", "t"), ("20260102", "t"), (None, "t")], "publish_date string, title string")
    assert rows_of(textsearch.announcement_search(a, last_day="20260102", lookback=1).select("publish_date")) == [("20260102",)]
    with pytest.raises(ValueError):
        textsearch.announcement_search(a, lookback=2)
