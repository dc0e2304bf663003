"""Queries of recipes, pipelines, inventory, maintenance tasks and run gates over the test tables, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import DATE_KEYS, default_registry
from tidemark.functions.exprs import fetch_start
from tidemark.operators import evidence, gates, ingest, inventory, windows
from tidemark.recipes import SOURCES, default_book
from tidemark.session import load, scratch_path
from tidemark.sources.tables import TableStore

AS_OF = "20260103"
PIPELINES = ("ashare_core_eod_daily", "ashare_corporate_action_events_daily", "ashare_membership_weekly")
PARTITION = {"trade_date": "20260105", "ann_date": "20260105", "snapshot_date": "20260105"}


def quoted(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def recipe_plan(spark: SparkSession, root: str) -> DataFrame:
    """What three pipelines would ask their sources for on a day: one row per request, nothing fetched."""
    plans = [default_book().plan_frame(spark, p, PARTITION).withColumn("pipeline_id", F.lit(p)) for p in PIPELINES]
    asked = F.array_join(F.array_sort(F.transform(F.map_entries("request"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return reduce(DataFrame.unionByName, plans).select("pipeline_id", "step_no", "recipe_id", "required", "source_id", "api", "dataset_id", "request_no", asked.alias("request"))


_STEP_ROWS = ", ".join(f"({quoted(p.pipeline_id)}, {i}, {quoted(s.recipe_id)}, {s.required})" for p in default_book().pipelines.values() for i, s in enumerate(p.steps))
_RECIPE_ROWS = ", ".join(
    "({})".format(", ".join([*map(quoted, (r.recipe_id, r.source_id, r.api, r.dataset_id, r.schedule)), str(r.priority), quoted(";".join(f"{k}={v}" for k, v in r.params.items())), quoted(next(iter(r.fanout), None)), quoted(",".join(next(iter(r.fanout.values()), ()))), str(r.page_limit), str(r.max_pages)]))
    for r in default_book().recipes.values()
)
_RECIPES = f"""s(pipeline_id, step_no, recipe_id, required) AS (VALUES {_STEP_ROWS}),
r(recipe_id, source_id, api, dataset_id, schedule, priority, params, fan_key, fan_values, page_limit, max_pages) AS (VALUES {_RECIPE_ROWS})"""
_FILLED = reduce(lambda sql, kv: f"replace({sql}, '${{partition.{kv[0]}}}', '{kv[1]}')", PARTITION.items(), "params")
PLAN_SQL = f"""WITH {_RECIPES},
j AS (SELECT s.*, r.* EXCLUDE (recipe_id), list_filter(string_split({_FILLED}, ';'), lambda x: x <> '') AS base,
  CASE WHEN fan_key IS NOT NULL THEN list_transform(string_split(fan_values, ','), lambda v: [fan_key || '=' || v])
       WHEN page_limit > 0 THEN list_transform(range(max_pages), lambda k: ['limit=' || page_limit, 'offset=' || (k * page_limit)]) ELSE [CAST([] AS VARCHAR[])] END AS children
  FROM s JOIN r ON s.recipe_id = r.recipe_id WHERE pipeline_id IN ({", ".join(map(quoted, PIPELINES))})),
c AS (SELECT *, unnest(range(len(children))) AS request_no FROM j)
SELECT pipeline_id, step_no, recipe_id, required, source_id, api, dataset_id, request_no, array_to_string(list_sort(list_concat(base, children[request_no + 1])), ';') AS request FROM c"""


def fanout_union(spark: SparkSession, root: str) -> DataFrame:
    """A recipe that asks once per market, over recorded answers: one union, the market stamped on."""
    o = load(spark, root, "orders")
    answers = o.select(F.col("o_custkey").cast("string").alias("ts_code"), F.date_format("o_orderdate", "yyyyMMdd").alias("trade_date"), F.col("o_totalprice").alias("amount"), F.create_map(F.lit("market_type"), (F.col("o_orderkey") % 4).cast("string")).alias("_request"))
    recipe = default_book().require("tushare.hsgt_top10.to_ashare_hsgt_top10")
    rows = ingest.fetch_rows(recipe, ingest.replay({recipe.api: answers}), {"trade_date": "any"})
    return ingest.transform(rows, field_map=recipe.field_map, partition={}, numeric=recipe.numeric_columns)


FANOUT_SQL = " UNION ALL ".join(f"SELECT CAST(o_custkey AS VARCHAR) AS security_id, strftime(o_orderdate, '%Y%m%d') AS trade_date, o_totalprice AS amount, '{m}' AS market_type FROM orders WHERE o_orderkey % 4 = {m}" for m in (1, 3))


def paginated_union(spark: SparkSession, root: str) -> DataFrame:
    """A recipe that asks page by page (three pages of 5,000 at most, as the recipe says), over recorded answers."""
    e = load(spark, root, "events")
    recipe = default_book().require("tushare.margin_detail.to_ashare_margin_detail")
    answers = e.select(F.col("event_id").alias("_at"), F.col("user_id").cast("string").alias("ts_code"), F.col("value").alias("rzye"))
    return ingest.transform(ingest.fetch_rows(recipe, ingest.replay({recipe.api: answers}, position="_at"), {}), field_map=recipe.field_map, partition={}, numeric=recipe.numeric_columns)


PAGES_SQL = "SELECT CAST(user_id AS VARCHAR) AS security_id, value AS rzye FROM events WHERE event_id >= 0 AND event_id < 15000"


def pipeline_status(spark: SparkSession, root: str) -> DataFrame:
    """A pipeline run over recorded answers into a staging and a mart store: the required step succeeds, an optional one has no answer."""
    c = load(spark, root, "customer")
    text = lambda name: F.lit(name)
    members = c.select(F.col("c_custkey").cast("string").alias("ts_code"), F.col("c_name").alias("name"), *[F.col("c_mktsegment").alias(x) for x in ("l1_code", "l1_name", "l2_code", "l2_name", "l3_code", "l3_name")], text("20250101").alias("in_date"), text("Y").alias("is_new"))
    n = load(spark, root, "nation")
    classes = n.select(F.concat(F.lit("i"), F.col("n_nationkey").cast("string")).alias("index_code"), F.col("n_name").alias("industry_name"), text("L1").alias("level"), F.col("n_nationkey").cast("string").alias("industry_code"), F.col("n_regionkey").cast("string").alias("parent_code"))
    fetch = ingest.replay({"index_classify": classes.withColumn("src", text("SW2021")), "index_member_all": members.withColumn("_at", F.col("ts_code").cast("bigint"))}, position="_at")
    base = scratch_path(spark, "pipeline")
    stores = [TableStore(spark, base, layer) for layer in ("staging", "mart")]
    partition = {"snapshot_date": "20260105"}
    book = default_book()

    def run(recipe: ingest.Recipe) -> int:
        return ingest.ingest_recipe(recipe, fetch, stores=stores, keys=book.registry.require(recipe.dataset_id).primary_key, partition=partition)

    steps = [(no, step, recipe) for no, step, recipe, _ in book.plan("ashare_membership_weekly", partition)]
    return ingest.run_pipeline(spark, steps, run, continue_on_error=True).select("step_no", "recipe_id", "dataset_id", "required", "status", "rows")


PIPELINE_SQL = """SELECT 0 AS step_no, 'tushare.index_classify.to_ashare_sw_industry_classification' AS recipe_id, 'ashare.sw_industry_classification' AS dataset_id, FALSE AS required, 'ready' AS status, count(*) AS rows FROM nation
UNION ALL SELECT 1, 'tushare.index_member_all.to_ashare_industry_members', 'ashare.industry_members', TRUE, 'ready', count(*) FILTER (c_custkey < 30000) FROM customer
UNION ALL SELECT 2, 'tushare.ci_index_member.to_ashare_ci_industry_members', 'ashare.ci_industry_members', FALSE, 'failed', NULL"""


def held_partitions(spark: SparkSession, root: str) -> DataFrame:
    """Partition metadata as stores of the test tables would have it."""
    part = lambda **kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)]).alias("partition")
    status = lambda c: F.when(F.substring(c, -1, 1) == "7", "degraded").when(F.substring(c, -1, 1) == "8", "").otherwise("ok")
    a = load(spark, root, "announcements").where(F.col("publish_date").isNotNull()).groupBy("publish_date").count()
    m = load(spark, root, "daily_momentum").groupBy("as_of").count()
    r = load(spark, root, "relation_snapshots").where(F.col("snapshot_date").isNotNull()).groupBy("snapshot_date").count()
    s = load(spark, root, "daily_momentum").where(F.col("security_id").isNotNull()).groupBy("security_id").count()
    row = lambda df, dataset, p, key: df.select(F.lit(dataset).alias("dataset_id"), p, F.col("count").alias("rows"), status(F.col(key)).alias("status"), F.lit("").alias("published_at"))
    return reduce(
        DataFrame.unionByName,
        [
            row(a, "ashare.announcements", part(publish_date=F.col("publish_date")), "publish_date"),
            row(m, "ashare.daily", part(trade_date=F.col("as_of")), "as_of"),
            row(r, "ashare.stock_basic", part(snapshot_date=F.col("snapshot_date")), "snapshot_date"),
            row(s, "ashare.income_statement", part(period=F.lit("20250930"), security_id=F.col("security_id")), "security_id"),
        ],
    )


def inventory_entries(spark: SparkSession, root: str) -> DataFrame:
    out = inventory.inventory_entries(held_partitions(spark, root), default_registry().frame(spark), default_book().frame(spark), AS_OF)
    return out.withColumns({"recipes": F.array_join("recipes", ","), "source_ids": F.array_join("source_ids", ",")})


def _contract_row(c) -> str:
    key = "period" if c.temporal.temporal_mode == "filing" and "period" in c.partition_keys else next((k for k in c.partition_keys if k in DATE_KEYS), None)
    exposes = c.usage.permits("company_business_exposure")
    return f"({quoted(c.dataset_id)}, {quoted(c.domain)}, {quoted(c.role)}, {len(c.partition_keys)}, {quoted(c.temporal.as_of_policy)}, {quoted(key)}, {quoted({'period': '20250930', None: None}.get(key, AS_OF))}, {exposes})"


_ENTRIES = f"""{_RECIPES},
c(dataset_id, domain, role, n_keys, pol, request_key, request_value, exposes) AS (VALUES {", ".join(map(_contract_row, default_registry()))}),
p AS (
  SELECT 'ashare.announcements' AS dataset_id, publish_date AS v, 'publish_date=' || publish_date AS part, publish_date AS o, publish_date AS k, count(*) AS n FROM announcements WHERE publish_date IS NOT NULL GROUP BY publish_date
  UNION ALL SELECT 'ashare.daily', as_of, 'trade_date=' || as_of, as_of, as_of, count(*) FROM daily_momentum GROUP BY as_of
  UNION ALL SELECT 'ashare.stock_basic', snapshot_date, 'snapshot_date=' || snapshot_date, snapshot_date, snapshot_date, count(*) FROM relation_snapshots WHERE snapshot_date IS NOT NULL GROUP BY snapshot_date
  UNION ALL SELECT 'ashare.income_statement', '20250930', 'period=20250930,security_id=' || security_id, '20250930' || chr(1) || security_id, security_id, count(*) FROM daily_momentum WHERE security_id IS NOT NULL GROUP BY security_id),
q AS (SELECT p.*, CASE WHEN k LIKE '%7' THEN 'degraded' WHEN k LIKE '%8' THEN '' ELSE 'ok' END AS st, c.request_value, c.pol, c.n_keys FROM p JOIN c USING (dataset_id)),
g AS (SELECT dataset_id, count(*) AS partitions, sum(n) AS rows_total, count(*) FILTER (v = request_value) AS matched,
  max_by({{'part': part, 'n': n, 'st': st}}, o) AS l, max_by({{'part': part, 'n': n, 'st': st}}, o) FILTER (v = request_value) AS m, max_by({{'part': part, 'n': n, 'st': st}}, o) FILTER (pol = 'latest_before' AND n_keys = 1 AND v <= request_value) AS b FROM q GROUP BY 1),
w AS (SELECT dataset_id, string_agg(DISTINCT recipe_id, ',' ORDER BY recipe_id) AS recipes, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS source_ids FROM r GROUP BY 1),
a AS (SELECT c.*, g.* EXCLUDE (dataset_id), w.* EXCLUDE (dataset_id), CASE WHEN request_key IS NULL THEN l ELSE coalesce(m, b) END AS act FROM c LEFT JOIN g USING (dataset_id) LEFT JOIN w USING (dataset_id)),
e AS (SELECT dataset_id, domain, role, exposes,
  CASE WHEN act IS NULL THEN 'missing' WHEN act.st = 'ok' THEN 'ready' WHEN act.st <> '' THEN 'degraded' WHEN request_key IS NULL THEN 'ready' ELSE 'missing' END AS status,
  CASE WHEN request_key IS NULL THEN CASE WHEN act IS NULL THEN 'none' ELSE 'latest' END WHEN matched > 0 AND n_keys > 1 THEN 'partial' WHEN matched > 0 THEN 'full' WHEN act IS NOT NULL THEN 'latest_before' ELSE 'none' END AS coverage,
  request_key, CASE WHEN request_key IS NOT NULL THEN request_value END AS request_value, coalesce(matched, 0) AS matched, coalesce(partitions, 0) AS partitions, CAST(coalesce(rows_total, 0) AS BIGINT) AS rows_total,
  coalesce(act.part, '') AS active_partition, coalesce(act.n, 0) AS active_rows, coalesce(act.st, '') AS active_quality, coalesce(l.part, '') AS latest_partition, coalesce(l.n, 0) AS latest_rows, coalesce(l.st, '') AS latest_quality,
  coalesce(recipes, '') AS recipes, coalesce(source_ids, '') AS source_ids FROM a)"""
ENTRIES_SQL = f"WITH {_ENTRIES} SELECT * EXCLUDE (exposes) FROM e"


def inventory_summary(spark: SparkSession, root: str) -> DataFrame:
    entries = inventory.inventory_entries(held_partitions(spark, root), default_registry().frame(spark), default_book().frame(spark), AS_OF)
    return inventory.inventory_summary(entries)


SUMMARY_SQL = f"""WITH {_ENTRIES}, u AS (SELECT 'status' AS kind, status AS value, partitions, rows_total FROM e UNION ALL SELECT 'coverage', coverage, partitions, rows_total FROM e)
SELECT kind, value, count(*) AS datasets, CAST(sum(partitions) AS BIGINT) AS partitions, CAST(sum(rows_total) AS BIGINT) AS rows_total FROM u GROUP BY 1, 2"""


def recovery_plan(spark: SparkSession, root: str) -> DataFrame:
    contracts, recipes = default_registry().frame(spark), default_book().frame(spark)
    entries = inventory.inventory_entries(held_partitions(spark, root), contracts, recipes, AS_OF)
    return inventory.recovery_plan(entries, contracts, recipes, default_book().steps_frame(spark))


RECOVERY_SQL = f"""WITH {_ENTRIES}, f AS (SELECT dataset_id, arg_min(recipe_id, lpad(CAST(priority AS VARCHAR), 6, '0') || recipe_id) AS recipe_id FROM r GROUP BY 1),
t AS (SELECT recipe_id, min(pipeline_id) AS pipeline_id FROM s GROUP BY 1)
SELECT dataset_id, status, coverage, CASE WHEN role = 'core_fact' THEN 10 WHEN exposes THEN 20 WHEN role = 'evidence_seed' THEN 30 WHEN status = 'degraded' THEN 40 ELSE 50 END AS priority,
  CASE WHEN pipeline_id IS NOT NULL THEN 'pipeline' WHEN f.recipe_id IS NOT NULL THEN 'recipe' ELSE 'manual' END AS action, f.recipe_id, pipeline_id, coalesce(request_key || '=' || request_value, '') AS partition
FROM e LEFT JOIN f USING (dataset_id) LEFT JOIN t ON f.recipe_id = t.recipe_id WHERE status IN ('missing', 'degraded') OR coverage IN ('none', 'partial')"""


def source_map(spark: SparkSession, root: str) -> DataFrame:
    book = default_book()
    entries = inventory.inventory_entries(held_partitions(spark, root), default_registry().frame(spark), book.frame(spark), AS_OF)
    return inventory.source_map(book.sources_frame(spark), book.frame(spark), entries, book.steps_frame(spark))


_SOURCE_ROWS = ", ".join(f"({quoted(k)}, {quoted(v[0])}, {quoted(v[1])}, {quoted(v[2])})" for k, v in SOURCES.items())
SOURCES_SQL = f"""WITH {_ENTRIES}, z(source_id, source_role, tier, transport) AS (VALUES {_SOURCE_ROWS})
SELECT source_id, source_role, tier, transport, count(DISTINCT r.recipe_id) AS recipes, count(DISTINCT r.dataset_id) AS datasets, count(DISTINCT s.pipeline_id) AS pipelines, count(DISTINCT r.dataset_id) FILTER (e.status = 'ready') AS ready_datasets
FROM z LEFT JOIN r USING (source_id) LEFT JOIN e ON r.dataset_id = e.dataset_id LEFT JOIN s ON s.recipe_id = r.recipe_id GROUP BY 1, 2, 3, 4"""


def feature_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Features with a partition, made of the momentum rows, and the state of what they are built from."""
    m = load(spark, root, "daily_momentum").groupBy("as_of", F.col("window_days").alias("window")).agg(F.count_if(F.col("momentum_score").isNull()).alias("bad"))
    metas = m.select(F.lit("ashare.daily_momentum").alias("feature_id"), "as_of", "window", F.when(F.col("bad") > 0, "degraded").otherwise("ok").alias("status"))
    metas = metas.unionByName(metas.where("window = 20").withColumns({"feature_id": F.lit("ashare.market_strength"), "status": F.lit("ok")}))
    entries = inventory.inventory_entries(held_partitions(spark, root), default_registry().frame(spark), default_book().frame(spark)).select("dataset_id", F.col("status").alias("input_status"))
    needs = spark.createDataFrame([("ashare.daily_momentum", "ashare.daily"), ("ashare.market_strength", "ashare.index_daily"), ("ashare.limit_sentiment", "ashare.limit_list_d")], "feature_id string, dataset_id string")
    return inventory.feature_entries(metas, needs.join(entries, "dataset_id"))


FEATURES_SQL = """WITH m AS (SELECT as_of, window_days AS w, CASE WHEN count(*) FILTER (momentum_score IS NULL) > 0 THEN 'degraded' ELSE 'ok' END AS st FROM daily_momentum GROUP BY 1, 2),
d AS (SELECT max(as_of) AS d FROM daily_momentum),
f AS (SELECT 'ashare.daily_momentum' AS feature_id, as_of, w, st FROM m UNION ALL SELECT 'ashare.market_strength', as_of, w, 'ok' FROM m WHERE w = 20),
g AS (SELECT feature_id, count(*) AS partitions, max_by({'a': as_of, 'w': w, 'st': st}, as_of || lpad(CAST(w AS VARCHAR), 6, '0')) AS l FROM f GROUP BY 1),
n(feature_id, ready) AS (SELECT 'ashare.daily_momentum', (SELECT d NOT LIKE '%7' FROM d) UNION ALL SELECT 'ashare.market_strength', FALSE UNION ALL SELECT 'ashare.limit_sentiment', FALSE)
SELECT n.feature_id, coalesce(partitions, 0) AS partitions, l.a AS latest_as_of, l.w AS latest_window, CASE WHEN l IS NULL THEN 'missing' WHEN l.st = 'ok' AND ready THEN 'ready' ELSE 'degraded' END AS status FROM n LEFT JOIN g USING (feature_id)"""


def contract_coverage(spark: SparkSession, root: str) -> DataFrame:
    """How far every contract's partitions cover the five days up to a day."""
    return windows.contract_coverage(default_registry().frame(spark), held_partitions(spark, root), load(spark, root, "trade_calendar"), AS_OF, 5)


_KEY_ROWS = ", ".join(f"({quoted(c.dataset_id)}, {quoted(c.window_key())})" for c in default_registry())
CONTRACT_COVERAGE_SQL = f"""WITH c(dataset_id, k) AS (VALUES {_KEY_ROWS}),
p AS (SELECT 'ashare.announcements' AS dataset_id, publish_date AS d FROM announcements WHERE publish_date IS NOT NULL UNION SELECT 'ashare.daily', as_of FROM daily_momentum UNION SELECT 'ashare.stock_basic', snapshot_date FROM relation_snapshots WHERE snapshot_date IS NOT NULL),
o AS (SELECT DISTINCT cal_date AS d FROM trade_calendar WHERE exchange = 'SSE' AND is_open = '1' AND cal_date <= '{AS_OF}' ORDER BY 1 DESC LIMIT 5),
s AS (SELECT 'ashare.daily' AS dataset_id, CAST(count(p.d) AS INT) AS available, coalesce(list(o.d ORDER BY o.d) FILTER (p.d IS NULL), []) AS missing, min(o.d) AS first_day, max(o.d) AS last_day, coalesce(bool_or(p.d LIKE '%7'), FALSE) AS bad, count(o.d) < 5 OR count(p.d) < count(o.d) AS short
  FROM o LEFT JOIN p ON p.dataset_id = 'ashare.daily' AND p.d = o.d),
a AS (SELECT dataset_id, CAST(count(*) AS INT) AS available, CAST([] AS VARCHAR[]) AS missing, min(d) AS first_day, max(d) AS last_day, bool_or(d LIKE '%7') AS bad, count(*) < 5 AS short
  FROM (SELECT * FROM p WHERE d <= '{AS_OF}' AND dataset_id <> 'ashare.daily' QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY d DESC) <= 5) GROUP BY 1),
u AS (SELECT *, CASE WHEN available = 0 THEN 'missing' WHEN short THEN 'partial_window' WHEN bad THEN 'degraded_input' ELSE 'ok' END AS status FROM (SELECT * FROM s UNION ALL SELECT * FROM a))
SELECT c.dataset_id, k AS partition_key, CASE WHEN k = 'trade_date' THEN 'strict_trade_calendar' ELSE 'not_applicable' END AS calendar, 5 AS required_window, coalesce(available, 0) AS available, coalesce(missing, []) AS missing, first_day, last_day, coalesce(status, 'missing') AS status,
  CASE WHEN k IS NULL THEN 'no key to read windows by' WHEN coalesce(status, 'missing') = 'missing' THEN 'no partition in the window' WHEN status = 'partial_window' THEN 'partitions are missing in the window' WHEN status = 'degraded_input' THEN 'a partition is degraded' ELSE '' END AS reason
FROM c LEFT JOIN u USING (dataset_id)"""


def maintain_tasks(spark: SparkSession, root: str) -> DataFrame:
    """Which statements of a period are still to be fetched for every security."""
    there = load(spark, root, "announcements").select("security_id", F.lit("ashare.dividend").alias("dataset_id"), F.lit("20250930").alias("period"))
    pool = load(spark, root, "daily_momentum")
    return ingest.missing_tasks(pool, there, key="security_id", datasets=["ashare.income_statement", "ashare.cash_flow", "ashare.dividend"], period="20250930")


TASKS_SQL = """WITH p AS (SELECT DISTINCT trim(security_id) AS security_id FROM daily_momentum WHERE trim(coalesce(security_id, '')) <> '')
SELECT security_id, d.dataset_id, '20250930' AS period, CASE WHEN d.dataset_id = 'ashare.dividend' AND security_id IN (SELECT security_id FROM announcements WHERE security_id IS NOT NULL) THEN 'skipped' ELSE 'todo' END AS status
FROM p, (SELECT unnest(['ashare.income_statement', 'ashare.cash_flow', 'ashare.dividend']) AS dataset_id) d"""


def calendar_start(spark: SparkSession, root: str) -> DataFrame:
    """The first day of a calendar to fetch for a number of trading days, for every day."""
    days = load(spark, root, "trade_calendar").select("cal_date").distinct()
    return days.select("cal_date", fetch_start(F.col("cal_date"), 5).alias("for_5"), fetch_start(F.col("cal_date"), 60).alias("for_60"))


START_SQL = """SELECT DISTINCT cal_date, strftime(strptime(cal_date, '%Y%m%d') - INTERVAL 34 DAY, '%Y%m%d') AS for_5, strftime(strptime(cal_date, '%Y%m%d') - INTERVAL 179 DAY, '%Y%m%d') AS for_60 FROM trade_calendar"""


def recorded_runs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """A run per batch of evidence, and what each refers to."""
    e = load(spark, root, "evidence_records")
    n = F.col("batch_no")
    output = F.when(n % 6 == 0, None).when(n % 6 == 1, '{"as_of": "20260104"}').when(n % 6 == 2, '{"as_of": "20260103", "data_gaps": [{"impact": "block"}, {"impact": "degrade"}]}').when(n % 6 == 3, '{"data_gaps": [{"impact": "degrade"}]}').otherwise('{"as_of": "20260103"}')
    runs = e.select("batch_no").where(n.isNotNull()).distinct().select(F.concat(F.lit("run-"), n).alias("run_id"), F.lit(AS_OF).alias("as_of"), output.alias("output"))
    run = F.concat(F.lit("run-"), n).alias("run_id")
    cited = e.where(F.col("evidence_id").isNotNull()).select(run, F.lit("evidence").alias("kind"), F.when((n == 5) & (F.col("record_no") % 3 == 0), F.concat("evidence_id", F.lit("?"))).otherwise(F.col("evidence_id")).alias("ref"))
    marts = F.array(
        F.when(n % 5 != 4, F.lit("ashare.daily:trade_date=20260103")), F.when(n % 4 == 1, F.lit("ashare.daily:trade_date=20260102")), F.when(n % 7 == 2, F.lit("no.such:trade_date=20260103")), F.when(n % 7 == 3, F.lit("ashare.daily")), F.when(n % 8 == 6, F.lit("ashare.adj_factor:trade_date=20260103"))
    )
    data = e.select("batch_no").where(n.isNotNull()).distinct().select(run, F.lit("mart").alias("kind"), F.explode(marts).alias("ref")).where(F.col("ref").isNotNull())
    return runs, cited.unionByName(data)


def _resolved(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    runs, refs = recorded_runs(spark, root)
    day = lambda d, s: F.struct(F.lit("ashare.daily").alias("name"), F.create_map(F.lit("trade_date"), F.lit(d)).alias("partition"), F.lit(s).alias("status"))
    held = load(spark, root, "region").limit(1).select(F.explode(F.array(day("20260103", "ok"), day("20260102", "degraded"))).alias("p")).select("p.*")
    known = default_registry().frame(spark).select(F.col("dataset_id").alias("name"))
    ids = load(spark, root, "evidence_records").select(F.col("evidence_id").alias("id"))
    return runs, gates.resolve_refs(refs, known, held, ids, load(spark, root, "relation_snapshots").select(F.col("relation_id").alias("id")))


def run_gates(spark: SparkSession, root: str) -> DataFrame:
    return gates.run_gates(*_resolved(spark, root))


def run_status(spark: SparkSession, root: str) -> DataFrame:
    return gates.run_status(run_gates(spark, root))


_GATES = """WITH n AS (SELECT DISTINCT batch_no AS n FROM evidence_records WHERE batch_no IS NOT NULL),
u AS (SELECT batch_no AS n, count(*) FILTER (batch_no = 5 AND record_no % 3 = 0) AS unknown FROM evidence_records WHERE evidence_id IS NOT NULL GROUP BY 1),
x AS (SELECT n.n, coalesce(unknown, 0) AS unknown, n.n % 6 AS o, CAST(n.n % 5 <> 4 AS INT) + CAST(n.n % 4 = 1 AS INT) + CAST(n.n % 7 = 2 AS INT) + CAST(n.n % 7 = 3 AS INT) + CAST(n.n % 8 = 6 AS INT) AS data,
  CAST(n.n % 4 = 1 AS INT) AS stale, CAST(n.n % 7 = 2 AS INT) + CAST(n.n % 7 = 3 AS INT) + CAST(n.n % 8 = 6 AS INT) AS unusable, CAST(n.n % 4 = 1 AS INT) AS worse FROM n LEFT JOIN u ON n.n = u.n),
g AS (
  SELECT n, 'output_gate' AS gate, CASE WHEN o = 0 THEN 'not_evaluated' WHEN o = 1 THEN 'blocked' ELSE 'passed' END AS status, CAST(o = 1 AS INT) AS items FROM x
  UNION ALL SELECT n, 'freshness_gate', CASE WHEN stale > 0 THEN 'blocked' ELSE 'passed' END, stale FROM x
  UNION ALL SELECT n, 'data_refs_gate', CASE WHEN unusable > 0 THEN 'blocked' WHEN worse > 0 THEN 'warning' ELSE 'passed' END, CASE WHEN unusable > 0 THEN unusable ELSE worse END FROM x
  UNION ALL SELECT n, 'source_refs_gate', CASE WHEN unknown > 0 THEN 'blocked' ELSE 'passed' END, unknown FROM x
  UNION ALL SELECT n, 'gap_gate', CASE WHEN o = 2 THEN 'blocked' WHEN data = 0 THEN 'warning' WHEN o = 3 THEN 'degraded' ELSE 'passed' END, CASE WHEN o = 2 THEN 1 WHEN data = 0 THEN 0 WHEN o = 3 THEN 1 ELSE 0 END FROM x)"""
GATES_SQL = f"{_GATES} SELECT 'run-' || n AS run_id, gate, status, CAST(items AS BIGINT) AS items FROM g"
RUN_STATUS_SQL = f"{_GATES} SELECT 'run-' || n AS run_id, count(*) AS checks, CASE WHEN bool_or(status = 'blocked') THEN 'blocked' WHEN bool_or(status <> 'passed') THEN 'degraded' ELSE 'ok' END AS status FROM g GROUP BY 1"


# --- every claim form ---------------------------------------------------------------------------

CLAIM_COLUMNS = (
    "security_id", "period", "ann_date", "filing_date", "cik", "form", "accession_number", "source_url", "ticker", "title", "concept", "unit", "end_date", "filed_date", "entity_name", "label", "value", "report_id", "industry_name",
    "published_at", "source_name", "segment_type", "item_name", "sales", "currency", "holder_name", "holder_type", "in_de", "change_vol", "change_ratio", "avg_price", "process_status", "volume", "amount", "low_limit", "high_limit",
    "forecast_type", "p_change_min", "p_change_max", "net_profit_min", "net_profit_max", "last_parent_net", "forecast_summary", "change_reason", "total_revenue", "n_income", "total_assets", "total_liab", "n_cashflow_act", "eps",
    "revenue", "div_proc", "cash_div", "audit_result", "audit_agency", "pre_date", "actual_date",
)
CODES = {"segment_type": ("P", "D", "X"), "in_de": ("IN", "DE", "other")}


def evidence_claims(spark: SparkSession, root: str) -> DataFrame:
    """Claims of every dataset that has a form of its own, from rows with gaps in all columns."""
    n = F.col("p_partkey")

    def cell(i: int, c: str):
        full = F.get(F.array(*[F.lit(x) for x in CODES[c]]), (n % 3).cast("int")) if c in CODES else F.concat(F.lit(c + "-"), (n % 7).cast("string"))
        return F.when((n + i) % 11 == 0, "").otherwise(full).alias(c)

    rows = load(spark, root, "part").select(n.alias("row_no"), *[cell(i, c) for i, c in enumerate(CLAIM_COLUMNS)])
    out = [evidence.evidence_from(d, rows).select("dataset_id", "claim", "company", "metric", "value_json", "unit", "period", F.col("source_ref.published_at").alias("published_at")) for d in CLAIM_FORMS]
    return reduce(DataFrame.unionByName, out)


def _opt(name: str, before: str = "", after: str = "") -> str:
    return f"CASE WHEN {name} <> '' THEN {quoted(before)} || {name} || {quoted(after)} ELSE '' END"


def _listed(*names: str, none: str = "") -> str:
    parts = ", ".join(f"CASE WHEN {x} <> '' THEN '{x}=' || {x} END" for x in names)
    return f"coalesce(nullif(array_to_string(list_filter([{parts}], lambda x: x IS NOT NULL), ', '), ''), {quoted(none)})"


def _statement(topic: str, *names: str) -> tuple:
    claim = f"'Tushare {topic} reports ' || security_id || ' period ' || period || ': ' || {_listed(*names, none='no key metric populated')} || '.'"
    return ("security_id", "period"), claim, "security_id", "NULL", "NULL", "NULL", "period", "CASE WHEN ann_date <> '' THEN ann_date ELSE period END"


_ENTITY = "CASE WHEN entity_name <> '' THEN entity_name ELSE 'CIK ' || cik END"
# dataset -> columns it needs, claim, company, metric, value, unit, period, published_at, in SQL
CLAIM_FORMS: dict[str, tuple] = {
    "global.sec_filings": (("filing_date", "cik", "form", "accession_number", "source_url"), "'SEC EDGAR records CIK ' || cik || ' filing form ' || form || ' with accession ' || accession_number || '.'", "'CIK ' || cik", "NULL", "NULL", "NULL", "NULL", "filing_date"),
    "global.sec_ticker_cik": (("cik", "ticker", "title", "source_url"), "'SEC company tickers mapping lists ticker ' || ticker || ' for CIK ' || cik || ' (' || title || ').'", "title", "NULL", "NULL", "NULL", "NULL", "'on_demand'"),
    "global.sec_companyfacts": (
        ("cik", "concept", "unit", "end_date", "filed_date", "source_url"), f"'SEC companyfacts reports ' || {_ENTITY} || ' (' || cik || ') ' || CASE WHEN label <> '' THEN label ELSE concept END || '=' || value || ' ' || unit || ' for period ending ' || end_date || ', filed ' || filed_date || {_opt('form', ' on form ')} || '.'",
        _ENTITY, "concept", "nullif(value, '')", "unit", "end_date", "filed_date",
    ),
    "industry.eastmoney_report_index": (("report_id", "title", "source_url", "published_at"), "'Eastmoney report index lists industry report ''' || title || ''' for ' || CASE WHEN industry_name <> '' THEN industry_name ELSE 'unknown industry' END || '.'", "NULL", "NULL", "NULL", "NULL", "NULL", "published_at[1:10]"),
    "ashare.main_business": (
        ("security_id", "period", "segment_type", "item_name"), "'Tushare fina_mainbz reports ' || security_id || ' ' || period || ' ' || CASE segment_type WHEN 'P' THEN 'product' WHEN 'D' THEN 'district' ELSE segment_type END || ' segment ''' || item_name || ''' with sales ' || sales || ' ' || CASE WHEN currency <> '' THEN currency ELSE 'CNY' END || '.'",
        "security_id", "'sales'", "nullif(sales, '')", "CASE WHEN currency <> '' THEN currency ELSE 'CNY' END", "period", "period",
    ),
    "ashare.shareholder_trades": (
        ("ann_date", "security_id", "holder_name", "in_de"),
        f"'Tushare stk_holdertrade reports ' || security_id || ' shareholder ' || holder_name || {_opt('holder_type', ' (', ')')} || ' ' || CASE in_de WHEN 'IN' THEN 'increase' WHEN 'DE' THEN 'decrease' ELSE in_de END || ' event announced on ' || ann_date || ': change_vol=' || change_vol || ' shares' || {_opt('change_ratio', ', change_ratio=', '%')} || {_opt('avg_price', ', avg_price=', ' CNY/share')} || '.'",
        "security_id", "'change_vol'", "nullif(change_vol, '')", "'share'", "ann_date", "ann_date",
    ),
    "ashare.repurchase_events": (
        ("ann_date", "security_id", "process_status"),
        f"'Tushare repurchase reports ' || security_id || ' share repurchase event announced on ' || ann_date || ': process_status=' || process_status || {_opt('end_date', '; end_date=')} || {_opt('volume', ', volume=', ' shares')} || {_opt('amount', ', amount=', ' CNY')} || CASE WHEN low_limit <> '' OR high_limit <> '' THEN ', price_limit=' || low_limit || '-' || high_limit || ' CNY/share' ELSE '' END || '.'",
        "security_id", "'amount'", "nullif(amount, '')", "'cny'", "ann_date", "ann_date",
    ),
    "ashare.earnings_forecast_events": (
        ("ann_date", "security_id", "period", "forecast_type"),
        f"'Tushare forecast reports ' || security_id || ' earnings forecast event announced on ' || ann_date || ' for period ' || period || ': forecast_type=' || forecast_type || CASE WHEN {_listed('p_change_min', 'p_change_max', 'net_profit_min', 'net_profit_max', 'last_parent_net')} <> '' THEN '; ' || {_listed('p_change_min', 'p_change_max', 'net_profit_min', 'net_profit_max', 'last_parent_net')} ELSE '' END || {_opt('forecast_summary', '; summary=')} || {_opt('change_reason', '; change_reason=')} || '.'",
        "security_id", "NULL", "NULL", "NULL", "period", "ann_date",
    ),
    "ashare.income_statement": _statement("income_statement", "total_revenue", "n_income"),
    "ashare.balance_sheet": _statement("balance_sheet", "total_assets", "total_liab"),
    "ashare.cash_flow": _statement("cash_flow", "n_cashflow_act"),
    "ashare.financial_indicator": _statement("financial_indicator", "eps"),
    "ashare.earnings_express": _statement("earnings_express", "revenue", "n_income"),
    "ashare.dividend": _statement("dividend", "div_proc", "cash_div"),
    "ashare.audit_opinion": _statement("audit_opinion", "audit_result", "audit_agency"),
    "ashare.disclosure_date": _statement("disclosure_date", "pre_date", "actual_date"),
    "ashare.earnings_forecast": _statement("earnings_forecast", "forecast_type", "change_reason"),
}


def _cell(i: int, c: str) -> str:
    full = f"[{', '.join(map(quoted, CODES[c]))}][p_partkey % 3 + 1]" if c in CODES else f"'{c}-' || (p_partkey % 7)"
    return f"CASE WHEN (p_partkey + {i}) % 11 = 0 THEN '' ELSE {full} END AS {c}"


CLAIMS_SQL = f"WITH t AS (SELECT {', '.join(_cell(i, c) for i, c in enumerate(CLAIM_COLUMNS))} FROM part) " + " UNION ALL ".join(
    f"SELECT '{d}' AS dataset_id, {claim} AS claim, {company} AS company, {metric} AS metric, {value} AS value_json, {unit} AS unit, {period} AS period, {published} AS published_at FROM t WHERE {' AND '.join(f'{x} <> {quoted(str())}' for x in needs)}"
    for d, (needs, claim, company, metric, value, unit, period, published) in CLAIM_FORMS.items()
)


QUERIES = {
    "recipe_plan": recipe_plan, "fanout_union": fanout_union, "paginated_union": paginated_union, "pipeline_status": pipeline_status, "inventory_entries": inventory_entries, "inventory_summary": inventory_summary,
    "recovery_plan": recovery_plan, "source_map": source_map, "feature_inventory": feature_inventory, "maintain_tasks": maintain_tasks, "calendar_start": calendar_start, "run_gates": run_gates, "run_status": run_status,
    "evidence_claims": evidence_claims, "contract_coverage": contract_coverage,
}
SQL = {
    "recipe_plan": PLAN_SQL, "fanout_union": FANOUT_SQL, "paginated_union": PAGES_SQL, "pipeline_status": PIPELINE_SQL, "inventory_entries": ENTRIES_SQL, "inventory_summary": SUMMARY_SQL, "recovery_plan": RECOVERY_SQL,
    "source_map": SOURCES_SQL, "feature_inventory": FEATURES_SQL, "maintain_tasks": TASKS_SQL, "calendar_start": START_SQL, "run_gates": GATES_SQL, "run_status": RUN_STATUS_SQL, "evidence_claims": CLAIMS_SQL, "contract_coverage": CONTRACT_COVERAGE_SQL,
}
