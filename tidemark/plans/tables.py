"""Queries of table reads, ingestion and quality over the test tables, and their SQL."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import DatasetContract, TemporalPolicy, UsagePolicy, default_registry
from tidemark.functions.exprs import due_period, exchange_suffix, update_flag_rank
from tidemark.operators import catalog, ingest, quality
from tidemark.operators.windows import last_partitions
from tidemark.plans.views import bars, bars_sql
from tidemark.recipes import default_book
from tidemark.session import load, scratch_path
from tidemark.sources.tables import TableStore, coverage_entries

LINES = DatasetContract("test.lines", "core_fact", ("l_returnflag",), ("l_orderkey", "l_linenumber"), ("l_orderkey", "l_linenumber", "l_quantity"), TemporalPolicy("eod", "final", "post_close", "exact"), UsagePolicy(), ("l_quantity",))


def read_window(spark: SparkSession, root: str) -> DataFrame:
    """The last five days of bars up to a day, by the partitions there are."""
    return last_partitions(bars(spark, root), ["trade_date"], 5, as_of="20240120").select("security_id", "trade_date", "volume", "amount", "close")


READ_WINDOW_SQL = f"""WITH {bars_sql()} SELECT security_id, trade_date, volume, amount, close FROM bars
WHERE trade_date IN (SELECT DISTINCT trade_date FROM bars WHERE trade_date <= '20240120' ORDER BY 1 DESC LIMIT 5)"""


def scan_partial(spark: SparkSession, root: str) -> DataFrame:
    """Relations under one predicate of one scope: a part of the partition keys, pushed to the scan."""
    r = load(spark, root, "relation_snapshots").where((F.col("predicate") == "controlled_by") & (F.col("subject.market_scope") == "global"))
    return r.select("snapshot_date", "relation_id", F.col("subject.entity_id").alias("subject_id"), "confidence")


SCAN_SQL = "SELECT snapshot_date, relation_id, subject.entity_id AS subject_id, confidence FROM relation_snapshots WHERE predicate = 'controlled_by' AND subject.market_scope = 'global'"


def latest_partition(spark: SparkSession, root: str) -> DataFrame:
    m = load(spark, root, "daily_momentum").select("as_of", "window_days", "security_id", "momentum_score")
    return last_partitions(m, ["as_of", "window_days"], 1, as_of="20260401")


LATEST_SQL = """SELECT as_of, window_days, security_id, momentum_score FROM daily_momentum
WHERE (as_of, window_days) = (SELECT (as_of, window_days) FROM daily_momentum WHERE as_of <= '20260401' ORDER BY as_of DESC, window_days DESC LIMIT 1)"""


def list_partitions(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "daily_momentum").select("as_of", "window_days").distinct()


LIST_SQL = "SELECT DISTINCT as_of, window_days FROM daily_momentum"


def coverage_status(spark: SparkSession, root: str) -> DataFrame:
    """Coverage of every contract on a day, their partitions taken from the announcements and momentum dates."""
    parts = load(spark, root, "announcements").select(F.lit("ashare.announcements").alias("dataset_id"), F.col("publish_date").alias("partition_date")).where(F.col("publish_date").isNotNull()).distinct()
    m = load(spark, root, "daily_momentum").select(F.lit("ashare.daily").alias("dataset_id"), F.col("as_of").alias("partition_date")).distinct()
    r = load(spark, root, "relation_snapshots").select(F.lit("ashare.stock_basic").alias("dataset_id"), F.col("snapshot_date").alias("partition_date")).distinct()
    contracts = default_registry().frame(spark).select("dataset_id", F.size("partition_keys").alias("n_keys"), "as_of_policy")
    return coverage_entries(parts.unionByName(m).unionByName(r), contracts, "20260103")


_CONTRACT_ROWS = ", ".join(f"('{c.dataset_id}', {len(c.partition_keys)}, '{c.temporal.as_of_policy}')" for c in default_registry())


COVERAGE_SQL = f"""WITH p AS (SELECT DISTINCT 'ashare.announcements' AS dataset_id, publish_date AS d FROM announcements WHERE publish_date IS NOT NULL
  UNION ALL SELECT DISTINCT 'ashare.daily', as_of FROM daily_momentum UNION ALL SELECT DISTINCT 'ashare.stock_basic', snapshot_date FROM relation_snapshots),
c(dataset_id, n_keys, pol) AS (VALUES {_CONTRACT_ROWS}),
a AS (SELECT dataset_id, count(*) AS n, count(*) FILTER (d = '20260103') AS m, max(d) FILTER (d <= '20260103') AS b FROM p GROUP BY 1)
SELECT dataset_id, coalesce(n, 0) AS partitions, coalesce(m, 0) AS matched, CASE WHEN m > 0 THEN '20260103' WHEN pol = 'latest_before' AND n_keys = 1 THEN b END AS active,
  CASE WHEN m > 0 AND n_keys > 1 THEN 'partial' WHEN m > 0 THEN 'full' WHEN pol = 'latest_before' AND n_keys = 1 AND b IS NOT NULL THEN 'latest_before' ELSE 'none' END AS coverage FROM c LEFT JOIN a USING (dataset_id)"""


def table_quality(spark: SparkSession, root: str) -> DataFrame:
    rows = load(spark, root, "lineitem").where(F.col("l_returnflag") == "A")
    return quality.table_quality(rows, LINES, {"l_returnflag": "A"})


QUALITY_SQL = """WITH g AS (SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey, l_linenumber),
t AS (SELECT sum(n) AS rows, coalesce(sum(n) FILTER (n > 1), 0) AS d FROM g)
SELECT CASE WHEN d > 0 THEN 'primary_key_violation' ELSE 'ok' END AS status, CASE WHEN d > 0 THEN 'duplicate primary key rows' ELSE '' END AS reason, rows, d AS duplicate_rows, 0 AS mismatched_rows FROM t"""


def pk_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return quality.duplicate_key_rows(load(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"])


PK_SQL = "SELECT coalesce(sum(n) FILTER (n > 1), 0) AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def non_null_ratios(spark: SparkSession, root: str) -> DataFrame:
    return quality.non_null_ratios(load(spark, root, "evidence_records"), ["evidence_id", "company", "metric", "period", "value_json"]).withColumn("ratio", F.round("ratio", 6))


NON_NULL_SQL = """SELECT c AS column_name, n AS non_null, t AS rows, round(n / t::DOUBLE, 6) AS ratio FROM (
  SELECT count(*) AS t, unnest(['evidence_id', 'company', 'metric', 'period', 'value_json']) AS c, unnest([count(evidence_id), count(company), count(metric), count(period), count(value_json)]) AS n FROM evidence_records)"""


def revisions(spark: SparkSession, root: str) -> DataFrame:
    """Lines as first published and, for the first line numbers, once more revised."""
    line = load(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.date_format("l_shipdate", "yyyyMMdd").alias("ann_date"))
    first = line.withColumn("update_flag", F.lit("0"))
    again = line.where(F.col("l_linenumber") == 1).withColumns({"l_quantity": F.col("l_quantity") + 100, "update_flag": F.lit("1")})
    return first.unionByName(again)


def pk_dedup_keep_last(spark: SparkSession, root: str) -> DataFrame:
    return ingest.keep_last(revisions(spark, root), ["l_orderkey", "l_linenumber"], ties=["l_quantity", "l_extendedprice"])


DEDUP_SQL = """WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, strftime(l_shipdate, '%Y%m%d') AS ann_date FROM lineitem),
r AS (SELECT *, '0' AS update_flag FROM l UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 100, l_extendedprice, ann_date, '1' FROM l WHERE l_linenumber = 1)
SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY update_flag DESC, ann_date DESC, l_quantity DESC, l_extendedprice DESC) = 1"""


def ingest_recipe(spark: SparkSession, root: str) -> DataFrame:
    """A whole recipe over part rows under vendor names: rename, stamp, coerce, filter, keep the last."""
    raw = load(spark, root, "lineitem").select(F.col("l_partkey").cast("string").alias("ts_code"), F.date_format("l_shipdate", "yyyyMMdd").alias("trade_date"), F.when(F.col("l_quantity") > 45, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("vol"), F.col("l_extendedprice").alias("amount"))
    recipe = ingest.Recipe("vendor.daily", "ashare.daily", {"ts_code": "security_id", "vol": "volume", "absent": "x"}, ("volume", "amount"))
    out = ingest.transform(raw, field_map=recipe.field_map, partition={"exchange": "SSE"}, numeric=recipe.numeric_columns)
    out = ingest.in_partition(out, {"exchange": "SSE"})
    return ingest.keep_last(out, ["trade_date", "security_id"], ties=["amount", "volume"])


RECIPE_SQL = """SELECT CAST(l_partkey AS VARCHAR) AS security_id, strftime(l_shipdate, '%Y%m%d') AS trade_date, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS volume, l_extendedprice AS amount, 'SSE' AS exchange
FROM lineitem QUALIFY row_number() OVER (PARTITION BY trade_date, security_id ORDER BY amount DESC NULLS LAST, volume DESC NULLS LAST) = 1"""


def partition_filter(spark: SparkSession, root: str) -> DataFrame:
    d = load(spark, root, "documents").select("doc_id", "lang", "source")
    return ingest.in_partition(d, {"lang": "", "absent": "x"})


FILTER_SQL = "SELECT doc_id, lang, source FROM documents WHERE coalesce(lang, '') = ''"


def numeric_coerce(spark: SparkSession, root: str) -> DataFrame:
    e = load(spark, root, "evidence_records").select("record_no", F.col("value_json").alias("value"))
    return ingest.transform(e, field_map={}, partition={"batch": "all"}, numeric=["value"])


COERCE_SQL = "SELECT record_no, TRY_CAST(value_json AS DOUBLE) AS value, 'all' AS batch FROM evidence_records"


def union_by_name(spark: SparkSession, root: str) -> DataFrame:
    """Pages of different columns under one another, with the fan-out key stamped on."""
    c = load(spark, root, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = load(spark, root, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


UNION_SQL = "SELECT 'customer' AS kind, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_name, s_acctbal, NULL FROM supplier"


def period_for_as_of(spark: SparkSession, root: str) -> DataFrame:
    return load(spark, root, "trade_calendar").select("cal_date").distinct().withColumn("period", due_period(F.col("cal_date")))


PERIOD_SQL = """SELECT DISTINCT cal_date, CASE WHEN substr(cal_date, 5, 4) >= '1101' THEN substr(cal_date, 1, 4) || '0930' WHEN substr(cal_date, 5, 4) >= '0901' THEN substr(cal_date, 1, 4) || '0630'
  WHEN substr(cal_date, 5, 4) >= '0501' THEN substr(cal_date, 1, 4) || '0331' ELSE CAST(CAST(substr(cal_date, 1, 4) AS INT) - 1 AS VARCHAR) || '0930' END AS period FROM trade_calendar"""


def security_id_norm(spark: SparkSession, root: str) -> DataFrame:
    p = load(spark, root, "part").select(F.lpad((F.col("p_partkey") * 4999 % 1000000).cast("string"), 6, "0").alias("code"))
    return p.select("code", exchange_suffix(F.col("code")).alias("narrow"), exchange_suffix(F.col("code"), wide=True).alias("wide"))


SECURITY_SQL = """WITH c AS (SELECT lpad(CAST(p_partkey * 4999 % 1000000 AS VARCHAR), 6, '0') AS code FROM part)
SELECT code, code || CASE WHEN code[1] = '6' THEN '.SH' WHEN code[1] IN ('0', '3') THEN '.SZ' WHEN code[1] IN ('4', '8') THEN '.BJ' ELSE '' END AS narrow,
  code || CASE WHEN code[1] IN ('6', '5', '9') THEN '.SH' WHEN code[1] IN ('0', '2', '3') THEN '.SZ' WHEN code[1] IN ('4', '8') THEN '.BJ' ELSE '' END AS wide FROM c"""


def flag_rank(spark: SparkSession, root: str) -> DataFrame:
    words = F.get(F.array(*[F.lit(x) for x in ("1", "0", " Yes", "NO", "revised", "", "3.7", "later")]), (F.col("o_orderkey") % 9).cast("int"))
    return load(spark, root, "orders").select("o_orderkey", words.alias("flag")).withColumn("flag_rank", update_flag_rank(F.col("flag")))


FLAG_SQL = """WITH w AS (SELECT o_orderkey, ['1', '0', ' Yes', 'NO', 'revised', '', '3.7', 'later', NULL][o_orderkey % 9 + 1] AS flag FROM orders)
SELECT o_orderkey, flag, CASE WHEN flag IS NULL THEN -1 WHEN lower(trim(flag)) IN ('1', 'yes', 'revised') THEN 1 WHEN lower(trim(flag)) IN ('0', 'no', '') THEN 0 WHEN flag = '3.7' THEN 3 ELSE 0 END AS flag_rank FROM w"""


def index_weights_latest(spark: SparkSession, root: str) -> DataFrame:
    rows = load(spark, root, "lineitem").select((F.col("l_suppkey") % 7).cast("string").alias("index_code"), F.col("l_partkey").cast("string").alias("con_code"), F.date_format("l_shipdate", "yyyyMM").alias("trade_date"), F.col("l_quantity").alias("weight"))
    return catalog.latest_weights(rows, "20260630")


WEIGHTS_SQL = """WITH r AS (SELECT CAST(l_suppkey % 7 AS VARCHAR) AS i, CAST(l_partkey AS VARCHAR) AS s, strftime(l_shipdate, '%Y%m') AS d, l_quantity AS weight FROM lineitem)
SELECT '20260630' AS snapshot_date, i AS index_id, s AS security_id, d AS weight_trade_date, weight FROM r QUALIFY d = max(d) OVER (PARTITION BY i)"""


def status_rollup(spark: SparkSession, root: str) -> DataFrame:
    o = load(spark, root, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "warning").otherwise("blocked").alias("status"))
    return catalog.roll_up(o, ["o_custkey"])


ROLLUP_SQL = """SELECT o_custkey, count(*) AS checks, CASE WHEN bool_or(o_orderstatus NOT IN ('F', 'O')) THEN 'blocked' WHEN bool_or(o_orderstatus = 'O') THEN 'degraded' ELSE 'ok' END AS status FROM orders GROUP BY 1"""


def dataset_search(spark: SparkSession, root: str) -> DataFrame:
    """Contracts that answer a query, with the words it stands for; those whose partitions are there come first among equals."""
    contracts = default_registry().frame(spark)
    ways = default_book().frame(spark).groupBy("dataset_id").agg(*[F.array_sort(F.collect_set(c)).alias(n) for c, n in (("recipe_id", "recipes"), ("source_id", "source_ids"), ("api", "apis"))])
    held = [d for d, table in (("ashare.announcements", "announcements"),) if not load(spark, root, table).isEmpty()]
    full = contracts.join(ways, "dataset_id", "left").withColumn("status", F.when(F.col("dataset_id").isin(held), "ready").otherwise("missing"))
    return catalog.search_contracts(full, catalog.search_terms(SEARCH_QUERY))


SEARCH_QUERY = "公告, sec"


def _search_text(c: DatasetContract, name: str) -> str:
    ways = default_book().recipes_for(c.dataset_id)
    v = {"allowed": c.usage.allowed, "forbidden": c.usage.forbidden, "domain": c.domain, "recipes": [r.recipe_id for r in ways], "source_ids": [r.source_id for r in ways], "apis": [r.api for r in ways]}.get(name, getattr(c, name, ""))
    return (v if isinstance(v, str) else "\n".join(v)).lower()


_SEARCH_ROWS = ", ".join("('{}', {}, {}, '{}')".format(c.dataset_id, g, w, "\n".join(_search_text(c, f) for f in fields)) for c in default_registry() for g, (w, fields) in enumerate(catalog.FIELD_GROUPS))
_SEARCH_TERMS = ("公告", "sec", "公告, sec", "announcement", "cninfo", "official", "disclosure", "evidence", "filings", "companyfacts", "ticker_cik")
SEARCH_SQL = f"""WITH f(dataset_id, grp, weight, body) AS (VALUES {_SEARCH_ROWS}), t(term) AS (VALUES {", ".join(f"('{w}')" for w in _SEARCH_TERMS)}),
h AS (SELECT dataset_id, sum(weight) AS score, count(*) AS hits FROM f JOIN t ON contains(body, term) GROUP BY 1)
SELECT dataset_id, score + CASE WHEN dataset_id = 'ashare.announcements' AND (SELECT count(*) FROM announcements) > 0 THEN 3 ELSE 0 END AS score, hits FROM h"""


def usage_permits(spark: SparkSession, root: str) -> DataFrame:
    c = default_registry().frame(spark)
    return c.groupBy("domain").agg(F.count(F.lit(1)).alias("datasets"), F.count_if(catalog.permits("company_business_exposure")).alias("exposure"), F.count_if(catalog.permits("candidate_generation")).alias("candidates"))


_USES = ", ".join(f"('{c.domain}', {c.usage.permits('company_business_exposure')}, {c.usage.permits('candidate_generation')})" for c in default_registry())
PERMITS_SQL = f"""WITH u(domain, e, c) AS (VALUES {_USES}) SELECT domain, count(*) AS datasets, count(*) FILTER (e) AS exposure, count(*) FILTER (c) AS candidates FROM u GROUP BY 1"""


def json_objects(spark: SparkSession, root: str) -> DataFrame:
    """All objects in nested documents made of evidence rows: where they stand, and fields read back from them."""
    e = load(spark, root, "evidence_records")
    doc = F.to_json(F.struct(F.lit("run").alias("kind"), F.array(F.struct("claim", F.col("source_ref").alias("source"))).alias("items")))
    objects = catalog.walk_objects(e.select("record_no", doc.alias("doc")), "record_no", "doc")
    field = lambda path: F.get_json_object("object", path)
    return objects.select("record_no", "path", field("$.kind").alias("kind"), field("$.claim").alias("claim"), field("$.source_name").alias("source_name"))


JSON_SQL = """SELECT record_no, '$' AS path, 'run' AS kind, NULL AS claim, NULL AS source_name FROM evidence_records
UNION ALL SELECT record_no, '$.items[0]', NULL, claim, NULL FROM evidence_records
UNION ALL SELECT record_no, '$.items[0].source', NULL, NULL, source_ref.source_name FROM evidence_records WHERE source_ref IS NOT NULL"""


def quality_branches(spark: SparkSession, root: str) -> DataFrame:
    """Every verdict on a partition: one row per way of publishing the lines."""
    lines = load(spark, root, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity").dropDuplicates(["l_orderkey", "l_linenumber"]).withColumn("l_returnflag", F.lit("A"))
    cases = {
        "ok": (lines, LINES, {"l_returnflag": "A"}),
        "no partition": (lines, LINES, {}),
        "another value": (lines.withColumn("l_returnflag", F.when(F.col("l_linenumber") == 1, "B").otherwise("A")), LINES, {"l_returnflag": "A"}),
        "lacks a column": (lines.drop("l_quantity"), LINES, {"l_returnflag": "A"}),
        "repeated keys": (lines.unionByName(lines.where("l_linenumber = 2")), LINES, {"l_returnflag": "A"}),
        "nothing": (lines.where(F.lit(False)), LINES, {"l_returnflag": "A"}),
        "lacks an analysis column": (lines.drop("l_quantity"), replace(LINES, required_columns=("l_orderkey", "l_linenumber")), {"l_returnflag": "A"}),
    }
    return reduce(DataFrame.unionByName, [quality.table_quality(*c).withColumn("case_name", F.lit(name)) for name, c in cases.items()])


BRANCHES_SQL = """WITH l AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
t AS (SELECT count(*) AS n, count(*) FILTER (l_linenumber = 1) AS one, count(*) FILTER (l_linenumber = 2) AS two FROM l)
SELECT 'ok' AS case_name, 'ok' AS status, '' AS reason, n AS rows, 0 AS duplicate_rows, 0 AS mismatched_rows FROM t
UNION ALL SELECT 'no partition', 'partition_mismatch', 'missing partition keys', n, 0, 0 FROM t
UNION ALL SELECT 'another value', 'partition_mismatch', 'partition column values do not match partition', n, 0, one FROM t
UNION ALL SELECT 'lacks a column', 'schema_mismatch', 'missing required columns', n, 0, 0 FROM t
UNION ALL SELECT 'repeated keys', 'primary_key_violation', 'duplicate primary key rows', n + two, 2 * two, 0 FROM t
UNION ALL SELECT 'nothing', 'empty', 'empty partition is forbidden', 0, 0, 0 FROM t
UNION ALL SELECT 'lacks an analysis column', 'degraded', 'missing analysis columns', n, 0, 0 FROM t"""


_STORES: dict[tuple[str, str], TableStore] = {}


def calendar_store(spark: SparkSession, root: str) -> TableStore:
    """The calendar published as a table, one partition per exchange; once per session and folder."""
    at = (spark.sparkContext.applicationId, root)
    if at not in _STORES:
        store = TableStore(spark, scratch_path(spark, "tables"))
        rows = load(spark, root, "trade_calendar").where(F.col("exchange").isNotNull()).dropDuplicates(["exchange", "cal_date"])
        for r in rows.select("exchange").distinct().orderBy("exchange").collect():  # the exchanges of a calendar
            store.publish("ashare.trade_calendar", rows.where(F.col("exchange") == r.exchange), {"exchange": r.exchange}, lineage={"table": "trade_calendar"})
        _STORES[at] = store
    return _STORES[at]


def store_matching(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the last partition that matches no key in particular: partitions are pruned to it."""
    return calendar_store(spark, root).matching("ashare.trade_calendar", {}, ["exchange", "cal_date", "is_open"], limit=1)


STORE_MATCHING_SQL = "SELECT exchange, cal_date, min(is_open) AS is_open FROM trade_calendar WHERE exchange = (SELECT max(exchange) FROM trade_calendar) GROUP BY 1, 2"


def store_read(spark: SparkSession, root: str) -> DataFrame:
    return calendar_store(spark, root).read("ashare.trade_calendar", {"exchange": "SSE"}, ["cal_date"])


STORE_READ_SQL = "SELECT DISTINCT cal_date FROM trade_calendar WHERE exchange = 'SSE'"


def store_partitions(spark: SparkSession, root: str) -> DataFrame:
    return calendar_store(spark, root).partitions("ashare.trade_calendar")


STORE_PARTITIONS_SQL = "SELECT DISTINCT exchange FROM trade_calendar WHERE exchange IS NOT NULL"


def store_meta(spark: SparkSession, root: str) -> DataFrame:
    m = calendar_store(spark, root).meta().where(F.col("dataset_id") == "ashare.trade_calendar")
    return m.select(F.try_element_at("partition", F.lit("exchange")).alias("exchange"), "rows", F.size("columns").alias("columns"), F.try_element_at("temporal", F.lit("as_of_policy")).alias("as_of_policy"), "status")


STORE_META_SQL = "SELECT exchange, count(DISTINCT cal_date) AS rows, 3 AS columns, 'range' AS as_of_policy, 'ok' AS status FROM trade_calendar WHERE exchange IS NOT NULL GROUP BY 1"


QUERIES = {
    "read_window": read_window, "scan_partial": scan_partial, "latest_partition": latest_partition, "list_partitions": list_partitions, "coverage_status": coverage_status,
    "table_quality": table_quality, "pk_duplicates": pk_duplicates, "non_null_ratios": non_null_ratios, "pk_dedup_keep_last": pk_dedup_keep_last, "ingest_recipe": ingest_recipe,
    "partition_filter": partition_filter, "numeric_coerce": numeric_coerce, "union_by_name": union_by_name, "period_for_as_of": period_for_as_of, "security_id_norm": security_id_norm,
    "update_flag_rank": flag_rank, "index_weights_latest": index_weights_latest, "status_rollup": status_rollup, "dataset_search": dataset_search, "usage_permits": usage_permits,
    "json_objects": json_objects, "quality_branches": quality_branches,
    "store_matching": store_matching, "store_read": store_read, "store_partitions": store_partitions, "store_meta": store_meta,
}
SQL = {
    "read_window": READ_WINDOW_SQL, "scan_partial": SCAN_SQL, "latest_partition": LATEST_SQL, "list_partitions": LIST_SQL, "coverage_status": COVERAGE_SQL,
    "table_quality": QUALITY_SQL, "pk_duplicates": PK_SQL, "non_null_ratios": NON_NULL_SQL, "pk_dedup_keep_last": DEDUP_SQL, "ingest_recipe": RECIPE_SQL,
    "partition_filter": FILTER_SQL, "numeric_coerce": COERCE_SQL, "union_by_name": UNION_SQL, "period_for_as_of": PERIOD_SQL, "security_id_norm": SECURITY_SQL,
    "update_flag_rank": FLAG_SQL, "index_weights_latest": WEIGHTS_SQL, "status_rollup": ROLLUP_SQL, "dataset_search": SEARCH_SQL, "usage_permits": PERMITS_SQL, "json_objects": JSON_SQL, "quality_branches": BRANCHES_SQL,
    "store_matching": STORE_MATCHING_SQL, "store_read": STORE_READ_SQL, "store_partitions": STORE_PARTITIONS_SQL, "store_meta": STORE_META_SQL,
}
