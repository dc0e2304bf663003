"""Queries of stores, recorded payloads and runs over the test tables, and their SQL: what is written is read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features, gates, ingest, quality, runs, textsearch
from tidemark.operators.windows import window_coverage
from tidemark.plans.views import bars, bars_sql
from tidemark.session import load, scratch_path
from tidemark.sources import parsers
from tidemark.sources.features import FeatureStore
from tidemark.sources.payloads import EvidenceSource, EvidenceSources, backfill, decode_text, export_lines
from tidemark.sources.tables import append_records, recorded, write_raw


def feature_store(spark: SparkSession, root: str) -> DataFrame:
    """Two cross-sections written and found again, with their quality: one whole, one of a table that lacks scores."""
    store = FeatureStore(spark, scratch_path(spark, "features"))
    m = load(spark, root, "daily_momentum").where(F.col("window_days") == 5).select("security_id", "momentum_score", "avg_amount")
    store.write("ashare.daily_momentum", m.where(F.col("momentum_score").isNotNull()), as_of="20260102", window=5, analysis=["momentum_score"], inputs={"ashare.daily": ("required", "ok")})
    store.write("ashare.daily_momentum", m, as_of="20260103", window=5, analysis=["no_such_column"])
    found = store.discover().select("as_of", "window", "rows", "status")
    read = store.read("ashare.daily_momentum", as_of="20260102", window=5).where(F.col("momentum_score").isNotNull()).count()
    return found.withColumn("scores", F.when(F.col("as_of") == "20260102", F.lit(read).cast("bigint")))


FEATURE_STORE_SQL = """WITH m AS (SELECT momentum_score FROM daily_momentum WHERE window_days = 5)
SELECT '20260102' AS as_of, 5 AS "window", count(momentum_score) AS rows, 'ok' AS status, count(momentum_score) AS scores FROM m UNION ALL SELECT '20260103', 5, count(*), 'degraded', NULL FROM m"""


def raw_replay(spark: SparkSession, root: str) -> DataFrame:
    """Answers recorded in the raw layer, one per region, replayed by a recipe that asks for three of them."""
    base = scratch_path(spark, "raw")
    n = load(spark, root, "nation").select("n_nationkey", "n_name", "n_regionkey")
    for r in range(3):
        write_raw(n.where(F.col("n_regionkey") == r).drop("n_regionkey"), base, "tushare", "nations", {"region": r}, "2026-01-05T00:00:00")
    rows = recorded(spark, base, "tushare", "nations", "n_nationkey bigint, n_name string")
    recipe = ingest.Recipe("r", "d", {"n_name": "name"}, api="nations", fanout={"region": ("0", "1", "9")})
    return ingest.transform(ingest.fetch_rows(recipe, ingest.replay({"nations": rows}), {}), field_map=recipe.field_map, partition={}, numeric=[])


RAW_SQL = "SELECT n_nationkey, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation WHERE n_regionkey IN (0, 1)"


def lines_append(spark: SparkSession, root: str) -> DataFrame:
    """Relations appended to a JSON-lines store in two batches; ids that are there are not appended again."""
    path = scratch_path(spark, "relations")
    r = load(spark, root, "relation_snapshots").select("relation_id", "snapshot_date", "predicate", "received_at")
    r = r.where(F.col("relation_id").isNotNull()).groupBy("relation_id").agg(F.min(F.struct("snapshot_date", "predicate")).alias("r")).select("relation_id", "r.*")
    schema = r.schema
    early = r.where(F.col("snapshot_date") <= "20250101")
    append_records(early, spark.createDataFrame([], schema), path, id_column="relation_id", ordinal="snapshot_date")
    held = lambda: spark.read.schema(schema).json(path)
    append_records(r, held(), path, id_column="relation_id", ordinal="snapshot_date")
    return held()


LINES_SQL = """WITH x AS (SELECT relation_id, min({'s': coalesce(snapshot_date, ''), 'p': coalesce(predicate, '')}) AS r FROM relation_snapshots WHERE relation_id IS NOT NULL GROUP BY 1)
SELECT relation_id, nullif(r.s, '') AS snapshot_date, nullif(r.p, '') AS predicate FROM x"""


def lines_export(spark: SparkSession, root: str) -> DataFrame:
    """Evidence exported as JSON lines, null fields kept, and read back."""
    path = f"{scratch_path(spark, 'export')}/lines"
    export_lines(load(spark, root, "evidence_records").select("record_no", "claim", "company", "source_ref", "supports"), path)
    t = spark.read.text(path)
    field = lambda p: F.get_json_object("value", p)
    return t.select(field("$.record_no").cast("bigint").alias("record_no"), field("$.claim").alias("claim"), field("$.company").alias("company"), field("$.source_ref.source_name").alias("source_name"), F.contains("value", F.lit('"company":')).alias("has_company"), F.size(F.from_json(field("$.supports"), "array<string>")).alias("supports"))


EXPORT_SQL = "SELECT record_no, claim, company, source_ref.source_name AS source_name, TRUE AS has_company, CASE WHEN supports IS NOT NULL THEN CAST(len(supports) AS INT) END AS supports FROM evidence_records"


def decoded(spark: SparkSession, root: str) -> DataFrame:
    """Names as bytes whose charset a source declares wrongly, decoded: UTF-8 behind a declared ASCII."""
    a = load(spark, root, "announcements").select("record_no", "security_name")
    return a.select("record_no", decode_text(F.encode("security_name", "UTF-8"), F.lit("ascii")).alias("security_name"))


DECODED_SQL = "SELECT record_no, security_name FROM announcements"


def report_pages(spark: SparkSession, root: str) -> DataFrame:
    """Report list pages made of documents, five a page, flattened again."""
    d = load(spark, root, "documents").select("doc_id", "source", "publish_date")
    item = F.struct(F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("AP"), "doc_id")).alias("infoCode"), F.concat(F.lit("T"), "doc_id").alias("title"), F.col("publish_date").alias("publishDate"), F.col("source").alias("industryName"))
    pages = d.groupBy((F.col("doc_id") / 5).cast("bigint").alias("page")).agg(F.to_json(F.struct(F.collect_list(item).alias("data"), F.lit(1).alias("TotalPage"))).alias("body"))
    return parsers.industry_reports(pages, "body")


REPORTS_SQL = """SELECT CASE WHEN doc_id % 7 <> 0 THEN 'AP' || doc_id ELSE '' END AS report_id, 'T' || doc_id AS title, coalesce(publish_date, '') AS published_at, '' AS source_name, coalesce(source, '') AS industry_name,
  CASE WHEN doc_id % 7 <> 0 THEN 'https://pdf.dfcfw.com/pdf/H3_AP' || doc_id || '_1.pdf' ELSE 'https://data.eastmoney.com/report/' END AS source_url FROM documents"""


def quote_lists(spark: SparkSession, root: str) -> DataFrame:
    """Quote lists made of parts, as lists and by number, flattened again."""
    p = load(spark, root, "part").select("p_partkey", "p_retailprice", "p_name")
    price = F.when(F.col("p_partkey") % 5 == 0, "-").otherwise(F.col("p_partkey").cast("string"))
    item = F.struct(F.lpad((F.col("p_partkey") * 4999 % 1000000).cast("string"), 6, "0").alias("f12"), F.col("p_name").alias("f14"), price.alias("f2"), F.lit("1.5").alias("f3"))
    listed = F.to_json(F.struct(F.struct(F.array(item).alias("diff")).alias("data")))
    numbered = F.to_json(F.struct(F.struct(F.create_map(F.lit("0"), item).alias("diff")).alias("data")))
    return parsers.listed_quotes(p.select(F.when(F.col("p_partkey") % 2 == 0, listed).otherwise(numbered).alias("body")), "body", snapshot_at="now")


QUOTES_SQL = """WITH c AS (SELECT *, lpad(CAST(p_partkey * 4999 % 1000000 AS VARCHAR), 6, '0') AS code FROM part)
SELECT code || CASE WHEN code[1] IN ('6', '5', '9') THEN '.SH' WHEN code[1] IN ('0', '2', '3') THEN '.SZ' WHEN code[1] IN ('4', '8') THEN '.BJ' ELSE '' END AS security_id, trim(p_name) AS name,
  CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey AS DOUBLE) END AS price, 1.5 AS pct_chg, CAST(NULL AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS amount, 'now' AS snapshot_at, 'eastmoney_intraday' AS quote_source FROM c"""


def announcement_payload(spark: SparkSession, root: str) -> DataFrame:
    """Index pages made of announcements, flattened; an id that comes again is left out."""
    a = load(spark, root, "announcements").select("record_no", "announcement_id", "title", "security_name", "adjunct_url", "adjunct_size")
    item = F.struct(
        F.lpad((F.col("record_no") % 1000000).cast("string"), 6, "0").alias("secCode"), F.col("security_name").alias("tileSecName"), F.col("announcement_id").alias("announcementId"), F.col("title").alias("announcementTitle"),
        (F.lit(1767225600000) + F.col("record_no") * 3600000).alias("announcementTime"), F.col("adjunct_url").alias("adjunctUrl"), F.col("adjunct_size").alias("adjunctSize"),
    )
    pages = a.select("record_no", F.to_json(F.struct(F.array(item).alias("announcements"), F.lit(False).alias("hasMore"))).alias("body"))
    out = parsers.announcement_pages(pages, "body", ["record_no"])
    return out.select("announcement_id", "security_id", "security_name", "title", "publish_date", "publish_time", "source_url", "adjunct_size")


PAYLOAD_SQL = """WITH a AS (SELECT *, lpad(CAST(record_no % 1000000 AS VARCHAR), 6, '0') AS code, trim(coalesce(announcement_id, '')) AS id, make_timestamp((1767225600 + record_no * 3600 + 28800) * 1000000) AS made FROM announcements),
k AS (SELECT * FROM a WHERE code[1] IN ('6', '0', '3', '4', '8') QUALIFY id = '' OR row_number() OVER (PARTITION BY id ORDER BY record_no) = 1)
SELECT id AS announcement_id, code || CASE WHEN code[1] = '6' THEN '.SH' WHEN code[1] IN ('0', '3') THEN '.SZ' ELSE '.BJ' END AS security_id, trim(coalesce(security_name, '')) AS security_name, trim(coalesce(title, '')) AS title, strftime(made, '%Y%m%d') AS publish_date,
  strftime(made, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS publish_time, CASE WHEN trim(coalesce(adjunct_url, '')) <> '' THEN 'https://static.cninfo.com.cn/' || trim(adjunct_url) ELSE '' END AS source_url, adjunct_size FROM k"""


def quote_fallback(spark: SparkSession, root: str) -> DataFrame:
    """Current quotes from the first source that has any: one fails, one is empty, the third answers."""
    p = load(spark, root, "part").select("p_partkey", "p_retailprice")

    def fails() -> DataFrame:
        raise OSError("unavailable")

    name, rows, attempts = ingest.first_answer([("tencent_quote", fails), ("eastmoney_intraday", lambda: p.where(F.lit(False))), ("recorded", lambda: p), ("never_asked", fails)])
    return rows.select("p_partkey", F.col("p_retailprice").alias("price"), F.lit(name).alias("source"), F.lit(len(attempts)).alias("attempts"))


FALLBACK_SQL = "SELECT p_partkey, p_retailprice AS price, 'recorded' AS source, 3 AS attempts FROM part"


def backfilled(spark: SparkSession, root: str) -> DataFrame:
    """Suppliers in the columns a contract wants, one of which there is not."""
    return backfill(load(spark, root, "supplier"), ["s_suppkey", "rating", "s_name"])


BACKFILL_SQL = "SELECT s_suppkey, CAST(NULL AS VARCHAR) AS rating, s_name FROM supplier"


def lookback_search(spark: SparkSession, root: str) -> DataFrame:
    """Announcements of the 30 days that end on a day."""
    a = load(spark, root, "announcements")
    return textsearch.announcement_search(a, category="财务报告", last_day="20260131", lookback=30).select("record_no", "publish_date")


_WORD = lambda w: "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{w.lower()}')" for c in textsearch.SEARCH_COLUMNS) + ")"
LOOKBACK_SQL = "SELECT record_no, publish_date FROM announcements WHERE publish_date BETWEEN '20260102' AND '20260131' AND (" + " OR ".join(map(_WORD, textsearch.CATEGORIES["财务报告"])) + ")"


def close_fallback(spark: SparkSession, root: str) -> DataFrame:
    """Return of each security by its closes alone: the last over the first."""
    b = bars(spark, root).select("security_id", "trade_date", "close")
    got = features.close_return(F.lit(None).cast("double"), F.col("close"), F.col("trade_date"))
    return b.groupBy("security_id").agg(F.round(got, 6).alias("window_return_pct"))


CLOSE_SQL = f"""WITH {bars_sql()}, c AS (SELECT security_id, count(close) AS n, arg_min(close, trade_date) AS a, arg_max(close, trade_date) AS b FROM bars WHERE close IS NOT NULL GROUP BY 1)
SELECT security_id, round(CASE WHEN n >= 2 AND a <> 0 THEN (b / a - 1) * 100 ELSE 0 END, 6) AS window_return_pct FROM c"""


def run_replay(spark: SparkSession, root: str) -> DataFrame:
    """Runs recorded and read back, with the number of their references by kind."""
    path = scratch_path(spark, "runs")
    e = load(spark, root, "evidence_records").where(F.col("topic").isNotNull())
    made = e.groupBy("topic").agg(F.count("evidence_id").alias("n")).select(F.concat(F.lit("What of "), "topic", F.lit(", now?")).alias("question"), F.lit("20260103").alias("as_of"), F.lit("2026-01-03T20:00:00+08:00").alias("created_at"), F.array(F.lit("ashare.daily:trade_date=20260103")).alias("mart_refs"), F.array(F.concat(F.lit("n"), "n")).alias("evidence_ids"))
    runs.record_runs(made, path)
    back = runs.replay_runs(spark, path)
    refs = runs.run_refs(back).groupBy(F.col("run_id").alias("_r")).agg(F.count_if(F.col("kind") == "mart").alias("marts"), F.max(F.when(F.col("kind") == "evidence", F.col("ref"))).alias("evidence"))
    return back.join(refs, F.col("run_id") == F.col("_r")).select("run_id", "question", "marts", "evidence")


RUNS_SQL = """WITH e AS (SELECT 'What of ' || topic || ', now?' AS question, count(evidence_id) AS n FROM evidence_records WHERE topic IS NOT NULL GROUP BY topic)
SELECT '20260103-' || substr(regexp_replace(regexp_replace(lower(question), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 32) || '-' || substr(sha256(question || '|20260103|2026-01-03T20:00:00+08:00'), 1, 8) AS run_id, question, 1 AS marts, 'n' || n AS evidence FROM e"""


def evidence_refs(spark: SparkSession, root: str) -> DataFrame:
    """References of runs to evidence, resolved against the store."""
    e = load(spark, root, "evidence_records").where(F.col("evidence_id").isNotNull())
    refs = e.select(F.col("record_no").cast("string").alias("run_id"), F.lit("evidence").alias("kind"), F.when(F.col("record_no") % 2 == 0, F.col("evidence_id")).otherwise(F.concat("evidence_id", F.lit("?"))).alias("ref"))
    none = spark.createDataFrame([], "name string, partition map<string,string>, status string")
    return gates.resolve_refs(refs, none.select("name"), none, e.select(F.col("evidence_id").alias("id")), none.select(F.col("name").alias("id"))).select("run_id", "ref", "status")


REFS_SQL = "SELECT CAST(record_no AS VARCHAR) AS run_id, CASE WHEN record_no % 2 = 0 THEN evidence_id ELSE evidence_id || '?' END AS ref, CASE WHEN record_no % 2 = 0 THEN 'ok' ELSE 'missing' END AS status FROM evidence_records WHERE evidence_id IS NOT NULL"


def feature_inputs(spark: SparkSession, root: str) -> DataFrame:
    """Quality of a feature by the coverage of what it is built from: one input whole, one with gaps."""
    calendar = load(spark, root, "trade_calendar")
    a = load(spark, root, "announcements").where(F.col("publish_date").isNotNull()).select(F.lit("ashare.announcements").alias("dataset_id"), F.col("publish_date").alias("partition_date")).distinct()
    open_days = calendar.where(F.col("is_open") == "1").select(F.lit("ashare.daily").alias("dataset_id"), F.col("cal_date").alias("partition_date")).distinct()
    cover = window_coverage(open_days.unionByName(a.where(F.col("partition_date") < "20251231")).withColumn("quality_status", F.lit("ok")), calendar, "20260105", 5)
    inputs = {r.dataset_id: ("required" if r.dataset_id == "ashare.daily" else "degrade_if_missing", r.status) for r in cover.select("dataset_id", "status").collect()}  # one row per input
    m = load(spark, root, "daily_momentum").where(F.col("momentum_score").isNotNull())
    return quality.feature_quality(m, ["momentum_score"], inputs).select("status", "reason", "rows")


INPUTS_SQL = "SELECT 'degraded' AS status, 'degraded feature inputs' AS reason, count(*) AS rows FROM daily_momentum WHERE momentum_score IS NOT NULL"


def registered_source(spark: SparkSession, root: str) -> DataFrame:
    """Claims of a registered source, over documents whose records are objects in some rows and bare values in others."""
    sources = EvidenceSources(spark, f"{scratch_path(spark, 'sources')}/registry")
    sources.add(EvidenceSource("parts", "data.rows", {"name": "n", "value": "value"}, "{name} is at {value} {unit}.", {"unit": "yuan", "name": "It"}))
    sources.add(EvidenceSource("other", "$", {}, "nothing"))
    p = load(spark, root, "part").select("p_partkey")
    k = F.col("p_partkey").cast("string")
    named = F.concat(F.lit('{"data": {"rows": [{"n": "P'), k, F.lit('", "value": '), k, F.lit("}]}}"))
    bare = F.concat(F.lit('{"data": {"rows": ['), k, F.lit("]}}"))
    return sources.claims("parts", p.select(F.when(F.col("p_partkey") % 2 == 0, named).otherwise(bare).alias("body")), "body").select("claim", "name", "value")


REGISTERED_SQL = "SELECT CASE WHEN p_partkey % 2 = 0 THEN 'P' || p_partkey ELSE 'It' END || ' is at ' || p_partkey || ' yuan.' AS claim, CASE WHEN p_partkey % 2 = 0 THEN 'P' || p_partkey ELSE 'It' END AS name, CAST(p_partkey AS VARCHAR) AS value FROM part"


def feature_branches(spark: SparkSession, root: str) -> DataFrame:
    """Every verdict on a feature partition."""
    m = load(spark, root, "daily_momentum").select("momentum_score", "avg_amount", F.lit(1.0).alias("whole"))
    ok, bad = {"a": ("required", "ok"), "b": ("optional", "missing")}, lambda role: {"a": (role, "missing")}
    cases = {
        "ok": (m, ["whole"], ok), "no rows": (m.where(F.lit(False)), ["whole"], ok), "lacks a column": (m, ["whole", "absent"], ok), "mostly null": (m.withColumn("whole", F.when(F.rand(1) < -1, 1.0)), ["whole"], ok),
        "required": (m, ["whole"], bad("required")), "degrades": (m, ["whole"], bad("degrade_if_missing")), "optional": (m, ["whole"], bad("optional")),
    }
    return reduce(DataFrame.unionByName, [quality.feature_quality(*c).select(F.lit(name).alias("case_name"), "status", "reason", "rows") for name, c in cases.items()])


FEATURE_BRANCHES_SQL = """WITH n AS (SELECT count(*) AS n FROM daily_momentum), c(case_name, status, reason, k) AS (VALUES ('ok', 'ok', '', 1), ('no rows', 'degraded', 'empty feature partition', 0), ('lacks a column', 'degraded', 'missing analysis columns', 1),
  ('mostly null', 'degraded', 'analysis columns below non-null threshold', 1), ('required', 'degraded', 'required feature inputs are not usable', 1), ('degrades', 'degraded', 'degraded feature inputs', 1), ('optional', 'ok', '', 1))
SELECT case_name, status, reason, k * n AS rows FROM c, n"""


def snippet_refs(spark: SparkSession, root: str) -> DataFrame:
    """The first ten mentions of a word, each with the row it stands in: a top-k report."""
    return textsearch.snippets(load(spark, root, "announcement_text"), "annual", context=0, keep=("fetch_no",), limit=10, ordinal="fetch_no").select("row_ref", "match_start", "match_text")


SNIPPET_REFS_SQL = r"""WITH t AS (SELECT fetch_no, trim(text, E' ') AS t FROM announcement_text WHERE trim(coalesce(parse_status, '')) IN ('', 'ok')),
p AS (SELECT fetch_no, t, string_split(lower(t), 'annual') AS p FROM t WHERE contains(lower(t), 'annual')), i AS (SELECT fetch_no, t, p, unnest(range(1, len(p))) AS k FROM p),
s AS (SELECT fetch_no, t, CAST(list_sum(list_transform(p[1:k], lambda x: length(x))) + (k - 1) * 6 AS INTEGER) AS a FROM i)
SELECT 'row:' || fetch_no AS row_ref, a AS match_start, t[a + 1 : a + 6] AS match_text FROM s ORDER BY fetch_no, a LIMIT 10"""


QUERIES = {
    "registered_source": registered_source, "feature_branches": feature_branches, "snippet_refs": snippet_refs,
    "feature_store": feature_store, "raw_replay": raw_replay, "lines_append": lines_append, "lines_export": lines_export, "decoded": decoded, "report_pages": report_pages, "quote_lists": quote_lists,
    "announcement_payload": announcement_payload, "quote_fallback": quote_fallback, "backfilled": backfilled, "lookback_search": lookback_search, "close_fallback": close_fallback, "run_replay": run_replay,
    "evidence_refs": evidence_refs, "feature_inputs": feature_inputs,
}
SQL = {
    "registered_source": REGISTERED_SQL, "feature_branches": FEATURE_BRANCHES_SQL, "snippet_refs": SNIPPET_REFS_SQL,
    "feature_store": FEATURE_STORE_SQL, "raw_replay": RAW_SQL, "lines_append": LINES_SQL, "lines_export": EXPORT_SQL, "decoded": DECODED_SQL, "report_pages": REPORTS_SQL, "quote_lists": QUOTES_SQL,
    "announcement_payload": PAYLOAD_SQL, "quote_fallback": FALLBACK_SQL, "backfilled": BACKFILL_SQL, "lookback_search": LOOKBACK_SQL, "close_fallback": CLOSE_SQL, "run_replay": RUNS_SQL,
    "evidence_refs": REFS_SQL, "feature_inputs": INPUTS_SQL,
}
