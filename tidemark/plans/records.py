"""Queries of evidence, relations, search and parsers over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import milliseconds_iso
from tidemark.operators import evidence, relations, textsearch
from tidemark.operators.ingest import keep_last
from tidemark.operators.instants import normalise_instants
from tidemark.plans.problems import ANNOUNCEMENT_SOURCE
from tidemark.session import load
from tidemark.sources import parsers


def evidence_from_table(spark: SparkSession, root: str) -> DataFrame:
    """Evidence of announcements, one per announcement_id (the last fetched), without the hash."""
    a = load(spark, root, "announcements")
    last = a.groupBy("announcement_id").agg(F.max_by(F.struct("security_id", "security_name", "title", "publish_date", "source_url"), F.struct("fetched_at", "record_no")).alias("r")).select("announcement_id", "r.*")
    out = evidence.evidence_from("ashare.announcements", last, query_time="2026-07-01T00:00:00+08:00")
    return out.select("claim", "topic", "company", F.col("source_ref.source_url").alias("source_url"), F.col("source_ref.published_at").alias("published_at"), "confidence", "verification", "supports", "quality_flags")


EVIDENCE_SQL = """WITH l AS (SELECT * FROM announcements QUALIFY row_number() OVER (PARTITION BY announcement_id ORDER BY fetched_at DESC NULLS LAST, record_no DESC) = 1),
t AS (SELECT trim(coalesce(announcement_id, '')) AS id, trim(coalesce(security_id, '')) AS sid, trim(coalesce(security_name, '')) AS sn, trim(coalesce(title, '')) AS title, trim(coalesce(publish_date, '')) AS d, trim(coalesce(source_url, '')) AS u FROM l)
SELECT 'CNINFO records ' || CASE WHEN sn <> '' THEN sn ELSE sid END || ' (' || sid || ') announcement ''' || title || ''' disclosed on ' || d || '.' AS claim, 'company_announcement' AS topic, CASE WHEN sn <> '' THEN sn ELSE sid END AS company, u AS source_url, d AS published_at,
  'high' AS confidence, 'official_disclosure_index' AS verification, ['evidence', 'context'] AS supports, ['announcement_index_only', 'pdf_not_parsed'] AS quality_flags FROM t WHERE id <> '' AND sid <> '' AND title <> '' AND d <> '' AND u <> ''"""


def evidence_from_text(spark: SparkSession, root: str) -> DataFrame:
    t = load(spark, root, "announcement_text")
    return evidence.evidence_from("ashare.announcement_text", t).select("claim", "value_json", "unit", "period", F.col("source_ref.source_url").alias("source_url"))


EVIDENCE_TEXT_SQL = """WITH t AS (SELECT trim(coalesce(announcement_id, '')) AS id, trim(coalesce(security_id, '')) AS sid, trim(coalesce(security_name, '')) AS sn, trim(coalesce(title, '')) AS title, trim(coalesce(publish_date, '')) AS d, trim(coalesce(source_url, '')) AS u, text_length AS n, trim(coalesce(parse_status, '')) AS s FROM announcement_text)
SELECT 'CNINFO official PDF text was extracted for ' || CASE WHEN sn <> '' THEN sn ELSE sid END || ' (' || sid || ') announcement ''' || title || ''' disclosed on ' || d || '; text_length=' || coalesce(CAST(n AS VARCHAR), '') || '.' AS claim,
  CAST(n AS VARCHAR) AS value_json, 'characters' AS unit, d AS period, u AS source_url FROM t WHERE s = 'ok' AND id <> '' AND sid <> '' AND title <> '' AND d <> '' AND u <> ''"""


def evidence_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Records of later batches whose content id is new: not in the history, and the first of its kind."""
    e = load(spark, root, "evidence_records").withColumn("content_id", evidence.evidence_id())
    batch = e.where(F.col("batch_no") > 0).select("content_id", "record_no", "claim")
    return evidence.new_records(batch, e.where(F.col("batch_no") == 0), id_column="content_id", ordinal="record_no").select("record_no", "claim")


DEDUP_SQL = """WITH e AS (SELECT record_no, batch_no, claim, hash(struct_pack(a := claim, b := topic, c := source_ref.source_type, d := source_ref.source_name, e := source_ref.source_url, f := source_ref.published_at, g := metric, h := period, i := value_json)) AS k FROM evidence_records),
n AS (SELECT * FROM e WHERE batch_no > 0 QUALIFY row_number() OVER (PARTITION BY k ORDER BY record_no) = 1)
SELECT record_no, claim FROM n WHERE k NOT IN (SELECT k FROM e WHERE batch_no = 0)"""


def evidence_validate(spark: SparkSession, root: str) -> DataFrame:
    e = evidence.problems(load(spark, root, "evidence_records"))
    return e.groupBy(F.coalesce("problem", F.lit("valid")).alias("problem")).agg(F.count(F.lit(1)).alias("records"))


VALIDATE_SQL = """WITH p AS (SELECT CASE WHEN trim(coalesce(claim, '')) = '' THEN 'claim is required' WHEN trim(coalesce(topic, '')) = '' THEN 'topic is required' WHEN coalesce(confidence, '') NOT IN ('low', 'medium', 'high') THEN 'invalid confidence'
  WHEN coalesce(source_ref.source_type, '') NOT IN ('regulator', 'exchange', 'company_filing', 'company_ir', 'official', 'official_platform', 'industry_association', 'gov_policy', 'price_index', 'tender_platform', 'vendor', 'media', 'research_report', 'other') THEN 'invalid source_type'
  WHEN coalesce(maturity, '') NOT IN ('fetched', 'curated', 'inferred') THEN 'invalid maturity'
  WHEN trim(coalesce(source_ref.source_name, '')) = '' THEN 'source.source_name is required' WHEN trim(coalesce(source_ref.source_url, '')) = '' THEN 'source.source_url is required'
  WHEN trim(coalesce(source_ref.published_at, '')) = '' THEN 'source.published_at is required' WHEN trim(coalesce(source_ref.query_time, '')) = '' THEN 'source.query_time is required' ELSE 'valid' END AS problem FROM evidence_records)
SELECT problem, count(*) AS records FROM p GROUP BY 1"""


def evidence_search(spark: SparkSession, root: str) -> DataFrame:
    e = load(spark, root, "evidence_records")
    return evidence.search(e, topic="ANNOUNCEMENT", metric="rev", confidence="high").select("record_no", "evidence_id", "topic", "metric")


SEARCH_SQL = "SELECT record_no, evidence_id, topic, metric FROM evidence_records WHERE contains(lower(topic), 'announcement') AND contains(lower(metric), 'rev') AND contains(lower(confidence), 'high')"


def evidence_profile(spark: SparkSession, root: str) -> DataFrame:
    return evidence.profile(load(spark, root, "evidence_records"))


PROFILE_SQL = """WITH u AS (
  SELECT 'topic' AS "grouping", trim(coalesce(topic, '')) AS key, confidence AS c, source_ref.published_at AS pub FROM evidence_records
  UNION ALL SELECT 'source', trim(coalesce(source_ref.source_type, '')) || ':' || trim(coalesce(source_ref.source_name, '')), confidence, source_ref.published_at FROM evidence_records
  UNION ALL SELECT 'dataset_id', trim(coalesce(dataset_id, '')), confidence, source_ref.published_at FROM evidence_records
  UNION ALL SELECT 'industry', trim(coalesce(industry, '')), confidence, source_ref.published_at FROM evidence_records
  UNION ALL SELECT 'company', trim(coalesce(company, '')), confidence, source_ref.published_at FROM evidence_records
  UNION ALL SELECT 'metric', trim(coalesce(metric, '')), confidence, source_ref.published_at FROM evidence_records)
SELECT "grouping", key, count(*) AS records, count(*) FILTER (c = 'high') AS high, count(*) FILTER (c = 'medium') AS medium, count(*) FILTER (c = 'low') AS low, coalesce(max(pub), '') AS latest_published_at FROM u WHERE key NOT IN ('', ':') GROUP BY 1, 2"""


def evidence_summary(spark: SparkSession, root: str) -> DataFrame:
    return evidence.profile_summary(load(spark, root, "evidence_records"))


SUMMARY_SQL = """SELECT count(*) AS records, count(DISTINCT nullif(trim(topic), '')) AS topics, count(DISTINCT (source_ref.source_type, source_ref.source_name)) AS sources, count(DISTINCT nullif(trim(industry), '')) AS industries,
  count(DISTINCT nullif(trim(company), '')) AS companies, count(DISTINCT nullif(trim(metric), '')) AS metrics, min(nullif(period, '')) AS period_min, max(nullif(period, '')) AS period_max, max(source_ref.published_at) AS latest_published_at FROM evidence_records"""


def source_candidates(spark: SparkSession, root: str) -> DataFrame:
    return evidence.source_candidates(load(spark, root, "evidence_records"), min_records=3)


CANDIDATES_SQL = """SELECT source_ref.source_type AS source_type, source_ref.source_name AS source_name, topic, coalesce(market_scope, '') AS market_scope, coalesce(industry, '') AS industry, coalesce(metric, '') AS metric, coalesce(unit, '') AS unit,
  count(*) AS records, count(DISTINCT period) AS period_count, max(source_ref.published_at) AS latest_published_at, count(*) FILTER (confidence = 'high') AS high, arg_min(claim, record_no) AS sample_claim,
  list_sort(list(DISTINCT period)) AS periods, coalesce(list_sort(list_distinct(flatten(list(coalesce(supports, []))))), []) AS supports, coalesce(list_sort(list(DISTINCT source_ref.source_url) FILTER (trim(coalesce(source_ref.source_url, '')) <> ''))[1:5], []) AS source_urls,
  coalesce(list(evidence_id ORDER BY record_no) FILTER (evidence_id IS NOT NULL), [])[1:20] AS evidence_ids, count(evidence_id) AS evidence_ids_total
FROM evidence_records WHERE trim(coalesce(metric, '')) <> '' AND trim(coalesce(period, '')) <> '' AND value_json IS NOT NULL AND trim(coalesce(dataset_id, '')) = '' GROUP BY 1, 2, 3, 4, 5, 6, 7 HAVING count(*) >= 3"""


def relation_search(spark: SparkSession, root: str) -> DataFrame:
    r = load(spark, root, "relation_snapshots")
    return relations.search(r, subject="company:1001", predicate="controlled", tag="curated").select("snapshot_date", "relation_id", "received_at")


RELATION_SEARCH_SQL = """SELECT snapshot_date, relation_id, received_at FROM relation_snapshots WHERE (contains(lower(subject.entity_id), 'company:1001') OR contains(lower(subject."name"), 'company:1001')) AND contains(lower(predicate), 'controlled') AND list_contains(tags, 'curated')"""


def relation_profile(spark: SparkSession, root: str) -> DataFrame:
    return relations.profile(load(spark, root, "relation_snapshots"))


RELATION_PROFILE_SQL = """WITH r AS (SELECT *, CASE WHEN trim(coalesce(source_ref.evidence_id, '')) <> '' THEN 'evidence_id' WHEN trim(coalesce(source_ref.raw_ref, '')) <> '' THEN 'raw_ref' WHEN trim(coalesce(source_ref.source_url, '')) <> '' THEN 'source_url' ELSE 'unknown' END AS ref FROM relation_snapshots),
u AS (SELECT 'predicate' AS facet, predicate AS key FROM r UNION ALL SELECT 'confidence', confidence FROM r UNION ALL SELECT 'subject_type', subject.entity_type FROM r UNION ALL SELECT 'object_type', object_ref.entity_type FROM r
  UNION ALL SELECT 'source_ref', ref FROM r UNION ALL SELECT 'tag', unnest(tags) FROM r)
SELECT facet, key, count(*) AS records FROM u WHERE key IS NOT NULL GROUP BY 1, 2"""


def relation_validate(spark: SparkSession, root: str) -> DataFrame:
    r = relations.problems(load(spark, root, "relation_snapshots"))
    return r.groupBy(F.coalesce("problem", F.lit("valid")).alias("problem")).agg(F.count(F.lit(1)).alias("records"))


RELATION_VALIDATE_SQL = """WITH t AS (SELECT subject.entity_type AS st, object_ref.entity_type AS ot, trim(coalesce(subject.entity_id, '')) AS si, trim(coalesce(object_ref.entity_id, '')) AS oi, trim(coalesce(subject."name", '')) AS sn, trim(coalesce(object_ref."name", '')) AS onm, predicate, confidence,
  trim(coalesce(source_ref.evidence_id, '')) AS e, trim(coalesce(source_ref.raw_ref, '')) AS w, trim(coalesce(source_ref.source_url, '')) AS u, trim(coalesce(source_ref.source_name, '')) AS n, trim(coalesce(source_ref.published_at, '')) AS p, trim(coalesce(source_ref.query_time, '')) AS q FROM relation_snapshots),
v AS (SELECT *, ['company', 'issuer', 'security', 'filing_entity', 'industry', 'industry_chain_node', 'product', 'theme', 'evidence_source_group', 'region', 'country', 'peer_group', 'controller'] AS types,
  ['alias_of', 'belongs_to', 'has_component', 'has_product_exposure', 'maps_to_concept', 'preferred_source_for', 'supplies_to', 'listed_as', 'has_filing_id', 'customer_of', 'supplier_to', 'competes_with', 'same_group_as', 'maps_to_overseas_peer', 'has_revenue_exposure', 'has_geographic_exposure', 'controlled_by'] AS preds FROM t)
SELECT CASE WHEN NOT coalesce(list_contains(types, st), false) THEN 'invalid subject entity_type' WHEN NOT coalesce(list_contains(types, ot), false) THEN 'invalid object entity_type' WHEN si = '' THEN 'subject.entity_id is required' WHEN oi = '' THEN 'object.entity_id is required'
  WHEN sn = '' THEN 'subject.name is required' WHEN onm = '' THEN 'object.name is required' WHEN NOT coalesce(list_contains(preds, predicate), false) THEN 'invalid predicate' WHEN coalesce(confidence, '') NOT IN ('low', 'medium', 'high') THEN 'invalid confidence'
  WHEN e = '' AND w = '' AND u = '' THEN 'source requires evidence_id, raw_ref, or source_url' WHEN u <> '' AND (n = '' OR p = '' OR q = '') THEN 'source_url requires source_name, published_at, and query_time' ELSE 'valid' END AS problem, count(*) AS records FROM v GROUP BY 1"""


def relation_entities(spark: SparkSession, root: str) -> DataFrame:
    return relations.entities(load(spark, root, "relation_snapshots"))


ENTITIES_SQL = """SELECT entity_type, entity_id, name, count(*) AS records FROM (SELECT subject.entity_type AS entity_type, subject.entity_id AS entity_id, subject."name" AS name FROM relation_snapshots UNION ALL SELECT object_ref.entity_type, object_ref.entity_id, object_ref."name" FROM relation_snapshots) GROUP BY 1, 2, 3"""


def top_entities(spark: SparkSession, root: str) -> DataFrame:
    return relations.top_entities(load(spark, root, "relation_snapshots"), 20)


TOP_SQL = f"SELECT * FROM ({ENTITIES_SQL}) ORDER BY records DESC, entity_id DESC, entity_type DESC, name DESC LIMIT 20"


def relation_neighborhood(spark: SparkSession, root: str) -> DataFrame:
    r = load(spark, root, "relation_snapshots")
    return relations.neighbourhood(r, "theme:m7").select("snapshot_date", "relation_id", "received_at", "direction")


NEIGHBOUR_SQL = """WITH t AS (SELECT *, contains(lower(subject.entity_id), 'theme:m7') OR contains(lower(subject."name"), 'theme:m7') AS o, contains(lower(object_ref.entity_id), 'theme:m7') OR contains(lower(object_ref."name"), 'theme:m7') AS i FROM relation_snapshots)
SELECT snapshot_date, relation_id, received_at, CASE WHEN o AND i THEN 'both' WHEN o THEN 'outgoing' ELSE 'incoming' END AS direction FROM t WHERE o OR i"""


def alias_index(spark: SparkSession, root: str) -> DataFrame:
    return relations.alias_terms(load(spark, root, "relation_snapshots"))


ALIAS_SQL = """WITH e AS (SELECT DISTINCT subject AS s FROM relation_snapshots UNION SELECT DISTINCT object_ref FROM relation_snapshots),
t AS (SELECT unnest([lower(s.entity_id), lower(s."name"), CASE WHEN contains(s.entity_id, ':') THEN lower(split_part(s.entity_id, ':', -1)) END]) AS term, s.entity_type AS entity_type, s.entity_id AS entity_id, s."name" AS name, s.market_scope AS market_scope FROM e)
SELECT DISTINCT * FROM t WHERE coalesce(term, '') <> ''"""


def announcement_search(spark: SparkSession, root: str) -> DataFrame:
    a = load(spark, root, "announcements")
    return textsearch.announcement_search(a, keywords=["2024", "report"], first_day="20250701", last_day="20260331").select("record_no", "title")


_HAS = lambda w: "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{w}')" for c in textsearch.SEARCH_COLUMNS) + ")"
ANNOUNCEMENT_SQL = f"SELECT record_no, title FROM announcements WHERE publish_date BETWEEN '20250701' AND '20260331' AND {_HAS('2024')} AND {_HAS('report')}"


def announcement_category(spark: SparkSession, root: str) -> DataFrame:
    a = load(spark, root, "announcements")
    parts = [textsearch.announcement_search(a, category=c).select("record_no", F.lit(c).alias("category")) for c in ("财务报告", "重大事项")]
    return parts[0].unionByName(parts[1])


CATEGORY_SQL = " UNION ALL ".join(f"SELECT record_no, '{c}' AS category FROM announcements WHERE " + " OR ".join(_HAS(w.lower()) for w in textsearch.CATEGORIES[c]) for c in ("财务报告", "重大事项"))


def announcement_newest(spark: SparkSession, root: str) -> DataFrame:
    """The fifty newest announcements: a top-k report."""
    a = load(spark, root, "announcements")
    return textsearch.newest_first(a.select("publish_date", "announcement_id").distinct(), 50)


NEWEST_SQL = "SELECT DISTINCT publish_date, announcement_id FROM announcements ORDER BY publish_date DESC NULLS LAST, announcement_id DESC NULLS LAST LIMIT 50"


def announcement_newest_instant(spark: SparkSession, root: str) -> DataFrame:
    """The fifty announcements last published by the clock, whatever way their times are written."""
    a = load(spark, root, "announcements").select("record_no", "publish_date", "announcement_id", "publish_time", F.when(F.col("publish_time").isNotNull(), ANNOUNCEMENT_SOURCE).alias("source_name"))
    timed = normalise_instants(a, load(spark, root, "source_clocks"), value="publish_time", source="source_name")
    return textsearch.newest_first(timed, 50, instant="utc_us").select("record_no", "publish_date", "announcement_id", "utc_us")


def snippet_candidates(spark: SparkSession, root: str) -> DataFrame:
    t = load(spark, root, "announcement_text")
    return textsearch.snippets(t, "Contract", context=20, keep=("fetch_no",))


SNIPPET_SQL = r"""WITH t AS (SELECT fetch_no, trim(text, E' ') AS t FROM announcement_text WHERE trim(coalesce(parse_status, '')) IN ('', 'ok') AND trim(coalesce(text, '')) <> ''),
p AS (SELECT fetch_no, t, string_split(lower(t), 'contract') AS p FROM t WHERE contains(lower(t), 'contract')),
i AS (SELECT fetch_no, t, p, unnest(range(1, len(p))) AS k FROM p),
s AS (SELECT fetch_no, t, CAST(list_sum(list_transform(p[1:k], lambda x: length(x))) + (k - 1) * 8 AS INTEGER) AS a FROM i)
SELECT fetch_no, a AS match_start, a + 8 AS match_end, t[a + 1 : a + 8] AS match_text, greatest(a - 20, 0) AS snippet_start, CAST(least(a + 28, length(t)) AS INTEGER) AS snippet_end, t[greatest(a - 20, 0) + 1 : least(a + 28, length(t))] AS snippet FROM s"""


def quote_parse(spark: SparkSession, root: str) -> DataFrame:
    """Quote texts made of parts, two quotes a text, parsed back."""
    p = load(spark, root, "part")
    blank = F.lit("")
    fields = [blank] * 36
    fields[1], fields[2], fields[3], fields[4] = F.col("p_name"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.col("p_retailprice").cast("string"), F.lit("-")
    fields[5], fields[6], fields[30], fields[32], fields[35] = F.lit("12.5"), F.lit("100"), F.lit("20260601093000"), F.lit("x1"), F.concat(F.lit("1/"), F.col("p_size").cast("string"), F.lit("/7.5"))
    one = F.concat(F.lit('v_sh6'), F.lpad(F.col("p_partkey").cast("string"), 5, "0"), F.lit('="'), F.concat_ws("~", *fields), F.lit('";'))
    payload = p.select(F.concat(one, F.lit('\nv_sz000001="too~short";')).alias("body"))
    q = parsers.local_quotes(payload, "body", snapshot_at="2026-06-01T09:30:05+08:00", source_url="recorded")
    return q.select("security_id", "name", "code", "price", "prev_close", "open", "volume", "amount", "pct_chg", "quote_time")


QUOTE_SQL = """SELECT '6' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') || '.SH' AS security_id, p_name AS name, lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, p_retailprice AS price, NULL::DOUBLE AS prev_close, 12.5::DOUBLE AS "open", p_size::DOUBLE AS volume, 7.5::DOUBLE AS amount, NULL::DOUBLE AS pct_chg, '2026-06-01T09:30:00+08:00' AS quote_time FROM part"""


def global_quote_parse(spark: SparkSession, root: str) -> DataFrame:
    p = load(spark, root, "part")
    fields = [F.lit("")] * 40
    fields[1], fields[2], fields[3], fields[35], fields[36] = F.col("p_name"), F.col("p_partkey").cast("string"), F.col("p_retailprice").cast("string"), F.lit("USD"), F.col("p_size").cast("string")
    hk = F.col("p_partkey") % 2 == 0
    symbol = F.when(hk, F.concat(F.lit("r_hk"), F.lpad(F.col("p_partkey").cast("string"), 5, "0"))).otherwise(F.concat(F.lit("usAB"), F.col("p_partkey").cast("string")))
    payload = p.select(F.concat(F.lit("v_"), symbol, F.lit('="'), F.concat_ws("~", *fields), F.lit('";')).alias("body"))
    q = parsers.global_quotes(payload, "body", snapshot_at="t", source_url="recorded")
    return q.select("symbol", "market", "code", "name", "price", "volume", "currency")


GLOBAL_SQL = """SELECT CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 5, '0') || '.HK' ELSE 'AB' || p_partkey END AS symbol, CASE WHEN p_partkey % 2 = 0 THEN 'hk' ELSE 'us' END AS market, CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_retailprice AS price, p_size::DOUBLE AS volume, 'USD' AS currency FROM part"""


def _documents(spark: SparkSession, root: str) -> DataFrame:
    """Submissions JSON per customer: parallel arrays of their orders, the documents' array one short."""
    o = load(spark, root, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")))).alias("os"))
    arr = lambda f: F.transform("os", f)
    docs = F.transform("os", lambda x: F.concat(F.lit("doc"), x["o_orderkey"].cast("string"), F.lit(".htm")))
    recent = F.struct(
        arr(lambda x: x["o_orderstatus"]).alias("form"), arr(lambda x: x["d"]).alias("filingDate"), arr(lambda x: F.concat(F.lit("0-"), x["o_orderkey"].cast("string"))).alias("accessionNumber"), F.slice(docs, 1, F.size(docs) - 1).alias("primaryDocument")
    )
    return o.select(F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"), F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings"))).alias("body"))


def sec_filings_flatten(spark: SparkSession, root: str) -> DataFrame:
    return parsers.filings(_documents(spark, root), "body", "cik").select("cik", "form", "filing_date", "accession_number", "primary_document", "source_url")


FILINGS_SQL = """WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderstatus, o_orderdate) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
d AS (SELECT *, CASE WHEN i < n THEN 'doc' || lead(o_orderkey, 0) OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderstatus, o_orderdate) || '.htm' ELSE '' END AS doc FROM o)
SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, o_orderstatus AS form, strftime(o_orderdate, '%Y-%m-%d') AS filing_date, '0-' || o_orderkey AS accession_number, doc AS primary_document,
  CASE WHEN doc <> '' THEN 'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/0' || o_orderkey || '/' || doc ELSE '' END AS source_url FROM d"""


def companyfacts_flatten(spark: SparkSession, root: str) -> DataFrame:
    c = load(spark, root, "customer")
    fact = lambda end, v: F.struct(F.lit(end).alias("end"), F.lit("10-K").alias("form"), v.alias("val"))
    unit = F.create_map(F.lit("USD"), F.array(fact("2025-12-31", F.col("c_acctbal")), fact("2024-12-31", F.col("c_acctbal") * 2)))
    concept = F.create_map(F.lit("Cash"), F.struct(F.col("c_name").alias("label"), unit.alias("units")))
    body = F.to_json(F.struct(F.col("c_name").alias("entityName"), F.create_map(F.lit("us-gaap"), concept).alias("facts")))
    return parsers.company_facts(c.select(F.col("c_custkey").cast("string").alias("cik"), body.alias("body")), "body", "cik").select("cik", "entity_name", "taxonomy", "concept", "label", "unit", "start_date", "end_date", "form", "value")


FACTS_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS cik, c_name AS entity_name, 'us-gaap' AS taxonomy, 'Cash' AS concept, c_name AS label, 'USD' AS unit, '' AS start_date, f.e AS end_date, '10-K' AS form, c_acctbal * f.m AS value FROM customer, (VALUES ('2025-12-31', 1.0), ('2024-12-31', 2.0)) f(e, m)"""


def ticker_cik(spark: SparkSession, root: str) -> DataFrame:
    s = load(spark, root, "supplier")
    item = F.struct(F.col("s_suppkey").cast("string").alias("cik_str"), F.lower("s_name").alias("ticker"), F.when(F.col("s_suppkey") % 5 > 0, F.col("s_name")).alias("title"))
    body = F.when(F.col("s_suppkey") % 2 == 0, F.to_json(F.array(item))).otherwise(F.to_json(F.create_map(F.lit("0"), item)))
    return parsers.ticker_map(s.select(body.alias("body")), "body")


TICKER_SQL = """SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, upper(s_name) AS ticker, s_name AS title, 'https://www.sec.gov/edgar/browse/?CIK=' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS source_url FROM supplier WHERE s_suppkey % 5 > 0"""


def announcement_index(spark: SparkSession, root: str) -> DataFrame:
    """Pages of an index under one another, each announcement_id once, the first row standing."""
    a = load(spark, root, "announcements").select("announcement_id", "record_no", "title", "publish_date")
    return parsers.first_seen(a, "announcement_id", ["record_no"])


INDEX_SQL = "SELECT announcement_id, record_no, title, publish_date FROM announcements QUALIFY row_number() OVER (PARTITION BY announcement_id ORDER BY record_no) = 1"


def epoch_iso(spark: SparkSession, root: str) -> DataFrame:
    e = load(spark, root, "events")
    seconds = F.unix_date(F.to_date("ts")).cast("bigint") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    return e.select("event_id", milliseconds_iso(seconds * 1000).alias("at"))


EPOCH_SQL = "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS at FROM events"


def json_source(spark: SparkSession, root: str) -> DataFrame:
    """Records of a JSON document by path and field map."""
    e = load(spark, root, "evidence_records")
    doc = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("record_no").alias("no"), F.struct(F.col("claim").alias("text")).alias("body"))).alias("rows")).alias("data")))
    return parsers.select_records(e.select(doc.alias("doc")), "doc", "data.rows", {"record_no": "no", "claim": "body.text", "absent": "nowhere"})


JSON_SOURCE_SQL = "SELECT CAST(record_no AS VARCHAR) AS record_no, claim, NULL::VARCHAR AS absent FROM evidence_records"


def latest_text(spark: SparkSession, root: str) -> DataFrame:
    """The text of each announcement as last fetched."""
    t = load(spark, root, "announcement_text").select("announcement_id", "fetch_no", "publish_date", "parse_status", "text_length")
    return keep_last(t, ["announcement_id"], ordinal="fetch_no")


LATEST_TEXT_SQL = "SELECT announcement_id, fetch_no, publish_date, parse_status, text_length FROM announcement_text QUALIFY row_number() OVER (PARTITION BY announcement_id ORDER BY coalesce(publish_date, '') DESC, fetch_no DESC) = 1"


def announced_names(spark: SparkSession, root: str) -> DataFrame:
    """Names a security was announced under, with the first and last day of each."""
    a = load(spark, root, "announcements").where(F.col("security_id").isNotNull() & F.col("security_name").isNotNull() & F.col("publish_date").isNotNull())
    per = a.groupBy("security_id", "security_name").agg(F.min("publish_date").alias("first_day"), F.max("publish_date").alias("last_day"), F.count(F.lit(1)).alias("announcements"))
    w = Window.partitionBy("security_id").orderBy("first_day", "security_name")
    return per.withColumn("name_no", F.row_number().over(w))


NAMES_SQL = """WITH p AS (SELECT security_id, security_name, min(publish_date) AS first_day, max(publish_date) AS last_day, count(*) AS announcements FROM announcements WHERE security_id IS NOT NULL AND security_name IS NOT NULL AND publish_date IS NOT NULL GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY first_day, security_name) AS name_no FROM p"""


QUERIES = {
    "evidence_from_table": evidence_from_table, "evidence_from_text": evidence_from_text, "evidence_dedup": evidence_dedup, "evidence_validate": evidence_validate, "evidence_search": evidence_search,
    "evidence_profile": evidence_profile, "evidence_summary": evidence_summary, "source_candidates": source_candidates, "relation_search": relation_search, "relation_profile": relation_profile,
    "relation_validate": relation_validate, "relation_entities": relation_entities, "top_entities": top_entities, "relation_neighborhood": relation_neighborhood, "alias_index": alias_index,
    "announcement_search": announcement_search, "announcement_category": announcement_category, "announcement_newest": announcement_newest, "snippet_candidates": snippet_candidates,
    "quote_parse": quote_parse, "global_quote_parse": global_quote_parse, "sec_filings_flatten": sec_filings_flatten, "companyfacts_flatten": companyfacts_flatten, "ticker_cik": ticker_cik,
    "announcement_index": announcement_index, "epoch_iso": epoch_iso, "json_source": json_source, "latest_text": latest_text, "announced_names": announced_names, "announcement_newest_instant": announcement_newest_instant,
}
SQL = {
    "evidence_from_table": EVIDENCE_SQL, "evidence_from_text": EVIDENCE_TEXT_SQL, "evidence_dedup": DEDUP_SQL, "evidence_validate": VALIDATE_SQL, "evidence_search": SEARCH_SQL,
    "evidence_profile": PROFILE_SQL, "evidence_summary": SUMMARY_SQL, "source_candidates": CANDIDATES_SQL, "relation_search": RELATION_SEARCH_SQL, "relation_profile": RELATION_PROFILE_SQL,
    "relation_validate": RELATION_VALIDATE_SQL, "relation_entities": ENTITIES_SQL, "top_entities": TOP_SQL, "relation_neighborhood": NEIGHBOUR_SQL, "alias_index": ALIAS_SQL,
    "announcement_search": ANNOUNCEMENT_SQL, "announcement_category": CATEGORY_SQL, "announcement_newest": NEWEST_SQL, "snippet_candidates": SNIPPET_SQL,
    "quote_parse": QUOTE_SQL, "global_quote_parse": GLOBAL_SQL, "sec_filings_flatten": FILINGS_SQL, "companyfacts_flatten": FACTS_SQL, "ticker_cik": TICKER_SQL,
    "announcement_index": INDEX_SQL, "epoch_iso": EPOCH_SQL, "json_source": JSON_SOURCE_SQL, "latest_text": LATEST_TEXT_SQL, "announced_names": NAMES_SQL,
}
