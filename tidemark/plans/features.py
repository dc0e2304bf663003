"""Feature queries over the event views, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features as ops
from tidemark.operators.quality import feature_quality
from tidemark.operators.windows import last_partitions, strict_window, window_coverage
from tidemark.plans.views import AS_OF, WINDOW, bars, bars_sql, calendar, kay, rank_sql, window_sql
from tidemark.session import load


def _window(rows: DataFrame, spark: SparkSession, root: str, window: int = WINDOW) -> DataFrame:
    return strict_window(rows, calendar(spark, root), AS_OF, window)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def daily_momentum(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(ops.daily_momentum(_window(bars(spark, root), spark, root), as_of=AS_OF, window=WINDOW))


_R = lambda c: f"round({c}, 6) AS {c}"

MOMENTUM_SQL = f"""WITH {bars_sql()}, {window_sql()},
g AS (SELECT security_id, (product(1 + coalesce(pct_chg, 0) / 100.0) - 1) * 100.0 AS ret, coalesce(avg(amount), 0) AS avg_amount, max(trade_date) AS d FROM win GROUP BY 1),
l AS (SELECT g.*, coalesce(w.pct_chg, 0) AS latest_pct_chg, CAST(w.volume AS DOUBLE) AS latest_volume, coalesce(w.amount, 0) AS latest_amount
      FROM g JOIN win w ON w.security_id = g.security_id AND w.trade_date = g.d WHERE g.d = (SELECT max(trade_date) FROM win)),
x AS (SELECT *, round(CASE WHEN avg_amount <> 0 THEN latest_amount / avg_amount - 1 ELSE 0 END, 10) AS amount_excess, round(ret, 10) AS window_return_pct FROM l),
r AS (SELECT *, {rank_sql("window_return_pct")} AS return_rank, {rank_sql("amount_excess")} AS amount_rank FROM x)
SELECT '{AS_OF}' AS as_of, {WINDOW} AS "window", security_id, d AS latest_trade_date, {_R("latest_pct_chg")}, {_R("latest_volume")}, {_R("latest_amount")}, {_R("avg_amount")},
  {_R("amount_excess")}, {_R("window_return_pct")}, 'ashare.daily' AS source_dataset, 'final' AS finality, {_R("return_rank")}, {_R("amount_rank")},
  round(return_rank * 70.0 + amount_rank * 30.0, 6) AS momentum_score FROM r"""


def market_strength(spark: SparkSession, root: str) -> DataFrame:
    rows = _window(bars(spark, root, "event_type", "index_id"), spark, root)
    e = load(spark, root, "events").where(F.date_format("ts", "yyyyMMdd") == AS_OF)
    basic = e.groupBy(F.col("event_type").alias("index_id")).agg(F.round(F.sum("value"), 4).alias("total_mv")).withColumn("trade_date", F.lit(AS_OF))
    return _rounded(ops.market_strength(rows, basic, as_of=AS_OF, window=WINDOW))


def _strength_sql(cte: str, activity: str, source: str, out: str) -> str:
    return f"""{out}_g AS (SELECT index_id, (product(1 + coalesce(pct_chg, 0) / 100.0) - 1) * 100.0 AS ret, coalesce(avg({activity}), 0) AS a, max(trade_date) AS d FROM {cte} GROUP BY 1),
{out}_l AS (SELECT g.*, w.close AS latest_close, coalesce(w.pct_chg, 0) AS latest_pct_chg, CAST(coalesce(w.{activity}, 0) AS DOUBLE) AS la FROM {out}_g g JOIN {cte} w ON w.index_id = g.index_id AND w.trade_date = g.d
   WHERE g.d = (SELECT max(trade_date) FROM {cte})),
{out}_x AS (SELECT *, round(CASE WHEN a <> 0 THEN la / a - 1 ELSE 0 END, 10) AS activity_excess, round(ret, 10) AS window_return_pct FROM {out}_l),
{out}_r AS (SELECT *, {rank_sql("window_return_pct")} AS return_rank, {rank_sql("activity_excess")} AS activity_rank FROM {out}_x),
{out} AS (SELECT '{AS_OF}' AS as_of, {WINDOW} AS "window", '{source}' AS source_dataset, index_id, d AS latest_trade_date, {_R("latest_close")}, {_R("latest_pct_chg")}, round(la, 6) AS latest_{activity}, round(a, 6) AS avg_{activity},
   {_R("activity_excess")}, {_R("window_return_pct")}, 'final' AS finality, {_R("return_rank")}, {_R("activity_rank")}, round(return_rank * 75.0 + activity_rank * 25.0, 6) AS strength_score FROM {out}_r)"""


MARKET_SQL = f"""WITH {bars_sql("event_type", "index_id")}, {window_sql()}, {_strength_sql("win", "amount", "ashare.index_daily", "s")},
mv AS (SELECT event_type, round(sum(value), 4) AS total_mv FROM events WHERE strftime(ts, '%Y%m%d') = '{AS_OF}' GROUP BY 1)
SELECT s.*, mv.total_mv AS latest_total_mv FROM s LEFT JOIN mv ON s.index_id = mv.event_type"""


def industry_strength(spark: SparkSession, root: str) -> DataFrame:
    first = _window(bars(spark, root, "event_type", "index_id"), spark, root)
    second = _window(bars(spark, root, "k10", "index_id"), spark, root)
    return _rounded(ops.industry_strength(first, second, as_of=AS_OF, window=WINDOW))


INDUSTRY_SQL = f"""WITH {bars_sql("event_type", "index_id", "b1")}, {window_sql("b1", "w1")}, {bars_sql("k10", "index_id", "b2")}, {window_sql("b2", "w2")},
{_strength_sql("w1", "volume", "ashare.sw_daily", "s1")}, {_strength_sql("w2", "volume", "ashare.ci_daily", "s2")}
SELECT * FROM s1 UNION ALL SELECT * FROM s2"""


def concept_strength(spark: SparkSession, root: str) -> DataFrame:
    rows = _window(bars(spark, root, "k25", "concept_id"), spark, root).withColumn("name", F.concat(F.lit("C"), "concept_id"))
    return _rounded(ops.concept_strength(rows, as_of=AS_OF, window=WINDOW))


CONCEPT_SQL = f"""WITH {bars_sql("k25", "concept_id")}, {window_sql()},
g AS (SELECT concept_id, (product(1 + coalesce(pct_chg, 0) / 100.0) - 1) * 100.0 AS ret, max(trade_date) AS d FROM win GROUP BY 1),
l AS (SELECT g.*, coalesce(w.pct_chg, 0) AS latest_pct_chg, round(g.ret, 10) AS window_return_pct FROM g JOIN win w ON w.concept_id = g.concept_id AND w.trade_date = g.d WHERE g.d = (SELECT max(trade_date) FROM win)),
r AS (SELECT *, {rank_sql("window_return_pct")} AS return_rank, {rank_sql("latest_pct_chg")} AS latest_rank FROM l)
SELECT '{AS_OF}' AS as_of, {WINDOW} AS "window", concept_id, 'C' || concept_id AS name, d AS latest_trade_date, {_R("latest_pct_chg")}, {_R("window_return_pct")}, 'ashare.dc_index' AS source_dataset, 'final' AS finality,
  {_R("return_rank")}, {_R("latest_rank")}, round(return_rank * 80.0 + latest_rank * 20.0, 6) AS strength_score FROM r"""


def limit_sentiment(spark: SparkSession, root: str) -> DataFrame:
    b = bars(spark, root)
    limits = b.where(F.abs("raw_pct") >= 10).select("security_id", "trade_date", F.when(F.col("raw_pct") >= 10, "U").otherwise("D").alias("limit"))
    e = load(spark, root, "events").where(F.col("event_type") == "purchase")
    tag = F.when(kay() % 5 == 0, "首板").otherwise(F.concat((kay() % 9 + 1).cast("string"), F.lit("天"), (kay() % 4 + 1).cast("string"), F.lit("板")))
    pool = e.select(F.date_format("ts", "yyyyMMdd").alias("trade_date"), tag.alias("board_tag"), (kay() % 3).alias("open_num"), F.col("value").alias("limit_order"), (F.col("value") * 1e6).alias("limit_amount"))
    return _rounded(ops.limit_sentiment(_window(limits, spark, root), _window(pool, spark, root), as_of=AS_OF, window=WINDOW))


SENTIMENT_SQL = f"""WITH {bars_sql()}, lim AS (SELECT trade_date, CASE WHEN raw_pct >= 10 THEN 'U' ELSE 'D' END AS lim FROM bars WHERE abs(raw_pct) >= 10), {window_sql("lim", "wl")},
pool AS (SELECT strftime(ts, '%Y%m%d') AS trade_date, CAST(props->>'k' AS INT) AS k, value FROM events WHERE event_type = 'purchase'), {window_sql("pool", "wp")},
a AS (SELECT trade_date, count(*) FILTER (lim = 'U') AS up, count(*) FILTER (lim = 'D') AS down FROM wl GROUP BY 1),
b AS (SELECT trade_date, count(*) AS n, avg(k % 3) AS o, sum(value) AS s, sum(value * 1e6) AS m, max(CASE WHEN k % 5 = 0 THEN 1 ELSE k % 4 + 1 END) AS h FROM wp GROUP BY 1),
j AS (SELECT coalesce(a.trade_date, b.trade_date) AS trade_date, coalesce(up, 0) AS up, coalesce(down, 0) AS down, coalesce(n, 0) AS n, coalesce(o, 0.0) AS o, coalesce(s, 0.0) AS s, coalesce(m, 0.0) AS m, coalesce(h, 0) AS h FROM a FULL JOIN b ON a.trade_date = b.trade_date)
SELECT '{AS_OF}' AS as_of, {WINDOW} AS "window", trade_date, up AS limit_up_count, down AS limit_down_count, n AS ths_limit_up_count, round(o, 6) AS avg_open_num, round(s, 6) AS limit_order_sum, round(m, 6) AS limit_amount_sum, h AS max_board_height,
  round(up * 2.0 - down * 3.0 + n * 2.0 + h * 10.0 + least(m / 1e8, 50.0) - o, 6) AS sentiment_score, 'ashare.limit_list_d+ashare.limit_list_ths' AS source_dataset, 'final' AS finality FROM j"""


def report_attention(spark: SparkSession, root: str) -> DataFrame:
    """Documents as report indexes: publication dates as query dates, the last 20 of them."""
    d = load(spark, root, "documents").where(F.col("publish_date").isNotNull())
    reports = d.select(F.lower("source").alias("industry_name"), F.col("doc_id").alias("report_id"), F.col("lang").alias("source_name"), F.col("publish_date").alias("published_at"), F.col("publish_date").alias("query_date"))
    recent = last_partitions(reports, ["query_date"], 20, as_of="20260630")
    return _rounded(ops.report_attention(recent, as_of="20260630", window=20))


ATTENTION_SQL = f"""WITH p AS (SELECT DISTINCT publish_date FROM documents WHERE publish_date <= '20260630' ORDER BY 1 DESC LIMIT 20),
r AS (SELECT trim(lower(source)) AS industry_name, doc_id, lang, publish_date FROM documents WHERE publish_date IN (SELECT publish_date FROM p) AND trim(coalesce(source, '')) <> ''),
g AS (SELECT industry_name, count(DISTINCT doc_id) AS report_count, count(DISTINCT lang) AS source_count, max(publish_date) AS latest_report_at FROM r GROUP BY 1)
SELECT '20260630' AS as_of, 20 AS "window", industry_name, report_count, source_count, latest_report_at, round(({rank_sql("report_count")}) * 100.0, 6) AS attention_score FROM g"""


def coverage(spark: SparkSession, root: str) -> DataFrame:
    """Strict calendar coverage of the event types taken as datasets, with a gap on every day of month divisible by 7 for one of them."""
    e = load(spark, root, "events")
    meta = e.select(F.col("event_type").alias("dataset_id"), F.date_format("ts", "yyyyMMdd").alias("partition_date")).distinct()
    gap = (F.col("dataset_id") == "error") & (F.substring("partition_date", 7, 2).cast("int") % 7 == 0)
    meta = meta.where(~gap).withColumn("quality_status", F.when(F.col("dataset_id") == "view", "degraded").otherwise("ok"))
    return window_coverage(meta, calendar(spark, root), AS_OF, WINDOW)


COVERAGE_SQL = f"""WITH m AS (SELECT DISTINCT event_type AS dataset_id, strftime(ts, '%Y%m%d') AS day FROM events),
k AS (SELECT *, CASE WHEN dataset_id = 'view' THEN 'degraded' ELSE 'ok' END AS q FROM m WHERE NOT (dataset_id = 'error' AND CAST(substr(day, 7, 2) AS INT) % 7 = 0)),
d AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS day FROM events WHERE dayofweek(ts) <> 0 AND strftime(ts, '%Y%m%d') <= '{AS_OF}' ORDER BY 1 DESC LIMIT {WINDOW}),
g AS (SELECT s.dataset_id, d.day, k.q FROM (SELECT DISTINCT dataset_id FROM k) s CROSS JOIN d LEFT JOIN k ON k.dataset_id = s.dataset_id AND k.day = d.day),
a AS (SELECT dataset_id, count(q) AS available, count(*) AS expected, list_sort(coalesce(list(day) FILTER (q IS NULL), [])) AS missing, min(day) AS first_day, max(day) AS last_day, coalesce(bool_or(q <> 'ok'), false) AS bad FROM g GROUP BY 1)
SELECT dataset_id, {WINDOW} AS required_window, available, expected, missing, first_day, last_day,
  CASE WHEN available = 0 THEN 'missing' WHEN len(missing) > 0 OR expected < {WINDOW} THEN 'partial_window' WHEN bad THEN 'degraded_input' ELSE 'ok' END AS status FROM a"""


def available_window(spark: SparkSession, root: str) -> DataFrame:
    """Coverage by the last partitions there are, of announcements by security's exchange board."""
    a = load(spark, root, "announcements")
    meta = a.select(F.col("column_id").alias("dataset_id"), F.col("publish_date").alias("partition_date")).where(F.col("dataset_id").isNotNull() & F.col("partition_date").isNotNull()).distinct().withColumn("quality_status", F.lit("ok"))
    return window_coverage(meta, calendar(spark, root), "20260601", 60, strict=False).drop("missing")


AVAILABLE_SQL = """WITH m AS (SELECT DISTINCT column_id AS dataset_id, publish_date AS day FROM announcements WHERE column_id IS NOT NULL AND publish_date IS NOT NULL),
k AS (SELECT * FROM m WHERE day <= '20260601' QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY day DESC) <= 60),
a AS (SELECT dataset_id, count(*) AS available, min(day) AS first_day, max(day) AS last_day FROM k GROUP BY 1)
SELECT s.dataset_id, 60 AS required_window, coalesce(available, 0) AS available, 60 AS expected, first_day, last_day,
  CASE WHEN coalesce(available, 0) = 0 THEN 'missing' WHEN available < 60 THEN 'partial_window' ELSE 'ok' END AS status FROM (SELECT DISTINCT dataset_id FROM m) s LEFT JOIN a USING (dataset_id)"""


def quality_of_feature(spark: SparkSession, root: str) -> DataFrame:
    frame = load(spark, root, "daily_momentum")
    inputs = {"ashare.daily": ("required", "ok"), "ashare.index_daily_basic": ("degrade_if_missing", "missing")}
    return _rounded(feature_quality(frame, ["window_return_pct", "momentum_score", "security_id"], inputs))


FEATURE_QUALITY_SQL = """WITH a AS (SELECT count(*) AS n, least(count(window_return_pct) / count(*)::DOUBLE, count(momentum_score) / count(*)::DOUBLE, count(security_id) / count(*)::DOUBLE, 1.0) AS low FROM daily_momentum)
SELECT 'degraded' AS status, CASE WHEN n = 0 THEN 'empty feature partition' WHEN low < 0.8 THEN 'analysis columns below non-null threshold' ELSE 'degraded feature inputs' END AS reason, n AS rows, round(low, 6) AS lowest_ratio FROM a"""


QUERIES = {
    "daily_momentum": daily_momentum,
    "market_strength": market_strength,
    "industry_strength": industry_strength,
    "concept_strength": concept_strength,
    "limit_sentiment": limit_sentiment,
    "report_attention": report_attention,
    "window_coverage": coverage,
    "available_window": available_window,
    "feature_quality": quality_of_feature,
}
SQL = {
    "daily_momentum": MOMENTUM_SQL,
    "market_strength": MARKET_SQL,
    "industry_strength": INDUSTRY_SQL,
    "concept_strength": CONCEPT_SQL,
    "limit_sentiment": SENTIMENT_SQL,
    "report_attention": ATTENTION_SQL,
    "window_coverage": COVERAGE_SQL,
    "available_window": AVAILABLE_SQL,
    "feature_quality": FEATURE_QUALITY_SQL,
}
