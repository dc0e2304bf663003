"""Queries of the data-processing problems whose operators live in the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.history import clean_id, entity_history
from tidemark.operators.instants import normalise_instants
from tidemark.operators.rolling import standing_rows, trailing_totals
from tidemark.session import load

ANNOUNCEMENT_SOURCE = "Juhui Disclosure Platform"


def p1_versions(spark: SparkSession, root: str) -> DataFrame:
    r = load(spark, root, "relation_snapshots")
    rows = r.select(
        F.col("subject.market_scope").alias("scope"),
        clean_id(F.col("subject.entity_id")).alias("subject_id"),
        "predicate",
        clean_id(F.col("object_ref.entity_id")).alias("object_id"),
        "confidence",
        "snapshot_date",
        "received_at",
        "valid_from",
        "valid_to",
    )
    return entity_history(
        rows,
        keys=["subject_id", "predicate"],
        attributes=["object_id", "confidence"],
        snapshot="snapshot_date",
        scope="scope",
        received="received_at",
        stated_from="valid_from",
        stated_to="valid_to",
    )


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return p1_versions(spark, root).select("subject_id", "predicate", "object_id", "confidence", "valid_from", "valid_to").distinct()


P1_SQL = r"""
WITH r AS (
  SELECT subject.market_scope AS scope, nullif(lower(regexp_replace(subject.entity_id, '^\s+|\s+$', '', 'g')), '') AS subject_id, predicate,
         nullif(lower(regexp_replace(object_ref.entity_id, '^\s+|\s+$', '', 'g')), '') AS object_id, confidence, snapshot_date, received_at,
         nullif(trim(valid_from), '') AS sf, nullif(trim(valid_to), '') AS st
  FROM relation_snapshots WHERE snapshot_date IS NOT NULL),
k AS (
  SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY scope, subject_id, predicate, snapshot_date
    ORDER BY received_at DESC NULLS LAST, object_id DESC NULLS LAST, confidence DESC NULLS LAST, sf DESC NULLS LAST, st DESC NULLS LAST) = 1),
c AS (
  SELECT scope, snapshot_date, row_number() OVER w AS seq, lead(snapshot_date) OVER w AS nxt
  FROM (SELECT DISTINCT scope, snapshot_date FROM r) WINDOW w AS (PARTITION BY scope ORDER BY snapshot_date)),
s AS (SELECT k.*, c.seq, c.nxt FROM k JOIN c ON k.scope IS NOT DISTINCT FROM c.scope AND k.snapshot_date = c.snapshot_date),
b AS (
  SELECT *, CASE WHEN lag(seq) OVER w = seq - 1 AND lag(object_id) OVER w IS NOT DISTINCT FROM object_id AND lag(confidence) OVER w IS NOT DISTINCT FROM confidence THEN 0 ELSE 1 END AS starts
  FROM s WINDOW w AS (PARTITION BY scope, subject_id, predicate ORDER BY seq)),
g AS (SELECT *, sum(starts) OVER (PARTITION BY scope, subject_id, predicate ORDER BY seq) AS run FROM b),
v AS (
  SELECT scope, subject_id, predicate, run, arg_min(object_id, seq) AS object_id, arg_min(confidence, seq) AS confidence, min(seq) AS s0, max(seq) AS s1,
         coalesce(min(sf), min(snapshot_date)) AS valid_from, min(st) AS st, max(nxt) FILTER (nxt IS NOT NULL) AS mx, count(*) FILTER (nxt IS NULL) AS is_last
  FROM g GROUP BY ALL)
SELECT DISTINCT subject_id, predicate, object_id, confidence, valid_from,
  coalesce(st, CASE WHEN lead(s0) OVER w = s1 + 1 THEN lead(valid_from) OVER w END, CASE WHEN is_last = 0 THEN mx END, '99991231') AS valid_to
FROM v WINDOW w AS (PARTITION BY scope, subject_id, predicate ORDER BY s0)
"""


def p2_trailing(spark: SparkSession, root: str) -> DataFrame:
    """Trailing 7- and 30-day totals of the 5-day return, for every security and calendar day."""
    m = load(spark, root, "daily_momentum").where(F.col("window_days") == 5)
    rows = standing_rows(m.select("security_id", "as_of", "computed_at", "window_return_pct"), ["security_id", "as_of"], "computed_at", ["window_return_pct"])
    daily = rows.select("security_id", F.unix_date(F.try_to_timestamp("as_of", F.lit("yyyyMMdd")).cast("date")).alias("day_no"), "window_return_pct")
    out = trailing_totals(daily, entity="security_id", day="day_no", value="window_return_pct", periods=(7, 30))
    return out.withColumn("cal_date", F.date_format(F.date_from_unix_date("day_no"), "yyyyMMdd"))


def p2_found(spark: SparkSession, root: str, lead_points: float = 4.0) -> DataFrame:
    """Days on which the 7-day average is at least ``lead_points`` above the 30-day one.

    The difference is rounded to 9 places, so that an exact lead isn't lost to binary fractions.
    """
    t = p2_trailing(spark, root)
    return t.where(F.round(F.col("avg_7") - F.col("avg_30"), 9) >= lead_points).select("security_id", "cal_date")


P2_SQL = """
WITH k AS (
  SELECT security_id, as_of, window_return_pct FROM daily_momentum WHERE window_days = 5
  QUALIFY row_number() OVER (PARTITION BY security_id, as_of ORDER BY computed_at DESC NULLS LAST, window_return_pct DESC NULLS LAST) = 1),
d AS (SELECT security_id, strptime(as_of, '%Y%m%d')::DATE AS day, CASE WHEN isnan(window_return_pct) THEN NULL ELSE window_return_pct END AS v FROM k),
r AS (SELECT security_id, min(day) AS lo, max(day) AS hi FROM d GROUP BY 1),
c AS (SELECT security_id, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM r),
f AS (SELECT c.security_id, c.day, coalesce(d.v, 0) AS v FROM c LEFT JOIN d ON c.security_id IS NOT DISTINCT FROM d.security_id AND c.day = d.day),
t AS (
  SELECT security_id, day, sum(v) OVER (PARTITION BY security_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) / 7 AS a7,
         sum(v) OVER (PARTITION BY security_id ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) / 30 AS a30 FROM f)
SELECT security_id, strftime(day, '%Y%m%d') AS cal_date FROM t WHERE round(a7 - a30, 9) >= 4
"""


def p5_instants(spark: SparkSession, root: str) -> DataFrame:
    """All time values of evidence records and announcements with their instants, null if none."""
    e = load(spark, root, "evidence_records")
    a = load(spark, root, "announcements")
    src = F.col("source_ref.source_name").alias("source_name")
    pair = lambda f: F.struct(F.lit(f).alias("field_name"), F.col(f"source_ref.{f}").alias("value"))
    ev = e.select("record_no", src, F.explode(F.array(pair("published_at"), pair("query_time"))).alias("p")).select("record_no", "p.field_name", "source_name", "p.value")
    an = a.select("record_no", F.lit("publish_time").alias("field_name"), F.lit(ANNOUNCEMENT_SOURCE).alias("source_name"), F.col("publish_time").alias("value"))
    return normalise_instants(ev.unionByName(an), load(spark, root, "source_clocks"), value="value", source="source_name")


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return p5_instants(spark, root).where(F.col("utc_us").isNotNull()).select("record_no", "field_name", "utc_us")


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p5_found": p5_found}
SQL = {"p1_found": P1_SQL, "p2_found": P2_SQL}
