"""Contract-shaped views of the plain test tables, in Spark and, as CTEs, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import load

AS_OF, WINDOW = "20240129", 20


def bars(spark: SparkSession, root: str, entity: str = "user_id", name: str = "security_id") -> DataFrame:
    """Daily bars of an event entity: volume, amount, close and the clamped change in percent."""
    e = load(spark, root, "events")
    key = {"user_id": F.col("user_id"), "event_type": F.col("event_type"), "k10": kay() % 10, "k25": kay() % 25}[entity]
    day = e.select(key.cast("string").alias(name), F.date_format("ts", "yyyyMMdd").alias("trade_date"), "event_id", "value")
    per = day.groupBy(name, "trade_date").agg(F.count(F.lit(1)).alias("volume"), F.round(F.sum("value"), 4).alias("amount"), F.max_by("value", "event_id").alias("close"))
    w = Window.partitionBy(name).orderBy("trade_date")
    pct = F.round(100 * (F.try_divide("close", F.lag("close").over(w)) - 1), 4)
    return per.withColumn("pct_chg", F.greatest(F.least(pct, F.lit(10.0)), F.lit(-10.0))).withColumn("raw_pct", pct)


def kay():
    return F.get_json_object("props", "$.k").cast("int")


def calendar(spark: SparkSession, root: str) -> DataFrame:
    """Days of the events as a trading calendar; Sundays are closed."""
    e = load(spark, root, "events").select(F.to_date("ts").alias("d")).distinct()
    return e.select(F.lit("SSE").alias("exchange"), F.date_format("d", "yyyyMMdd").alias("cal_date"), F.when(F.dayofweek("d") == 1, "0").otherwise("1").alias("is_open"))


def bars_sql(entity: str = "user_id", name: str = "security_id", cte: str = "bars") -> str:
    key = {"user_id": "CAST(user_id AS VARCHAR)", "event_type": "event_type", "k10": "CAST(CAST(props->>'k' AS INT) % 10 AS VARCHAR)", "k25": "CAST(CAST(props->>'k' AS INT) % 25 AS VARCHAR)"}[entity]
    return f"""{cte}_d AS (SELECT {key} AS {name}, strftime(ts, '%Y%m%d') AS trade_date, count(*) AS volume, round(sum(value), 4) AS amount, arg_max(value, event_id) AS close FROM events GROUP BY 1, 2),
{cte}_p AS (SELECT *, round(100 * (close / nullif(lag(close) OVER (PARTITION BY {name} ORDER BY trade_date), 0) - 1), 4) AS raw_pct FROM {cte}_d),
{cte} AS (SELECT *, CASE WHEN raw_pct IS NOT NULL THEN greatest(least(raw_pct, 10.0), -10.0) END AS pct_chg FROM {cte}_p)"""


def window_sql(cte: str = "bars", out: str = "win", as_of: str = AS_OF, window: int = WINDOW) -> str:
    return f"""{out} AS (SELECT * FROM {cte} WHERE trade_date IN (
  SELECT DISTINCT strftime(ts, '%Y%m%d') AS d FROM events WHERE dayofweek(ts) <> 0 AND strftime(ts, '%Y%m%d') <= '{as_of}' ORDER BY d DESC LIMIT {window}))"""


def rank_sql(column: str, part: str = "") -> str:
    by = f"PARTITION BY {part}" if part else ""
    ties = f"PARTITION BY {part + ', ' if part else ''}{column}"
    return f"""CASE WHEN count(*) OVER ({by}) <= 1 THEN 1.0 WHEN {column} IS NULL THEN 0.0 ELSE
  (rank() OVER ({by} ORDER BY {column} ASC NULLS LAST) + (count(*) OVER ({ties}) - 1) / 2.0) / count({column}) OVER ({by}) END"""
