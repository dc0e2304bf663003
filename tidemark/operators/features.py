"""The ranked feature signals. Each takes the rows of one window and gives one cross-section.

Common rules: dates are YYYYMMDD strings; unreadable numbers and NaN are null; an entity without a
row on the latest date of the window is left out, as is a null entity; of several rows of an entity
on that date one stands, the greatest by its values. Empty input gives an empty frame of the full schema. Returns and excesses are
rounded to 10 places before they are ranked, so that equal ones tie on every engine. Cross-sections too large
for one task are ranked over many (see ``ranks.with_ranks``; ``distributed`` sets it).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import board_height, compound_return, excess, safe_num, text
from tidemark.operators.ranks import with_ranks

BUILDERS: dict[str, Callable[..., DataFrame]] = {}


def register_feature(feature_id: str, build: Callable[..., DataFrame]) -> None:
    """Add a feature: a function from window rows to a cross-section."""
    if feature_id in BUILDERS:
        raise ValueError(f"feature registered twice: {feature_id}")
    BUILDERS[feature_id] = build


def build_feature(feature_id: str, *args, **kwargs) -> DataFrame:
    if feature_id not in BUILDERS:
        raise ValueError(f"unknown feature {feature_id!r}")
    return BUILDERS[feature_id](*args, **kwargs)


def _per_entity(rows: DataFrame, entity: str, aggs: list[Column], latest: list[str]) -> DataFrame:
    """Aggregate per entity, with the entity's latest row as struct ``last``; only entities present on the latest date of all.

    The latest date is one value, aggregated map-side from one column of the window rows and broadcast.
    """
    keep = F.max(F.struct("trade_date", *latest)).alias("last")
    rows = rows.where(F.col(entity).isNotNull())
    per = rows.groupBy(entity).agg(*aggs, keep)
    top = rows.agg(F.max("trade_date").alias("_top"))
    return per.join(F.broadcast(top), F.col("last.trade_date") == F.col("_top"), "left_semi")


def _head(as_of: str, window: int) -> list[Column]:
    return [F.lit(as_of).alias("as_of"), F.lit(window).alias("window")]


def daily_momentum(bars: DataFrame, *, as_of: str, window: int, distributed: bool | None = None) -> DataFrame:
    """Compounded return (70) and turnover excess (30) of each security, ranked."""
    rows = bars.select("security_id", F.col("trade_date").cast("string").alias("trade_date"), F.coalesce(safe_num(F.col("pct_chg")), F.lit(0.0)).alias("pct"), safe_num(F.col("amount")).alias("amount"), safe_num(F.col("volume")).alias("volume"))
    per = _per_entity(rows, "security_id", [compound_return(F.col("pct")).alias("ret"), F.coalesce(F.avg("amount"), F.lit(0.0)).alias("avg_amount")], ["pct", "amount", "volume"])
    latest_amount = F.coalesce(F.col("last.amount"), F.lit(0.0))
    out = per.select(
        *_head(as_of, window),
        "security_id",
        F.col("last.trade_date").alias("latest_trade_date"),
        F.col("last.pct").alias("latest_pct_chg"),
        F.col("last.volume").alias("latest_volume"),
        latest_amount.alias("latest_amount"),
        "avg_amount",
        F.round(excess(latest_amount, F.col("avg_amount")), 10).alias("amount_excess"),
        F.round("ret", 10).alias("window_return_pct"),
        F.lit("ashare.daily").alias("source_dataset"),
        F.lit("final").alias("finality"),
    )
    by = ["as_of", "window"]
    out = with_ranks(out, {"return_rank": "window_return_pct", "amount_rank": "amount_excess"}, by, distributed=distributed)
    out = out.withColumn("momentum_score", F.col("return_rank") * 70.0 + F.col("amount_rank") * 30.0)
    return out.orderBy(F.desc("momentum_score"), F.desc("window_return_pct"), "security_id")


def window_strength(bars: DataFrame, *, as_of: str, window: int, source_dataset: str, entity: str, activity: str, distributed: bool | None = None) -> DataFrame:
    """Compounded return (75) and activity excess (25) of each index, ranked within its source."""
    has = set(bars.columns)
    num = lambda c: safe_num(F.col(c)) if c in has else F.lit(None).cast("double")
    rows = bars.select(entity, F.col("trade_date").cast("string").alias("trade_date"), F.coalesce(num("pct_chg"), F.lit(0.0)).alias("pct"), num("close").alias("close"), num(activity).alias("act"))
    per = _per_entity(rows, entity, [compound_return(F.col("pct")).alias("ret"), F.coalesce(F.avg("act"), F.lit(0.0)).alias("avg_act")], ["pct", "close", "act"])
    latest = F.coalesce(F.col("last.act"), F.lit(0.0))
    out = per.select(
        *_head(as_of, window),
        F.lit(source_dataset).alias("source_dataset"),
        entity,
        F.col("last.trade_date").alias("latest_trade_date"),
        F.col("last.close").alias("latest_close"),
        F.col("last.pct").alias("latest_pct_chg"),
        latest.alias(f"latest_{activity}"),
        F.col("avg_act").alias(f"avg_{activity}"),
        F.round(excess(latest, F.col("avg_act")), 10).alias("activity_excess"),
        F.round("ret", 10).alias("window_return_pct"),
        F.lit("final").alias("finality"),
    )
    by = ["as_of", "window", "source_dataset"]
    out = with_ranks(out, {"return_rank": "window_return_pct", "activity_rank": "activity_excess"}, by, distributed=distributed)
    out = out.withColumn("strength_score", F.col("return_rank") * 75.0 + F.col("activity_rank") * 25.0)
    return out.orderBy(F.desc("strength_score"), F.desc("window_return_pct"), entity)


def attach_latest(frame: DataFrame, other: DataFrame, *, key: str, columns: list[str], prefix: str = "latest_") -> DataFrame:
    """Left join with the latest row (by trade_date) of each key of ``other``; missing columns come as null."""
    there = [c for c in columns if c in other.columns]
    latest = other.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max(F.struct(F.col("trade_date").cast("string").alias("_d"), *there)).alias("_r"))
    latest = latest.select("_k", *[(F.col(f"_r.{c}") if c in there else F.lit(None).cast("double")).alias(f"{prefix}{c}") for c in columns])
    return frame.join(latest, F.col(key) == F.col("_k"), "left").drop("_k")


def market_strength(index_bars: DataFrame, index_basic: DataFrame, *, as_of: str, window: int) -> DataFrame:
    """Strength of market indices by amount, with their latest total market value (null where there is none)."""
    out = window_strength(index_bars, as_of=as_of, window=window, source_dataset="ashare.index_daily", entity="index_id", activity="amount")
    basic = index_basic.withColumn("total_mv", safe_num(F.col("total_mv"))) if "total_mv" in index_basic.columns else index_basic
    return attach_latest(out, basic, key="index_id", columns=["total_mv"]).orderBy(F.desc("strength_score"), F.desc("window_return_pct"), "index_id")


def industry_strength(first: DataFrame, second: DataFrame, *, as_of: str, window: int) -> DataFrame:
    """Strength of two industry classifications by volume, each ranked by itself."""
    parts = [window_strength(f, as_of=as_of, window=window, source_dataset=s, entity="index_id", activity="volume") for f, s in ((first, "ashare.sw_daily"), (second, "ashare.ci_daily"))]
    return parts[0].unionByName(parts[1]).orderBy(F.desc("strength_score"), F.desc("window_return_pct"), "source_dataset", "index_id")


def concept_strength(concepts: DataFrame, *, as_of: str, window: int, distributed: bool | None = None) -> DataFrame:
    """Compounded return (80) and latest change (20) of each concept, ranked."""
    rows = concepts.select("concept_id", F.col("trade_date").cast("string").alias("trade_date"), F.coalesce(safe_num(F.col("pct_chg")), F.lit(0.0)).alias("pct"), F.coalesce(F.col("name"), F.lit("")).alias("name"))
    per = _per_entity(rows, "concept_id", [compound_return(F.col("pct")).alias("ret")], ["pct", "name"])
    out = per.select(
        *_head(as_of, window),
        "concept_id",
        F.col("last.name").alias("name"),
        F.col("last.trade_date").alias("latest_trade_date"),
        F.round("last.pct", 10).alias("latest_pct_chg"),
        F.round("ret", 10).alias("window_return_pct"),
        F.lit("ashare.dc_index").alias("source_dataset"),
        F.lit("final").alias("finality"),
    )
    by = ["as_of", "window"]
    out = with_ranks(out, {"return_rank": "window_return_pct", "latest_rank": "latest_pct_chg"}, by, distributed=distributed)
    out = out.withColumn("strength_score", F.col("return_rank") * 80.0 + F.col("latest_rank") * 20.0)
    return out.orderBy(F.desc("strength_score"), F.desc("window_return_pct"), "concept_id")


def limit_sentiment(limit_rows: DataFrame, pool_rows: DataFrame, *, as_of: str, window: int) -> DataFrame:
    """Per date with any row: limit counts, pool figures and the sentiment score."""
    kind = F.coalesce(F.col("limit").cast("string"), F.lit(""))
    sided = lambda code, word: F.sum(F.when(kind == code, 1).otherwise(0) + F.when(kind.contains(word), 1).otherwise(0))
    left = limit_rows.groupBy(F.col("trade_date").cast("string").alias("trade_date")).agg(sided("U", "涨停").alias("up"), sided("D", "跌停").alias("down"))
    num = lambda c: safe_num(F.col(c)) if c in pool_rows.columns else F.lit(None).cast("double")
    height = board_height(F.col("board_tag")) if "board_tag" in pool_rows.columns else F.lit(0)
    right = pool_rows.groupBy(F.col("trade_date").cast("string").alias("trade_date")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(num("open_num")).alias("open"), F.sum(num("limit_order")).alias("orders"), F.sum(num("limit_amount")).alias("amount"), F.max(height).alias("height")
    )
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    part = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    score = whole("up") * 2.0 - whole("down") * 3.0 + whole("n") * 2.0 + whole("height") * 10.0 + F.least(part("amount") / 1e8, F.lit(50.0)) - part("open")
    out = left.join(right, "trade_date", "full").select(
        *_head(as_of, window),
        "trade_date",
        whole("up").alias("limit_up_count"),
        whole("down").alias("limit_down_count"),
        whole("n").alias("ths_limit_up_count"),
        part("open").alias("avg_open_num"),
        part("orders").alias("limit_order_sum"),
        part("amount").alias("limit_amount_sum"),
        whole("height").alias("max_board_height"),
        score.alias("sentiment_score"),
        F.lit("ashare.limit_list_d+ashare.limit_list_ths").alias("source_dataset"),
        F.lit("final").alias("finality"),
    )
    return out.where(F.col("trade_date").isNotNull()).orderBy("trade_date")


def report_attention(reports: DataFrame, *, as_of: str, window: int) -> DataFrame:
    """Distinct reports and sources per industry, ranked by reports; blank industries are left out."""
    rows = reports.withColumn("industry_name", text(F.col("industry_name"))).where(F.col("industry_name") != "")
    per = rows.groupBy("industry_name").agg(F.countDistinct("report_id").alias("report_count"), F.max("published_at").alias("latest_report_at"), F.countDistinct("source_name").alias("source_count"))
    out = per.select(*_head(as_of, window), "industry_name", "report_count", "source_count", "latest_report_at")
    out = with_ranks(out, {"_rank": "report_count"}, ["as_of", "window"]).withColumn("attention_score", F.col("_rank") * 100.0).drop("_rank")
    return out.orderBy(F.desc("attention_score"), F.desc("report_count"), "industry_name")


def close_return(pct: Column, close: Column, order: Column) -> Column:
    """Aggregate: compounded return if any change is known, else last close over first, else 0."""
    have = F.count(pct) > 0
    first, last = F.min_by(close, F.when(close.isNotNull(), order)), F.max_by(close, F.when(close.isNotNull(), order))
    return F.when(have, compound_return(pct)).when((F.count(close) >= 2) & (first != 0), (last / first - 1.0) * 100.0).otherwise(0.0)


for _name, _build in (
    ("ashare.daily_momentum", daily_momentum),
    ("ashare.market_strength", market_strength),
    ("ashare.industry_strength", industry_strength),
    ("ashare.concept_strength", concept_strength),
    ("ashare.limit_sentiment", limit_sentiment),
    ("industry.report_attention", report_attention),
):
    register_feature(_name, _build)
