"""Queries over contracts: search with weights, status roll-up, JSON walks."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weight of a hit in any of a group of fields.
FIELD_GROUPS: tuple[tuple[int, tuple[str, ...]], ...] = (
    (20, ("dataset_id",)),
    (10, ("domain", "role")),
    (9, ("allowed", "forbidden")),
    (7, ("partition_keys", "primary_key")),
    (6, ("required_columns", "analysis_columns")),
    (6, ("source_ids", "recipes")),
    (5, ("apis",)),
)
READY_BONUS = 3

# Words a query stands for besides itself.
ALIASES: dict[str, tuple[str, ...]] = {
    "日线": ("daily", "ashare.daily", "trade_date", "close", "pct_chg"),
    "行情": ("daily", "quote", "price", "close", "pct_chg"),
    "交易日": ("trade_calendar", "calendar", "is_open"),
    "股票池": ("stock_basic", "identity", "list_status"),
    "身份": ("stock_basic", "company_profile", "name_changes", "identity", "reference"),
    "公司资料": ("company_profile", "profile", "main_business", "office"),
    "曾用名": ("name_changes", "alias", "historical stock names"),
    "财务": ("financial", "income", "balance", "cash_flow", "indicator", "financial_analysis"),
    "三表": ("income_statement", "balance_sheet", "cash_flow"),
    "利润": ("income_statement", "n_income", "revenue"),
    "现金流": ("cash_flow", "n_cashflow_act"),
    "主营": ("main_business", "segment", "company_business_exposure"),
    "公告": ("announcement", "cninfo", "official", "disclosure", "evidence"),
    "研报": ("report", "eastmoney_report_index", "industry_evidence"),
    "行业": ("industry", "sw", "ci", "industry_members", "industry_strength"),
    "概念": ("concept", "dc_index", "concept_members", "ths_concept"),
    "题材": ("concept", "theme", "limit_concept", "kpl_concept", "ths_concept"),
    "涨停": ("limit", "price_limits", "limit_list", "limit_step", "kpl"),
    "连板": ("limit_step", "limit_up_days", "kpl"),
    "热榜": ("hot_rank", "ths_hot", "dc_hot", "attention"),
    "人气": ("hot_rank", "heat", "rank"),
    "龙虎榜": ("top_list", "reason"),
    "资金": ("moneyflow", "net_amount", "north_money", "south_money"),
    "资金流": ("moneyflow", "net_amount", "net_mf_amount", "north_money", "south_money"),
    "北向": ("hsgt", "northbound", "connect", "north_money"),
    "陆股通": ("northbound", "hsgt", "connect"),
    "融资融券": ("margin", "rzye", "rqye"),
    "两融": ("margin", "rzye", "rqye"),
    "筹码": ("chip", "cyq", "winner_rate", "cost"),
    "股东": ("shareholder", "holder", "pledge", "ownership"),
    "质押": ("pledge", "share_pledge"),
    "增减持": ("shareholder_trades", "holdertrade", "change_vol"),
    "回购": ("repurchase", "buyback", "volume", "amount"),
    "大宗": ("block_trades", "buyer", "seller"),
    "指数": ("index", "index_daily", "index_weights", "weight"),
    "跨市场": ("global", "sec", "cross_market"),
    "美股": ("global", "sec", "ticker_cik", "companyfacts"),
    "sec": ("sec", "filings", "companyfacts", "ticker_cik"),
    "盘中": ("intraday", "snapshot", "provisional"),
    "当前行情": ("intraday", "snapshot", "provisional"),
    "当前": ("intraday", "snapshot", "provisional"),
    "实时": ("intraday", "snapshot", "provisional"),
    "实时行情": ("intraday", "snapshot", "provisional"),
}
SEVERITY = ("ok", "ready", "passed", "warning", "not_evaluated", "degraded", "missing", "blocked")


def search_terms(query: str) -> list[str]:
    """Words of a query in lower case, the whole query, and what its aliases stand for, each once.

    Short Latin aliases must be a word of the query, others may stand anywhere in it.
    """
    whole = query.strip().lower()
    words = whole.replace(",", " ").replace("，", " ").split()
    terms = [*words, whole]
    for alias, more in ALIASES.items():
        if alias in (words if alias.isascii() and alias.isalnum() and len(alias) <= 3 else whole):
            terms += more
    return [t for t in dict.fromkeys(terms) if t]


def search_contracts(contracts: DataFrame, terms: Sequence[str]) -> DataFrame:
    """dataset_id, score, hits: per term the weights of the groups of fields that hold it; best first.

    Fields that ``contracts`` lacks are passed over; a column ``status`` adds READY_BONUS to what is ready.
    Terms are literal and letter case doesn't matter; blank terms are dropped; datasets without a hit have no row.
    """
    wanted = [t.strip().lower() for t in terms if t.strip()]
    kinds = dict(contracts.dtypes)
    as_text = lambda c: F.lower(F.concat_ws("\n", c) if kinds[c].startswith("array") else F.coalesce(F.col(c), F.lit("")))
    score, hits = F.lit(0), F.lit(0)
    for t in wanted:
        for weight, fields in FIELD_GROUPS:
            hit = F.lit(False)
            for c in fields:
                hit = hit | as_text(c).contains(t) if c in kinds else hit
            score, hits = score + F.when(hit, weight).otherwise(0), hits + F.when(hit, 1).otherwise(0)
    bonus = F.when(F.col("status") == "ready", READY_BONUS).otherwise(0) if "status" in kinds else F.lit(0)
    return contracts.select("dataset_id", (score + bonus).alias("score"), hits.alias("hits")).where(F.col("hits") > 0).orderBy(F.desc("score"), "dataset_id")


def permits(use: str) -> Column:
    return F.array_contains("allowed", use) & ~F.array_contains("forbidden", use)


def severity(status: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), status).cast("int"), F.lit(0))


def roll_up(rows: DataFrame, by: Sequence[str], status: str = "status") -> DataFrame:
    """Worst status per group: blocked, then degraded (also for warnings and what wasn't evaluated), else ok."""
    worst = F.max(severity(F.col(status)))
    named = F.when(worst >= SEVERITY.index("missing") + 1, "blocked").when(worst >= SEVERITY.index("warning") + 1, "degraded").otherwise("ok")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("checks"), named.alias("status"))


def parse_ref(ref: Column) -> tuple[Column, Column]:
    """``id:k=v,k=v`` as (id, map)."""
    tail = F.when(ref.contains(":"), F.regexp_replace(ref, "^[^:]*:", "")).otherwise("")
    pairs = F.filter(F.split(tail, ","), lambda p: p.contains("="))
    return F.substring_index(ref, ":", 1), F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1), F.regexp_replace(p, "^[^=]*=", ""))))


def walk_objects(docs: DataFrame, key: str, column: str) -> DataFrame:
    """Every object in JSON documents, at any depth: key, path, object (as JSON). Unreadable documents have none."""
    kind = docs.schema[key].dataType.simpleString()

    def inside(value, path: str) -> Iterator[tuple[str, str]]:
        stack = [(value, path)]
        while stack:
            v, p = stack.pop()
            if isinstance(v, dict):
                yield p, json.dumps(v, ensure_ascii=False, sort_keys=True)
                stack += [(x, f"{p}.{k}") for k, x in reversed(v.items())]
            elif isinstance(v, list):
                stack += [(x, f"{p}[{i}]") for i, x in reversed(list(enumerate(v)))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, raw in zip(pdf["k"], pdf["j"], strict=True):
                try:
                    value = json.loads(raw) if raw else None
                except ValueError:
                    continue
                rows += [(k, p, o) for p, o in inside(value, "$")]
            yield pd.DataFrame(rows, columns=["k", "path", "object"])

    return docs.select(F.col(key).alias("k"), F.col(column).alias("j")).mapInPandas(run, f"k {kind}, path string, object string").withColumnRenamed("k", key)


def latest_weights(rows: DataFrame, snapshot_date: str) -> DataFrame:
    """All rows of each index on its latest weight date, in the snapshot's columns, heaviest first."""
    rows = rows.where(F.col("trade_date").isNotNull())
    last = rows.groupBy(F.col("index_code").alias("_i")).agg(F.max(F.col("trade_date").cast("string")).alias("_d"))
    kept = rows.join(last, (F.col("index_code") == F.col("_i")) & (F.col("trade_date").cast("string") == F.col("_d")))
    out = kept.select(F.lit(snapshot_date).alias("snapshot_date"), F.col("index_code").alias("index_id"), F.col("con_code").alias("security_id"), F.col("trade_date").alias("weight_trade_date"), "weight")
    return out.orderBy("index_id", F.desc("weight"), "security_id")
