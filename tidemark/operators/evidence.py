"""Evidence records: made from tables, validated, deduplicated by hash, searched and profiled."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import CONFIDENCES, MATURITIES, SOURCE_TYPES
from tidemark.functions.exprs import canonical_hash, matches, text


def evidence_id(columns: list[str] | None = None) -> Column:
    """Content id of a record: claim, topic, source without its query time, metric, period and value."""
    src = [F.col(f"source_ref.{f}") for f in ("source_type", "source_name", "source_url", "published_at")]
    return canonical_hash(F.col("claim"), F.col("topic"), *src, F.col("metric"), F.col("period"), F.col("value_json"))


def problems(record: DataFrame) -> DataFrame:
    """Records with ``problem``: the first rule a record breaks, null if it is valid."""
    blank = lambda c: text(F.col(c)) == ""
    rules = [
        (blank("claim"), "claim is required"),
        (blank("topic"), "topic is required"),
        (~F.coalesce(F.col("confidence").isin(*CONFIDENCES), F.lit(False)), "invalid confidence"),
        (~F.coalesce(F.col("source_ref.source_type").isin(*SOURCE_TYPES), F.lit(False)), "invalid source_type"),
        (~F.coalesce(F.col("maturity").isin(*MATURITIES), F.lit(False)), "invalid maturity"),
        *[(blank(f"source_ref.{f}"), f"source.{f} is required") for f in ("source_name", "source_url", "published_at", "query_time")],
    ]
    out = F.lit(None).cast("string")
    for cond, message in reversed(rules):
        out = F.when(cond, message).otherwise(out)
    return record.withColumn("problem", out)


def new_records(batch: DataFrame, existing: DataFrame, *, id_column: str, ordinal: str) -> DataFrame:
    """Rows of a batch whose id is not there yet; of equal ids within the batch the first by ``ordinal``.

    Null ids stand for nothing and are kept out. The first row of an id is a map-side-combined struct
    minimum; the history enters only with its ids.
    """
    rest = [c for c in batch.columns if c not in (id_column, ordinal)]
    first = batch.where(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.min(F.struct(ordinal, *rest)).alias("_r"))
    rows = first.select(*[F.col(c) if c == id_column else F.col(f"_r.{c}").alias(c) for c in batch.columns])
    return rows.join(existing.select(id_column).distinct(), id_column, "left_anti").select(*batch.columns)


def search(records: DataFrame, *, limit: int = 0, **filters: str | None) -> DataFrame:
    """Records whose columns hold the filters as substrings (letter case apart), latest first; ``limit`` of 0 or less is none."""
    for column, wanted in filters.items():
        records = records.where(matches(F.col(column), wanted))
    out = records.orderBy(F.desc(F.coalesce("source_ref.published_at", F.lit(""))), F.desc(F.coalesce("evidence_id", F.lit(""))))
    return out.limit(limit) if limit > 0 else out


# The groupings of a profile.
PROFILE_GROUPS = ("topic", "source", "dataset_id", "industry", "company", "metric")


def profile(records: DataFrame) -> DataFrame:
    """Group rows of the six one-key groupings in one pass: grouping, key, records, high, medium, low, latest_published_at.

    Blank keys have no row. One aggregation over the exploded keys; the counts of confidences are sums.
    """
    source = F.concat(text(F.col("source_ref.source_type")), F.lit(":"), text(F.col("source_ref.source_name")))
    keys = F.array(*[F.struct(F.lit(g).alias("grouping"), (source if g == "source" else text(F.col(g))).alias("key")) for g in PROFILE_GROUPS])
    rows = records.select(F.explode(keys).alias("k"), "confidence", F.col("source_ref.published_at").alias("at")).select("k.grouping", "k.key", "confidence", "at").where((F.col("key") != "") & (F.col("key") != ":"))
    level = lambda c: F.count_if(F.col("confidence") == c).alias(c)
    return rows.groupBy("grouping", "key").agg(F.count(F.lit(1)).alias("records"), level("high"), level("medium"), level("low"), F.coalesce(F.max("at"), F.lit("")).alias("latest_published_at"))


def profile_summary(records: DataFrame) -> DataFrame:
    """One row: records, distinct topics, sources, industries, companies and metrics, the range of periods and the latest publication."""
    distinct = lambda c: F.countDistinct(F.when(text(F.col(c)) != "", F.col(c)))
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        distinct("topic").alias("topics"),
        F.countDistinct(F.struct("source_ref.source_type", "source_ref.source_name")).alias("sources"),
        distinct("industry").alias("industries"),
        distinct("company").alias("companies"),
        distinct("metric").alias("metrics"),
        F.min(F.when(F.col("period") != "", F.col("period"))).alias("period_min"),
        F.max(F.when(F.col("period") != "", F.col("period"))).alias("period_max"),
        F.max("source_ref.published_at").alias("latest_published_at"),
    )


def source_candidates(records: DataFrame, *, min_records: int = 3, ordinal: str = "record_no") -> DataFrame:
    """Groups of numeric records without a dataset, by source, topic, scope, industry, metric and unit, of at least ``min_records``.

    Beside the counts: all periods and supports (both of few values), the first five source URLs, the first twenty evidence ids in the order of
    ``ordinal``, and the claim of the first record. Longer lists are cut before they are collected.
    """
    filled = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    usable = records.where((text(F.col("metric")) != "") & (text(F.col("period")) != "") & F.col("value_json").isNotNull() & (text(F.col("dataset_id")) == ""))
    flat = usable.select(
        F.col("source_ref.source_type").alias("source_type"), F.col("source_ref.source_name").alias("source_name"), "topic", filled("market_scope"), filled("industry"), filled("metric"), filled("unit"),
        "period", F.col("source_ref.published_at").alias("at"), F.col("source_ref.source_url").alias("_url"), "evidence_id", "supports", "confidence", "claim", F.col(ordinal).alias("_n"),
    )
    keys = ["source_type", "source_name", "topic", "market_scope", "industry", "metric", "unit"]
    agg = flat.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("period").alias("period_count"), F.array_sort(F.collect_set("period")).alias("periods"), F.max("at").alias("latest_published_at"),
        F.count_if(F.col("confidence") == "high").alias("high"), F.min_by("claim", "_n").alias("sample_claim"), F.count("evidence_id").alias("evidence_ids_total"),
    )
    agg = agg.where(F.col("records") >= min_records)
    supports = flat.select(*keys, F.explode("supports").alias("s")).groupBy(*keys).agg(F.array_sort(F.collect_set("s")).alias("supports"))
    urls = _firsts(flat.where(text(F.col("_url")) != "").select(*keys, F.col("_url").alias("v")).distinct().withColumn("o", F.col("v")), keys, 5, "source_urls")
    ids = _firsts(flat.where(F.col("evidence_id").isNotNull()).select(*keys, F.col("evidence_id").alias("v"), F.col("_n").alias("o")), keys, 20, "evidence_ids")
    for more in (supports, urls, ids):
        name = more.columns[-1]
        other = more.select(*[F.col(k).alias(f"_{k}") for k in keys], name)
        agg = agg.join(other, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left").drop(*[f"_{k}" for k in keys]).withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return agg.orderBy(F.desc("records"), F.desc("period_count"), F.desc("latest_published_at"), *keys)


def _firsts(rows: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """Per group the first ``n`` values ``v`` by ``o``, as an array; the window drops the rest before anything is collected."""
    kept = rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("o", "v"))).where(F.col("_k") <= n)
    ordered = F.array_sort(F.collect_list(F.struct("_k", "v")))
    return kept.groupBy(*keys).agg(F.transform(ordered, lambda x: x["v"]).alias(name))


# --- evidence from tables -------------------------------------------------------------------------


@dataclass(frozen=True)
class ClaimSpec:
    """How rows of one dataset become records. Columns may be missing; a row lacking any of ``needs`` gives none."""

    topic: str
    confidence: str
    source_type: str
    source_name: str
    needs: tuple[str, ...]
    claim: Callable[[Callable[[str], Column]], Column]
    market_scope: str = "cn_ashare"
    company: str = ""
    metric: str = ""
    value: str = ""
    unit: str = ""
    period: str = ""
    published: str = ""
    url: str = ""
    verification: str = ""
    supports: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    only_ok: bool = False


def _cat(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _opt(value: Column, before: str = "", after: str = "") -> Column:
    return F.when(value != "", _cat(before, value, after)).otherwise("")


def _metrics(*names: str, none: str = "") -> Callable[[Callable[[str], Column]], Column]:
    return lambda v: F.coalesce(F.nullif(F.concat_ws(", ", *[F.when(v(n) != "", _cat(f"{n}=", v(n))) for n in names]), F.lit("")), F.lit(none))


def _financial(topic: str, *names: str) -> ClaimSpec:
    listed = _metrics(*names, none="no key metric populated")
    return ClaimSpec(
        topic, "medium", "vendor", f"Tushare Pro {topic}", ("security_id", "period"), lambda v: _cat(f"Tushare {topic} reports ", v("security_id"), " period ", v("period"), ": ", listed(v), "."),
        company="security_id", period="period", published="ann_date|period", url="https://tushare.pro/", verification="vendor_financial_statement_interface", supports=("evidence", "financial_analysis"), flags=("requires_official_filing_cross_check",),
    )


_EVENT = {"url": "https://tushare.pro/", "verification": "vendor_structured_event_interface", "flags": ("requires_official_announcement_text", "not_company_business_exposure")}

# Claims by dataset, in the wording that readers of the records expect.
CLAIMS: dict[str, ClaimSpec] = {
    "global.sec_filings": ClaimSpec(
        "sec_filing", "high", "regulator", "SEC EDGAR", ("filing_date", "cik", "form", "accession_number", "source_url"),
        lambda v: _cat("SEC EDGAR records CIK ", v("cik"), " filing form ", v("form"), " with accession ", v("accession_number"), "."),
        market_scope="us", company="CIK {cik}", published="filing_date", verification="official_filing_index", supports=("evidence", "cross_market_context"),
    ),
    "global.sec_ticker_cik": ClaimSpec(
        "sec_ticker_cik", "high", "regulator", "SEC company_tickers", ("cik", "ticker", "title", "source_url"),
        lambda v: _cat("SEC company tickers mapping lists ticker ", v("ticker"), " for CIK ", v("cik"), " (", v("title"), ")."),
        market_scope="us", company="title", verification="official_sec_ticker_cik_mapping", supports=("evidence", "cross_market_context"),
    ),
    "global.sec_companyfacts": ClaimSpec(
        "sec_companyfact", "high", "regulator", "SEC companyfacts", ("cik", "concept", "unit", "end_date", "filed_date", "source_url"),
        lambda v: _cat("SEC companyfacts reports ", v("entity_name"), " (", v("cik"), ") ", v("label"), "=", v("value"), " ", v("unit"), " for period ending ", v("end_date"), ", filed ", v("filed_date"), _opt(v("form"), " on form "), "."),
        market_scope="us", company="entity_name", metric="concept", value="value", unit="unit", period="end_date", published="filed_date", verification="official_sec_xbrl_companyfacts",
        supports=("evidence", "financial_analysis", "cross_market_context"), flags=("xbrl_fact_requires_concept_context",), defaults={"entity_name": "CIK {cik}", "label": "{concept}"},
    ),
    "industry.eastmoney_report_index": ClaimSpec(
        "industry_report", "low", "research_report", "{source_name}", ("report_id", "title", "source_url", "published_at"),
        lambda v: _cat("Eastmoney report index lists industry report '", v("title"), "' for ", F.when(v("industry_name") != "", v("industry_name")).otherwise("unknown industry"), "."),
        published="published_at[:10]", verification="vendor_report_index", supports=("context", "evidence"), flags=("report_is_not_company_disclosure",), defaults={"source_name": "Eastmoney Report API"},
    ),
    "ashare.main_business": ClaimSpec(
        "main_business_segment", "medium", "vendor", "Tushare Pro fina_mainbz", ("security_id", "period", "segment_type", "item_name"),
        lambda v: _cat("Tushare fina_mainbz reports ", v("security_id"), " ", v("period"), " ", F.when(v("segment_type") == "P", "product").when(v("segment_type") == "D", "district").otherwise(v("segment_type")), " segment '", v("item_name"), "' with sales ", v("sales"), " ", v("currency"), "."),
        company="security_id", metric="=sales", value="sales", unit="currency", period="period", published="period", url="https://tushare.pro/wctapi/documents/81.md", verification="vendor_financial_statement_interface",
        supports=("evidence", "company_business_exposure"), flags=("requires_official_report_cross_check",), defaults={"currency": "CNY"},
    ),
    "ashare.announcements": ClaimSpec(
        "company_announcement", "high", "official_platform", "CNINFO", ("announcement_id", "security_id", "title", "publish_date", "source_url"),
        lambda v: _cat("CNINFO records ", v("security_name"), " (", v("security_id"), ") announcement '", v("title"), "' disclosed on ", v("publish_date"), "."),
        company="security_name", published="publish_date", verification="official_disclosure_index", supports=("evidence", "context"), flags=("announcement_index_only", "pdf_not_parsed"), defaults={"security_name": "{security_id}"},
    ),
    "ashare.announcement_text": ClaimSpec(
        "company_announcement_text", "high", "company_filing", "CNINFO official announcement PDF", ("announcement_id", "security_id", "title", "publish_date", "source_url"),
        lambda v: _cat("CNINFO official PDF text was extracted for ", v("security_name"), " (", v("security_id"), ") announcement '", v("title"), "' disclosed on ", v("publish_date"), "; text_length=", v("text_length"), "."),
        company="security_name", metric="=text_length", value="text_length", unit="=characters", period="publish_date", published="publish_date", verification="official_pdf_text_extracted",
        supports=("evidence", "context", "company_business_exposure"), flags=("raw_filing_text_requires_claim_extraction",), defaults={"security_name": "{security_id}"}, only_ok=True,
    ),
    "ashare.shareholder_trades": ClaimSpec(
        "shareholder_trade_event", "low", "vendor", "Tushare Pro stk_holdertrade", ("ann_date", "security_id", "holder_name", "in_de"),
        lambda v: _cat("Tushare stk_holdertrade reports ", v("security_id"), " shareholder ", v("holder_name"), _opt(v("holder_type"), " (", ")"), " ", F.when(F.upper(v("in_de")) == "IN", "increase").when(F.upper(v("in_de")) == "DE", "decrease").otherwise(v("in_de")), " event announced on ", v("ann_date"), ": change_vol=", v("change_vol"), " shares", _opt(v("change_ratio"), ", change_ratio=", "%"), _opt(v("avg_price"), ", avg_price=", " CNY/share"), "."),
        company="security_id", metric="=change_vol", value="change_vol", unit="=share", period="ann_date", published="ann_date", supports=("evidence_triage", "market_context"), **_EVENT,
    ),
    "ashare.repurchase_events": ClaimSpec(
        "share_repurchase_event", "low", "vendor", "Tushare Pro repurchase", ("ann_date", "security_id", "process_status"),
        lambda v: _cat("Tushare repurchase reports ", v("security_id"), " share repurchase event announced on ", v("ann_date"), ": process_status=", v("process_status"), _opt(v("end_date"), "; end_date="), _opt(v("volume"), ", volume=", " shares"), _opt(v("amount"), ", amount=", " CNY"), F.when((v("low_limit") != "") | (v("high_limit") != ""), _cat(", price_limit=", v("low_limit"), "-", v("high_limit"), " CNY/share")).otherwise(""), "."),
        company="security_id", metric="=amount", value="amount", unit="=cny", period="ann_date", published="ann_date", supports=("evidence_triage", "market_context"), **_EVENT,
    ),
    "ashare.earnings_forecast_events": ClaimSpec(
        "earnings_forecast_event", "low", "vendor", "Tushare Pro forecast", ("ann_date", "security_id", "period", "forecast_type"),
        lambda v: _cat("Tushare forecast reports ", v("security_id"), " earnings forecast event announced on ", v("ann_date"), " for period ", v("period"), ": forecast_type=", v("forecast_type"), _opt(_metrics("p_change_min", "p_change_max", "net_profit_min", "net_profit_max", "last_parent_net")(v), "; "), _opt(v("forecast_summary"), "; summary="), _opt(v("change_reason"), "; change_reason="), "."),
        company="security_id", period="period", published="ann_date", supports=("evidence_triage", "financial_analysis", "market_context"), **_EVENT,
    ),
    "ashare.income_statement": _financial("income_statement", "total_revenue", "n_income"),
    "ashare.balance_sheet": _financial("balance_sheet", "total_assets", "total_liab"),
    "ashare.cash_flow": _financial("cash_flow", "n_cashflow_act"),
    "ashare.financial_indicator": _financial("financial_indicator", "eps"),
    "ashare.earnings_express": _financial("earnings_express", "revenue", "n_income"),
    "ashare.dividend": _financial("dividend", "div_proc", "cash_div"),
    "ashare.audit_opinion": _financial("audit_opinion", "audit_result", "audit_agency"),
    "ashare.disclosure_date": _financial("disclosure_date", "pre_date", "actual_date"),
    "ashare.earnings_forecast": _financial("earnings_forecast", "forecast_type", "change_reason"),
}


def evidence_from(dataset_id: str, rows: DataFrame, *, query_time: str = "", partition: dict[str, str] | None = None) -> DataFrame:
    """Evidence records of a dataset's rows, with their content id as ``evidence_id``.

    ``partition`` fills columns that are blank. Rows lacking what a claim needs give none; a dataset
    without a claim form gives an empty frame.
    """
    columns = "evidence_id string, claim string, topic string, dataset_id string, market_scope string, company string, metric string, value_json string, unit string, period string, source_ref struct<source_type:string,source_name:string,source_url:string,published_at:string,query_time:string>, confidence string, verification string, supports array<string>, maturity string, quality_flags array<string>"
    spec = CLAIMS.get(dataset_id)
    if spec is None:
        return rows.sparkSession.createDataFrame([], columns)
    fill = partition or {}

    def v(name: str) -> Column:
        if name == "value" and name not in rows.columns:
            return F.lit("")
        got = text(F.col(name)) if name in rows.columns else F.lit("")
        default = fill.get(name) or spec.defaults.get(name)
        if default is None:
            return got
        other = v(default[1:-1]) if default.startswith("{") else _cat(default.split("{")[0], v(default.split("{")[1][:-1])) if "{" in default else F.lit(default)
        return F.when(got != "", got).otherwise(other)

    def pick(what: str) -> Column:
        none = F.lit(None).cast("string")
        if not what:
            return none
        if what.startswith("="):
            return F.lit(what[1:])
        if "{" in what:
            head, name = what.split("{")
            return _cat(head, v(name[:-1]))
        if "|" in what:
            a, b = what.split("|")
            return F.when(v(a) != "", v(a)).otherwise(v(b))
        if what.endswith("[:10]"):
            return F.substring(v(what[:-5]), 1, 10)
        return F.nullif(v(what), F.lit(""))

    kept = rows
    for need in spec.needs:
        kept = kept.where(v(need) != "")
    if spec.only_ok:
        kept = kept.where(v("parse_status") == "ok")
    source = F.struct(
        F.lit(spec.source_type).alias("source_type"),
        pick(spec.source_name if "{" in spec.source_name else "=" + spec.source_name).alias("source_name"),
        (F.lit(spec.url) if spec.url else v("source_url")).alias("source_url"),
        (pick(spec.published) if spec.published else F.lit(query_time[:10] or "on_demand")).alias("published_at"),
        F.lit(query_time).alias("query_time"),
    )
    out = kept.select(
        spec.claim(v).alias("claim"), F.lit(spec.topic).alias("topic"), F.lit(dataset_id).alias("dataset_id"), F.lit(spec.market_scope).alias("market_scope"), pick(spec.company).alias("company"), pick(spec.metric).alias("metric"),
        pick(spec.value).alias("value_json"), pick(spec.unit).alias("unit"), pick(spec.period).alias("period"), source.alias("source_ref"), F.lit(spec.confidence).alias("confidence"), F.lit(spec.verification).alias("verification"),
        F.array(*[F.lit(s) for s in spec.supports]).cast("array<string>").alias("supports"), F.lit("fetched").alias("maturity"), F.array(*[F.lit(s) for s in spec.flags]).cast("array<string>").alias("quality_flags"),
    )
    return out.select(evidence_id().alias("evidence_id"), *out.columns)


def first_per_group(records: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row per group, the first by ``order``."""
    return records.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") == 1).drop("_n")
