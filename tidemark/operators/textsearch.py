"""Keyword search over disclosure indexes and snippet search over their texts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.functions.exprs import contains_any, text

# Columns searched and the words of each category.
SEARCH_COLUMNS = ("title", "short_title", "announcement_type_name", "announcement_type", "security_name")
CATEGORIES: dict[str, tuple[str, ...]] = {
    "全部": (),
    "重大事项": ("重大", "合同", "诉讼", "仲裁", "担保", "投资", "停牌", "复牌"),
    "财务报告": ("年度报告", "半年度报告", "季度报告", "财务", "业绩", "审计"),
    "融资公告": ("发行", "可转债", "募集资金", "增发", "配股", "融资"),
    "风险提示": ("风险", "退市", "ST", "异常波动", "立案", "处罚", "问询"),
    "资产重组": ("重组", "资产购买", "资产出售", "并购", "收购"),
    "信息变更": ("变更", "更正", "修订", "补充", "名称变更"),
    "持股变动": ("减持", "增持", "权益变动", "持股", "股东股份"),
}


def announcement_search(rows: DataFrame, *, keywords: Sequence[str] = (), category: str = "全部", security_id: str | None = None, security_code: str | None = None, org_id: str | None = None, first_day: str | None = None, last_day: str | None = None, lookback: int = 0) -> DataFrame:
    """Announcements that hold every keyword and any word of the category, letter case apart.

    Equality filters and the range of publish_date are plain comparisons, so they reach the scan. ``lookback`` takes the
    so many days that end on ``last_day``, in place of ``first_day``.
    """
    if category not in CATEGORIES:
        raise ValueError(f"invalid announcement category: {category}")
    for column, wanted in (("security_id", security_id), ("security_code", security_code), ("org_id", org_id)):
        if wanted:
            rows = rows.where(F.col(column) == wanted)
    if lookback > 0:
        if first_day or not last_day:
            raise ValueError("lookback needs last_day alone")
        first_day = (datetime.strptime(last_day, "%Y%m%d") - timedelta(days=lookback - 1)).strftime("%Y%m%d")
    if first_day:
        rows = rows.where(F.col("publish_date") >= first_day)
    if last_day:
        rows = rows.where(F.col("publish_date") <= last_day)
    have = [c for c in SEARCH_COLUMNS if c in rows.columns]
    for word in keywords:
        rows = rows.where(contains_any(have, [word]))
    return rows.where(contains_any(have, CATEGORIES[category]))


def newest_first(rows: DataFrame, limit: int = 0, *, instant: str | None = None) -> DataFrame:
    """By instant (unreadable ones last), publish date and id, descending; the first ``limit`` where given.

    ``instant`` is a column of instants that can be ordered, as ``instants.normalise_instants`` gives them for publish times in any
    writing; without one the publish date comes first.
    """
    first = [F.desc_nulls_last(instant)] if instant else []
    out = rows.orderBy(*first, F.desc_nulls_last("publish_date"), F.desc_nulls_last("announcement_id"))
    return out.limit(limit) if limit > 0 else out


def _places(hay: pd.Series, needle: pd.Series) -> pd.Series:
    def one(text: str, word: str) -> list[int]:
        at, found = text.find(word), []
        while at >= 0:
            found.append(at)
            at = text.find(word, at + len(word))
        return found

    return pd.Series([one(t, w) for t, w in zip(hay, needle, strict=True)])


def snippets(rows: DataFrame, query: str, *, context: int = 120, case_sensitive: bool = False, keep: Sequence[str] = ("announcement_id",), limit: int = 0, order: Sequence[str] = (), ordinal: str | None = None) -> DataFrame:
    """Every match of ``query`` in the texts: keep columns, match_start, match_end, match_text, snippet_start, snippet_end, snippet; with
    ``ordinal``, a column that numbers the rows, also row_ref.

    Matches don't overlap and positions count characters of the trimmed text. Rows with a parse_status
    other than ok and blank texts have none. With ``limit`` the first so many, by ``order`` (columns of ``keep``) and place. No shuffle but
    that; texts without the query are filtered in the JVM, the others scanned once, in Arrow batches. Letter case is folded by lower case; where that changes the length of a text, ASCII letters only.
    """
    q = query.strip()
    if not q:
        raise ValueError("query is required")
    if context < 0:
        raise ValueError("context must not be negative")
    status = text(F.col("parse_status"))
    ref = [F.concat(F.lit("row:"), F.col(ordinal).cast("string")).alias("row_ref")] if ordinal else []
    src = rows.where((status == "") | (status == "ok")).select(*keep, *ref, text(F.col("text")).alias("_t")).where(F.col("_t") != "")
    plain = F.translate("_t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")  # where lower case has another length
    hay = F.col("_t") if case_sensitive else F.when(F.length(F.lower("_t")) == F.length("_t"), F.lower("_t")).otherwise(plain)
    needle = q if case_sensitive else q.lower()
    src = src.withColumn("_hay", hay).where(F.contains("_hay", F.lit(needle)))
    n = len(needle)
    keep = [*keep, *["row_ref"] * bool(ordinal)]
    out = src.select(*keep, "_t", F.explode(pandas_udf(_places, "array<int>")("_hay", F.lit(needle))).alias("match_start")).withColumn("match_end", F.col("match_start") + n)
    if limit > 0:
        out = out.orderBy(*order, *[k for k in keep if k not in order], "match_start").limit(limit)
    low = F.greatest(F.col("match_start") - context, F.lit(0))
    high = F.least(F.col("match_end") + context, F.length("_t"))
    return out.select(
        *keep,
        "match_start",
        "match_end",
        F.substr("_t", F.col("match_start") + 1, F.lit(n)).alias("match_text"),
        low.alias("snippet_start"),
        high.alias("snippet_end"),
        F.substr("_t", low + 1, high - low).alias("snippet"),
    )
