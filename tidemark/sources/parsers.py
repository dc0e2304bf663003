"""Recorded payloads of sources to rows, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import compact_date, dash_num, exchange_suffix, milliseconds_iso, pad_cik, text

# Addresses of the public filing archive.
ARCHIVE_URL = "https://www.sec.gov/Archives/edgar/data/"
FACTS_URL = "https://data.sec.gov/api/xbrl/companyfacts/CIK"
BROWSE_URL = "https://www.sec.gov/edgar/browse/?CIK="


def _fields(payload: DataFrame, column: str, pattern: str) -> DataFrame:
    """symbol and ~-separated fields of every quote in a response text; quotes of fewer than 35 fields are left out."""
    pairs = F.arrays_zip(F.regexp_extract_all(column, F.lit(pattern), F.lit(1)).alias("symbol"), F.regexp_extract_all(column, F.lit(pattern), F.lit(2)).alias("body"))
    rows = payload.select(F.explode(pairs).alias("p")).select(F.col("p.symbol").alias("symbol"), F.split("p.body", "~").alias("f"))
    return rows.where(F.size("f") >= 35)


def _at(i: int) -> Column:
    return F.coalesce(F.get("f", F.lit(i)), F.lit(""))


def local_quotes(payload: DataFrame, column: str, *, snapshot_at: str, source_url: str) -> DataFrame:
    """Quotes of ``v_sh600000="...";`` texts. The deal triplet ``price/volume/amount`` comes before the single fields."""
    rows = _fields(payload, column, r'(?is)v_([a-z]{2}\d{6})="(.*?)";')
    deal = F.split(_at(35), "/")
    part = lambda i: F.when(F.size(deal) >= 3, dash_num(F.get(deal, F.lit(i))))
    side = F.lower(F.substring("symbol", 1, 2))
    code = F.substring("symbol", 3, 6)
    when = F.trim(_at(30))
    iso = F.regexp_replace(when, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:$6+08:00")
    known = F.when(side.isin("sh", "sz", "bj"), F.concat(code, F.lit("."), F.upper(side))).otherwise(code)
    num = {"price": 3, "prev_close": 4, "open": 5, "change": 31, "pct_chg": 32, "high": 33, "low": 34}
    return rows.select(
        F.lit(snapshot_at).alias("snapshot_at"),
        known.alias("security_id"),
        F.lower("symbol").alias("symbol"),
        _at(1).alias("name"),
        _at(2).alias("code"),
        *[dash_num(_at(i)).alias(c) for c, i in num.items()],
        F.coalesce(part(1), dash_num(_at(6))).alias("volume"),
        F.coalesce(part(2), dash_num(_at(37))).alias("amount"),
        iso.alias("quote_time"),
        F.lit(source_url).alias("source_url"),
    )


def global_quotes(payload: DataFrame, column: str, *, snapshot_at: str, source_url: str) -> DataFrame:
    """Quotes of ``v_usAAPL`` and ``v_r_hk00700`` texts."""
    rows = _fields(payload, column, r'(?s)v_([A-Za-z0-9_]+)="(.*?)";')
    low = F.lower("symbol")
    hk = low.startswith("r_hk")
    symbol = F.when(hk, F.concat(F.substring(low, 5, 100), F.lit(".HK"))).when(low.startswith("us"), F.upper(F.substring("symbol", 3, 100))).otherwise(F.upper("symbol"))
    num = {"price": 3, "prev_close": 4, "open": 5, "amount": 37, "change": 31, "pct_chg": 32, "high": 33, "low": 34}
    return rows.select(
        symbol.alias("symbol"),
        F.when(hk, "hk").otherwise("us").alias("market"),
        _at(2).alias("code"),
        F.when(_at(46) != "", _at(46)).otherwise(_at(1)).alias("name"),
        _at(1).alias("local_name"),
        *[dash_num(_at(i)).alias(c) for c, i in num.items()],
        dash_num(F.when(F.size("f") > 36, _at(36)).otherwise(_at(6))).alias("volume"),
        F.when(hk & (F.size("f") > 75), _at(75)).otherwise(_at(35)).alias("currency"),
        _at(30).alias("quote_time"),
        F.lit(snapshot_at).alias("snapshot_at"),
        F.lit(source_url).alias("source_url"),
    )


_RECENT = "struct<filings:struct<recent:struct<form:array<string>,filingDate:array<string>,accessionNumber:array<string>,primaryDocument:array<string>,primaryDocDescription:array<string>>>>"


def filings(payload: DataFrame, column: str, cik: str) -> DataFrame:
    """Filing rows of submissions JSON: parallel arrays zipped by place, blanks where an array is short."""
    recent = F.from_json(F.col(column), _RECENT)["filings"]["recent"]
    rows = payload.select(F.col(cik).alias("cik"), recent.alias("r")).select("cik", "r", F.posexplode(F.col("r.form")).alias("i", "form"))
    get = lambda f: F.coalesce(F.get(F.col(f"r.{f}"), F.col("i")), F.lit(""))
    acc, doc = get("accessionNumber"), get("primaryDocument")
    url = F.concat(F.lit(ARCHIVE_URL), F.col("cik").try_cast("bigint").cast("string"), F.lit("/"), F.replace(acc, F.lit("-"), F.lit("")), F.lit("/"), doc)
    return rows.select(
        "cik", "form", get("filingDate").alias("filing_date"), acc.alias("accession_number"), doc.alias("primary_document"), get("primaryDocDescription").alias("description"), F.when((acc != "") & (doc != ""), url).otherwise("").alias("source_url")
    )


_FACT = "struct<start:string,end:string,fy:string,fp:string,form:string,filed:string,accn:string,frame:string,val:double>"
_FACTS = f"struct<entityName:string,facts:map<string,map<string,struct<label:string,description:string,units:map<string,array<{_FACT}>>>>>>"


def company_facts(payload: DataFrame, column: str, cik: str) -> DataFrame:
    """Fact rows of taxonomy -> concept -> unit -> facts JSON."""
    j = payload.select(F.col(cik).alias("cik"), F.from_json(F.col(column), _FACTS).alias("j"))
    t = j.select("cik", F.col("j.entityName").alias("entity"), F.explode("j.facts").alias("taxonomy", "concepts"))
    c = t.select("cik", "entity", "taxonomy", F.explode("concepts").alias("concept", "c"))
    u = c.select("cik", "entity", "taxonomy", "concept", F.col("c.label").alias("label"), F.col("c.description").alias("description"), F.explode("c.units").alias("unit", "facts"))
    f = u.select("cik", "entity", "taxonomy", "concept", "label", "description", "unit", F.explode("facts").alias("f"))
    s = lambda x, name: F.coalesce(F.col(x), F.lit("")).alias(name)
    return f.select(
        "cik", s("entity", "entity_name"), "taxonomy", "concept", s("label", "label"), s("description", "description"), "unit", s("f.start", "start_date"), s("f.end", "end_date"), s("f.fy", "fiscal_year"), s("f.fp", "fiscal_period"),
        s("f.form", "form"), s("f.filed", "filed_date"), s("f.accn", "accession_number"), s("f.frame", "frame"), F.col("f.val").alias("value"), F.concat(F.lit(FACTS_URL), F.col("cik"), F.lit(".json")).alias("source_url"),
    )


def ticker_map(payload: DataFrame, column: str) -> DataFrame:
    """cik, ticker, title rows of a ticker JSON (map or list of items); incomplete items are left out."""
    item = "struct<cik_str:string,ticker:string,title:string>"
    listed = F.ltrim(F.col(column)).startswith("[")
    items = F.when(listed, F.from_json(F.col(column), f"array<{item}>")).otherwise(F.map_values(F.from_json(F.col(column), f"map<string,{item}>")))
    rows = payload.select(F.explode(items).alias("i")).select(pad_cik(F.col("i.cik_str")).alias("cik"), F.upper(F.coalesce("i.ticker", F.lit(""))).alias("ticker"), F.coalesce("i.title", F.lit("")).alias("title"))
    return rows.where((F.col("cik") != "") & (F.col("ticker") != "") & (F.col("title") != "")).withColumn("source_url", F.concat(F.lit(BROWSE_URL), "cik"))


def first_seen(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows without later repeats of a key; the first by ``order`` stands. Null keys all stand for one."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min(F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("_r"))).alias("_w"))
    return best.select(*[F.col(c) if c == key else F.col(f"_w._r.{c}").alias(c) for c in rows.columns])


def select_records(payload: DataFrame, column: str, path: str, fields: dict[str, str]) -> DataFrame:
    """Rows of JSON documents: the objects at ``path`` (``$`` is the root; one object counts as a list of one), ``fields`` name -> path.

    Values are text as JSON writes them; what isn't there is null. A record that is no object counts as an object of one field, ``value``.
    """
    root = "$" + path.removeprefix("$") if path.startswith("$") else f"$.{path}"
    at = F.get_json_object(F.col(column), root)
    docs = F.when(at.startswith("["), F.from_json(at, "array<string>")).when(at.isNotNull(), F.array(at))
    rows = payload.select(F.explode(docs).alias("doc"))
    rows = rows.select(F.when(F.ltrim("doc").startswith("{"), F.col("doc")).otherwise(F.to_json(F.struct(F.col("doc").alias("value")))).alias("doc"))
    return rows.select(*[F.get_json_object("doc", p if p.startswith("$") else f"$.{p}").alias(n) for n, p in fields.items()])


# Addresses that recorded payloads leave out.
REPORT_FILE_URL = "https://pdf.dfcfw.com/pdf/H3_{}_1.pdf"
REPORT_LIST_URL = "https://data.eastmoney.com/report/"
DISCLOSURE_FILE_URL = "https://static.cninfo.com.cn/"


def industry_reports(payload: DataFrame, column: str) -> DataFrame:
    """report_id, title, published_at, source_name, industry_name, source_url of report list pages; pages without a list and unreadable ones have none."""
    item = "struct<infoCode:string,title:string,publishDate:string,orgSName:string,industryName:string>"
    pages = payload.select(F.explode(F.from_json(F.get_json_object(column, "$.data"), f"array<{item}>")).alias("r"))
    code = text(F.col("r.infoCode"))
    plain = lambda c: F.coalesce(F.col(f"r.{c}"), F.lit(""))
    url = F.when(code != "", F.concat(F.lit(REPORT_FILE_URL.split("{}")[0]), code, F.lit(REPORT_FILE_URL.split("{}")[1]))).otherwise(REPORT_LIST_URL)
    return pages.select(code.alias("report_id"), plain("title").alias("title"), plain("publishDate").alias("published_at"), plain("orgSName").alias("source_name"), plain("industryName").alias("industry_name"), url.alias("source_url"))


def listed_quotes(payload: DataFrame, column: str, *, snapshot_at: str) -> DataFrame:
    """security_id, name, price, pct_chg, volume, amount, snapshot_at, quote_source of quote lists, whose items come as a list or by number; ``-`` and unreadable numbers are null."""
    item = "struct<f12:string,f14:string,f2:string,f3:string,f5:string,f6:string>"
    diff = F.get_json_object(column, "$.data.diff")
    items = F.when(diff.startswith("["), F.from_json(diff, f"array<{item}>")).otherwise(F.map_values(F.from_json(diff, f"map<string,{item}>")))
    rows = payload.select(F.explode(items).alias("q"))
    return rows.select(
        exchange_suffix(F.col("q.f12"), wide=True).alias("security_id"), text(F.col("q.f14")).alias("name"), *[dash_num(F.col(f"q.{f}")).alias(n) for f, n in (("f2", "price"), ("f3", "pct_chg"), ("f5", "volume"), ("f6", "amount"))],
        F.lit(snapshot_at).alias("snapshot_at"), F.lit("eastmoney_intraday").alias("quote_source"),
    )


def announcement_pages(payload: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Announcements of index pages, in the dataset's columns, each announcement_id once: the first by ``order`` (columns of ``payload``) and place on the page.

    Items whose code belongs to no exchange are left out; items without an id all stay. Times count milliseconds.
    """
    fields = ("secCode", "secName", "tileSecName", "orgId", "announcementId", "announcementTitle", "shortTitle", "announcementType", "announcementTypeName", "announcementTime", "columnId", "pageColumn", "adjunctUrl", "adjunctType", "adjunctSize")
    item = "struct<" + ",".join(f"{f}:string" for f in fields) + ">"
    rows = payload.select(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.posexplode(F.from_json(F.get_json_object(column, "$.announcements"), f"array<{item}>")).alias("_at", "a"))
    get = lambda c: text(F.col(f"a.{c}"))
    security = exchange_suffix(get("secCode"))
    at = F.col("a.announcementTime").try_cast("bigint")
    time = F.coalesce(milliseconds_iso(at), F.lit(""))
    url = get("adjunctUrl")
    out = rows.where(security.contains(".")).select(
        *[f"_o{i}" for i in range(len(order))], "_at",
        compact_date(F.substring(time, 1, 10)).alias("publish_date"), time.alias("publish_time"), get("announcementId").alias("announcement_id"), get("secCode").alias("security_code"), security.alias("security_id"),
        F.when(get("secName") != "", get("secName")).otherwise(get("tileSecName")).alias("security_name"), get("orgId").alias("org_id"), get("announcementTitle").alias("title"), get("shortTitle").alias("short_title"),
        get("announcementType").alias("announcement_type"), get("announcementTypeName").alias("announcement_type_name"), get("columnId").alias("column_id"), get("pageColumn").alias("page_column"), url.alias("adjunct_url"),
        F.when(url != "", F.concat(F.lit(DISCLOSURE_FILE_URL), url)).otherwise("").alias("source_url"), get("adjunctType").alias("adjunct_type"), F.col("a.adjunctSize").try_cast("bigint").alias("adjunct_size"),
    )
    places = [*[f"_o{i}" for i in range(len(order))], "_at"]
    named = first_seen(out.where("announcement_id != ''"), "announcement_id", places)
    return named.unionByName(out.where("announcement_id = ''")).drop(*places)
