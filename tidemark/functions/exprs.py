"""Column expressions the operators share. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def text(c: Column) -> Column:
    """Trimmed text; null is the empty string."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def safe_num(c: Column) -> Column:
    """Double, or null for what is no number (NaN included)."""
    d = c.try_cast("double")
    return F.when(~F.isnan(d), d)


def dash_num(c: Column) -> Column:
    """A quoted number; blank, ``-`` and unreadable values are null."""
    t = F.trim(c)
    return F.when((t != "") & (t != "-"), t.try_cast("double"))


def compact_date(c: Column) -> Column:
    """``YYYY-MM-DD`` or ``YYYYMMDD`` as ``YYYYMMDD``."""
    return F.replace(F.trim(c.cast("string")), F.lit("-"), F.lit(""))


def day_of(c: Column) -> Column:
    """A compact date string as a date; null if it is none."""
    return F.try_to_timestamp(compact_date(c), F.lit("yyyyMMdd")).cast("date")


def fetch_start(as_of: Column, trading_days: int) -> Column:
    """The first day of a calendar to fetch so that it surely holds so many trading days up to ``as_of``: three times as many days, or 30 more if that is more."""
    if trading_days <= 0:
        raise ValueError("trading days must be positive")
    return F.date_format(F.date_sub(day_of(as_of), max(3 * trading_days, trading_days + 30) - 1), "yyyyMMdd")


def natural_dates(first: Column, last: Column) -> Column:
    """All days from ``first`` to ``last``, compact, as an array; empty if they are the wrong way round."""
    a, b = day_of(first), day_of(last)
    return F.when(a <= b, F.transform(F.sequence(a, b), lambda d: F.date_format(d, "yyyyMMdd"))).otherwise(F.array().cast("array<string>"))


def rank_pct(value: str | Column, by: Sequence[str]) -> Column:
    """Average rank over the count of non-null values, ties alike; 1 for a single row, null values 0.

    A group is one cross-section (the entities of one feature partition).
    """
    v = F.col(value) if isinstance(value, str) else value
    part = Window.partitionBy(*by)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, v))
    low = F.rank().over(part.orderBy(v.asc_nulls_last()))
    rank = (low + (ties - 1) / 2.0) / F.count(v).over(part)
    return F.when(F.count(F.lit(1)).over(part) <= 1, F.lit(1.0)).when(v.isNull(), F.lit(0.0)).otherwise(rank)


def compound_return(pct: Column) -> Column:
    """Aggregate: compounded return in percent; null days count 0."""
    return (F.product(1 + F.coalesce(pct, F.lit(0.0)) / 100.0) - 1) * 100.0


def excess(latest: Column, average: Column) -> Column:
    """latest / average - 1, or 0 where there is no average."""
    return F.when(average != 0, latest / average - 1.0).otherwise(F.lit(0.0))


def contains_any(columns: Iterable[str], terms: Iterable[str]) -> Column:
    """Whether any column holds any term, letter case apart; terms are taken literally. True without terms."""
    wanted = [t.strip().lower() for t in terms if t.strip()]
    if not wanted:
        return F.lit(True)
    hit = F.lit(False)
    for c in columns:
        low = F.lower(F.coalesce(F.col(c).cast("string"), F.lit("")))
        for t in wanted:
            hit = hit | low.contains(t)
    return hit


def matches(actual: Column, expected: str | None) -> Column:
    """Substring test, letter case apart: no expectation is met by all, a null value meets none."""
    if not expected:
        return F.lit(True)
    return F.coalesce(F.lower(actual).contains(expected.lower()), F.lit(False))


def board_height(tag: Column) -> Column:
    """Consecutive limit boards named by a tag: first board 1, ``N天M板`` M, ``M板`` M, else 0."""
    t = text(tag)
    return (
        F.when(t.contains("首板"), 1)
        .when(t.rlike(r"\d+天\d+板"), F.regexp_extract(t, r"(\d+)天(\d+)板", 2).try_cast("int"))
        .when(t.rlike(r"\d+板"), F.regexp_extract(t, r"(\d+)板", 1).try_cast("int"))
        .otherwise(0)
    )


def due_period(as_of: Column) -> Column:
    """The last fiscal period whose report is due on a day (``YYYYMMDD``)."""
    y, md = F.substring(as_of, 1, 4), F.substring(as_of, 5, 4)
    before = F.date_format(F.add_months(F.try_to_timestamp(y, F.lit("yyyy")).cast("date"), -12), "yyyy")
    return F.when(md >= "1101", F.concat(y, F.lit("0930"))).when(md >= "0901", F.concat(y, F.lit("0630"))).when(md >= "0501", F.concat(y, F.lit("0331"))).otherwise(F.concat(before, F.lit("0930")))


def update_flag_rank(flag: Column) -> Column:
    """Rank of a revision flag: null -1, yes-words 1, no-words 0, numbers their whole part, else 0."""
    t = F.lower(F.trim(flag.cast("string")))
    return (
        F.when(flag.isNull(), -1)
        .when(t.isin("1", "y", "yes", "true", "updated", "revision", "revised"), 1)
        .when(t.isin("0", "n", "no", "false", ""), 0)
        .otherwise(F.coalesce(t.try_cast("double").try_cast("int"), F.lit(0)))
    )


def exchange_suffix(code: Column, wide: bool = False) -> Column:
    """Six-digit code with its exchange; ``wide`` takes the rule that also knows 5, 9 (SH) and 2 (SZ)."""
    sh, sz = ("[659]", "[023]") if wide else ("6", "[03]")
    c = F.trim(code)
    six = c.rlike(r"^\d{6}$")
    return F.when(six & c.rlike("^" + sh), F.concat(c, F.lit(".SH"))).when(six & c.rlike("^" + sz), F.concat(c, F.lit(".SZ"))).when(six & c.rlike("^[48]"), F.concat(c, F.lit(".BJ"))).otherwise(c)


def pad_cik(c: Column) -> Column:
    """Digits of a filer number, zero-padded to ten; empty without digits."""
    d = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\D", "")
    return F.when(d == "", "").otherwise(F.when(F.length(d) < 10, F.lpad(d, 10, "0")).otherwise(d))


def canonical_hash(*parts: Column) -> Column:
    """SHA-256 over parts, each with its length, null apart from empty: equal ids only for equal parts."""
    pieces = [F.when(p.isNull(), F.lit("~")).otherwise(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string"))) for p in parts]
    return F.sha2(F.concat_ws("|", *pieces), 256)


def milliseconds_iso(ms: Column, offset_hours: int = 8) -> Column:
    """Milliseconds since 1970 as an ISO time at a fixed offset."""
    second = F.floor(ms / 1000) + offset_hours * 3600
    day = F.date_format(F.date_from_unix_date(F.floor(second / 86400).cast("int")), "yyyy-MM-dd")
    rest = F.pmod(second, F.lit(86400))
    two = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    return F.concat(day, F.lit("T"), two(F.floor(rest / 3600)), F.lit(":"), two(F.floor(rest / 60) % 60), F.lit(":"), two(rest % 60), F.lit(f"+{offset_hours:02d}:00"))
