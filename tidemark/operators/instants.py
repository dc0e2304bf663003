"""Timestamps in mixed formats, precisions and zones to one instant in UTC."""

from __future__ import annotations

import zoneinfo
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Zone abbreviations and their offsets from UTC in minutes.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "BST": 60, "WEST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "HKT": 480, "SGT": 480, "JST": 540, "KST": 540, "AEST": 600, "AEDT": 660,
    "EST": -300, "EDT": -240, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
# English month names.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
# Full-width writing and its plain form.
WIDE = "０１２３４５６７８９：／－．，＋　−ＴＺ"
PLAIN = "0123456789:/-.,+ -TZ"

_ZONE = r"(?:\s*(Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?|[A-Z]+(?:/[A-Z0-9_+-]+)+|[A-Z]{3,4}))?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
_MON = r"(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)[A-Z]*\.?"


@dataclass(frozen=True)
class Pattern:
    """An anchored form. ``groups`` names the capture groups in order."""

    name: str
    regex: str
    groups: tuple[str, ...]


#: Tried in this order; the first that matches decides. Matching ignores letter case.
CASCADE = (
    Pattern("epoch", r"^(\d{10}|\d{13}|\d{16})$", ("epoch",)),
    Pattern("day_digits", r"^(\d{4})(\d{2})(\d{2})$", ("y", "mo", "d")),
    Pattern("clock_digits", r"^(\d{4})(\d{2})(\d{2})[T ]?(\d{2})(\d{2})(\d{2})(?:\.(\d+))?" + _ZONE + "$", ("y", "mo", "d", "h", "mi", "s", "f", "z")),
    Pattern("iso", r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?:[T ]\s*" + _CLOCK + r"(?:\s*(AM|PM)(?![A-Z]))?" + _ZONE + ")?$", ("y", "", "mo", "d", "h", "mi", "s", "f", "ap", "z")),
    Pattern("year_last", r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:,?\s+" + _CLOCK + r"(?:\s*(AM|PM)(?![A-Z]))?" + _ZONE + ")?$", ("n1", "n2", "y", "h", "mi", "s", "f", "ap", "z")),
    Pattern("mail", r"^(?:[A-Z]{3,9},?\s+)?(\d{1,2})[\s-]+" + _MON + r"[\s-]+(\d{4})(?:\s+" + _CLOCK + r"(?:\s*(AM|PM)(?![A-Z]))?" + _ZONE + ")?$", ("d", "mon", "y", "h", "mi", "s", "f", "ap", "z")),
    Pattern("month_first", "^" + _MON + r"\s+(\d{1,2}),?\s+(\d{4})(?:,?\s+" + _CLOCK + r"(?:\s*(AM|PM)(?![A-Z]))?" + _ZONE + ")?$", ("mon", "d", "y", "h", "mi", "s", "f", "ap", "z")),
    Pattern("chinese", r"^(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日?(?:\s*(上午|下午)?\s*(\d{1,2})[:时](\d{1,2})(?:[:分](\d{1,2})?秒?(?:\.(\d+))?)?" + _ZONE + ")?$", ("y", "mo", "d", "ap", "h", "mi", "s", "f", "z")),
)


def _days(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, in whole-number arithmetic."""
    yy = F.when(m <= 2, y - 1).otherwise(y)
    mm = F.when(m <= 2, m + 9).otherwise(m - 3)
    return 365 * yy + F.floor(yy / 4) - F.floor(yy / 100) + F.floor(yy / 400) + F.floor((153 * mm + 2) / 5) + d - 1 - 719468


def _month_length(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def with_instant(rows: DataFrame, value: str, default_zone: str, date_order: str, zone_names: str) -> DataFrame:
    """``rows`` with a column ``_ti`` = ``struct(utc_us, zone, pattern)``; all null if the value names no instant.

    The arguments name columns. ``default_zone`` is the zone of values without one, ``date_order`` mdy or dmy for dates with
    slashes whose year is last (in any other order such a value names no instant), ``zone_names`` a map from
    lower-case to proper zone names; zones not in it name no instant.

    Policy for local times: one that occurs twice is the first of them, one that is skipped moves
    forward by the length of the gap. Fractions beyond microseconds are cut off. Strict: months,
    days, hours, minutes and seconds out of range give null, never a rollover.

    The steps are projections of their own, so each pattern is matched once per value.
    """
    keep = rows.columns
    t = F.upper(F.regexp_replace(F.translate(F.col(value), WIDE, PLAIN), r"^[\s\u00a0\u3000\ufeff]+|[\s\u00a0\u3000\ufeff]+$", ""))
    rows = rows.withColumn("_ti_t", t)
    which = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(CASCADE))):
        which = F.when(F.col("_ti_t").rlike(p.regex), i).otherwise(which)
    rows = rows.withColumn("_ti_w", which)
    fields = ("epoch", "y", "mo", "d", "mon", "n1", "n2", "h", "mi", "s", "f", "ap", "z")

    def captured(p: Pattern) -> Column:
        got = [F.nullif(F.regexp_extract("_ti_t", p.regex, p.groups.index(f) + 1), F.lit("")) if f in p.groups else F.lit(None).cast("string") for f in fields]
        return F.struct(*[g.alias(f) for g, f in zip(got, fields, strict=True)])

    parts = None
    for i, p in enumerate(CASCADE):
        hit = F.col("_ti_w") == i
        parts = F.when(hit, captured(p)) if parts is None else parts.when(hit, captured(p))
    rows = rows.withColumn("_ti_p", parts)

    part = lambda f: F.col(f"_ti_p.{f}")
    num = lambda f: part(f).try_cast("int")
    order, h0, ap = F.col(date_order), num("h"), part("ap")
    named = F.array_position(F.array(*map(F.lit, MONTHS)), part("mon")).cast("int")
    rows = rows.withColumns(
        {
            "_ti_y": num("y"),
            "_ti_mo": F.coalesce(num("mo"), F.when(named > 0, named), F.when(order == "mdy", num("n1")).when(order == "dmy", num("n2"))),
            "_ti_d": F.coalesce(num("d"), F.when(order == "mdy", num("n2")).when(order == "dmy", num("n1"))),
            "_ti_h": F.when(ap.isNull(), F.coalesce(h0, F.lit(0))).when(h0 > 12, None).when(ap.isin("AM", "上午"), h0 % 12).otherwise(h0 % 12 + 12),
            "_ti_mi": F.coalesce(num("mi"), F.lit(0)),
            "_ti_s": F.coalesce(num("s"), F.lit(0)),
            "_ti_f": F.coalesce(F.rpad(part("f"), 6, "0").try_cast("bigint"), F.lit(0)),
        }
    )
    y, mo, d, h, mi, s, f = (F.col(f"_ti_{x}") for x in ("y", "mo", "d", "h", "mi", "s", "f"))
    valid = y.between(1, 9999) & mo.between(1, 12) & (d >= 1) & (d <= _month_length(y, mo)) & h.between(0, 23) & (mi <= 59) & (s <= 59)
    local = F.when(valid, (_days(y, mo, d).cast("bigint") * 86400 + h * 3600 + mi * 60 + s) * 1_000_000 + f)
    shift = r"^([+-])(\d{2}):?(\d{2})?$"
    z = part("z")
    minutes = F.regexp_extract(z, shift, 2).try_cast("int") * 60 + F.coalesce(F.regexp_extract(z, shift, 3).try_cast("int"), F.lit(0))
    abbreviations = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    rows = rows.withColumns({"_ti_local": local, "_ti_off": F.coalesce(F.when(minutes <= 18 * 60, F.when(z.startswith("-"), -minutes).otherwise(minutes)), F.try_element_at(abbreviations, z))})
    off, local = F.col("_ti_off"), F.col("_ti_local")
    rows = rows.withColumn("_ti_region", F.when(z.isNull(), F.col(default_zone)).when(off.isNull(), F.try_element_at(F.col(zone_names), F.lower(z))))
    epoch = part("epoch")
    scale = F.when(F.length(epoch) == 10, 1_000_000).when(F.length(epoch) == 13, 1_000).otherwise(1)
    there = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), F.col("_ti_region")))
    rows = rows.withColumn("_ti_utc", F.coalesce(epoch.try_cast("bigint") * scale, local - off.cast("bigint") * 60_000_000, there))
    ok = F.col("_ti_utc").isNotNull()
    zone = F.when(epoch.isNotNull(), "UTC").otherwise(F.coalesce(z, F.col(default_zone)))
    name = F.element_at(F.array(*[F.lit(p.name) for p in CASCADE]), F.col("_ti_w") + 1)
    got = F.struct(F.col("_ti_utc").alias("utc_us"), F.when(ok, zone).alias("zone"), F.when(ok, name).alias("pattern"))
    # A generator of one row: filters on the result stay above it and don't repeat the matching.
    return rows.select(*keep, F.explode(F.array(got)).alias("_ti"))


def normalise_instants(values: DataFrame, clocks: DataFrame, *, value: str, source: str) -> DataFrame:
    """``values`` with ``utc_us``, ``zone`` and ``pattern`` added.

    ``clocks`` has source_name, zone_id and date_order. A value of an unknown or null source has no
    zone to fall back on: it gets an instant only if it states one itself (a zone, or an epoch
    count). Null, empty and blank values, and values that name no possible day or time, get null.
    Repeated rows stay as they are; other columns pass through, but for any of the three new names.
    """
    zones = sorted(zoneinfo.available_timezones() - {"Factory", "localtime"})
    zone_map = F.map_from_arrays(F.lit([n.lower() for n in zones]), F.lit(zones))  # a constant, folded once
    look = clocks.where(F.col("source_name").isNotNull()).groupBy(F.col("source_name").alias("_c_name")).agg(F.min("zone_id").alias("_c_zone"), F.lower(F.min("date_order")).alias("_c_order"))
    look = look.select("_c_name", "_c_order", F.when(F.lower("_c_zone").isin([n.lower() for n in zones]), F.col("_c_zone")).alias("_c_zone"))
    rows = values.select(F.struct(*values.columns).alias("_row"), F.col(value).alias("_c_value"), F.col(source).alias("_c_source"))
    joined = rows.join(look, F.col("_c_source") == F.col("_c_name"), "left").withColumn("_c_zones", zone_map)
    got = with_instant(joined, "_c_value", "_c_zone", "_c_order", "_c_zones")
    kept = [F.col(f"_row.`{c}`").alias(c) for c in values.columns if c not in ("utc_us", "zone", "pattern")]
    return got.select(*kept, F.col("_ti.utc_us").alias("utc_us"), F.col("_ti.zone").alias("zone"), F.col("_ti.pattern").alias("pattern"))
