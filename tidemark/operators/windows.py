"""Partition windows: the last N partitions, and strict windows over a trading calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import WINDOW_KEYS
from tidemark.functions.exprs import compact_date
from tidemark.session import bounded_broadcast


def open_days(calendar: DataFrame, as_of: str, window: int, exchange: str = "SSE") -> DataFrame:
    """The last ``window`` open days up to ``as_of``: one column trade_date. Repeated and closed days don't count."""
    days = calendar.where((F.col("exchange") == exchange) & (F.col("is_open").cast("string") == "1")).select(compact_date(F.col("cal_date")).alias("trade_date"))
    return days.where(F.col("trade_date") <= as_of).distinct().orderBy(F.desc("trade_date")).limit(window)


def strict_window(rows: DataFrame, calendar: DataFrame, as_of: str, window: int, key: str = "trade_date") -> DataFrame:
    """Rows of the last ``window`` open days; a day without rows is not made up for by an older one.

    The days are at most ``window``; their bounds go to the scan as a filter besides the join.
    """
    days = open_days(calendar, as_of, window)
    low = days.agg(F.min("trade_date").alias("lo")).first()["lo"]
    inside = rows.where((F.col(key) >= (low or as_of)) & (F.col(key) <= as_of))
    return inside.join(F.broadcast(days.withColumnRenamed("trade_date", "_day")), F.col(key) == F.col("_day"), "left_semi")


def last_partitions(rows: DataFrame, keys: Sequence[str], count: int, *, key: str | None = None, as_of: str | None = None) -> DataFrame:
    """Rows of the last ``count`` partitions, by ``key`` up to ``as_of`` where given; with several keys, partitions are counted.

    Only the distinct partition values are ranked; they are one row per partition.
    """
    first = key or keys[0]
    parts = rows.select(*keys).distinct()
    if as_of is not None:
        parts = parts.where(compact_date(F.col(first)) <= as_of)
    order = [F.desc(compact_date(F.col(first)))] + [F.desc(F.col(k)) for k in keys if k != first]
    kept = bounded_broadcast(parts.orderBy(*order).limit(count), max_rows=max(count, 1))
    on = [rows[k].eqNullSafe(kept[k]) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return rows.join(kept, cond, "left_semi")


def window_coverage(meta: DataFrame, calendar: DataFrame, as_of: str, window: int, *, strict: bool = True) -> DataFrame:
    """Per dataset how far its partitions cover a window.

    ``meta`` has dataset_id, partition_date and quality_status. Columns out: dataset_id, required_window,
    available, expected, missing (array), first_day, last_day, status: missing, partial_window, degraded_input or ok,
    the first that applies. Strict windows count open days of the calendar, others the last partitions there are.
    """
    parts = meta.select("dataset_id", compact_date(F.col("partition_date")).alias("day"), "quality_status").where(F.col("day") <= as_of)
    bad = F.coalesce((F.col("quality_status") != "") & (F.col("quality_status") != "ok"), F.lit(False))
    if strict:
        days = [r["trade_date"] for r in open_days(calendar, as_of, window).collect()]  # at most ``window`` rows
        each = F.explode_outer(F.array(*map(F.lit, days)).cast("array<string>")).alias("day")
        grid = meta.select("dataset_id").distinct().select("dataset_id", each)
        have = parts.groupBy("dataset_id", "day").agg(F.max(bad).alias("bad"))
        joined = grid.join(have, ["dataset_id", "day"], "left")
        agg = joined.groupBy("dataset_id").agg(
            F.count("bad").cast("int").alias("available"),
            F.count("day").cast("int").alias("expected"),
            F.sort_array(F.collect_list(F.when(F.col("bad").isNull(), F.col("day")))).alias("missing"),
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.coalesce(F.max("bad"), F.lit(False)).alias("bad"),
        )
    else:
        w = Window.partitionBy("dataset_id").orderBy(F.desc("day"))
        last = parts.groupBy("dataset_id", "day").agg(F.max(bad).alias("bad")).withColumn("n", F.row_number().over(w)).where(F.col("n") <= window)
        agg = last.groupBy("dataset_id").agg(F.count("day").cast("int").alias("available"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.max("bad").alias("bad"))
        agg = meta.select("dataset_id").distinct().join(agg, "dataset_id", "left").withColumns({"expected": F.lit(window), "missing": F.array().cast("array<string>"), "available": F.coalesce("available", F.lit(0)), "bad": F.coalesce("bad", F.lit(False))})
    short = (F.size("missing") > 0) | (F.col("expected") < window) | (F.lit(not strict) & (F.col("available") < window))
    status = F.when(F.col("available") == 0, "missing").when(short, "partial_window").when(F.col("bad"), "degraded_input").otherwise("ok")
    return agg.select("dataset_id", F.lit(window).alias("required_window"), "available", "expected", "missing", "first_day", "last_day", status.alias("status"))


def contract_coverage(contracts: DataFrame, partitions: DataFrame, calendar: DataFrame, as_of: str, window: int) -> DataFrame:
    """Per contract how its partitions cover a window: dataset_id, partition_key, calendar, required_window, available, missing, first_day, last_day, status, reason.

    The key is the first of WINDOW_KEYS the contract has, or its only one; a contract with neither can't be read by window and is missing.
    Windows of trade_date are strict, the others take the partitions there are. ``partitions``: dataset_id, partition (map), status (of quality;
    null, where a partition has no metadata, counts as good). Partitions of unknown datasets are left out; of a day with several partitions
    the worst counts.
    """
    own = F.get(F.filter(F.array(*map(F.lit, WINDOW_KEYS)), lambda k: F.array_contains("partition_keys", k)), F.lit(0))
    keyed = contracts.select("dataset_id", F.coalesce(own, F.when(F.size("partition_keys") == 1, F.get("partition_keys", F.lit(0)))).alias("partition_key"))
    meta = partitions.join(F.broadcast(keyed.where(F.col("partition_key").isNotNull())), "dataset_id")
    meta = meta.select("dataset_id", "partition_key", F.try_element_at("partition", F.col("partition_key")).alias("partition_date"), F.col("status").alias("quality_status")).where(F.col("partition_date").isNotNull())
    strict = F.col("partition_key") == "trade_date"
    cols = ["dataset_id", "available", "missing", "first_day", "last_day", "status"]
    parts = [window_coverage(meta.where(c).drop("partition_key"), calendar, as_of, window, strict=s).select(*cols) for c, s in ((strict, True), (~strict, False))]
    out = keyed.join(parts[0].unionByName(parts[1]), "dataset_id", "left")
    none = F.array().cast("array<string>")
    status = F.coalesce("status", F.lit("missing"))
    reason = F.when(F.col("partition_key").isNull(), "no key to read windows by").when(status == "missing", "no partition in the window").when(status == "partial_window", "partitions are missing in the window").when(status == "degraded_input", "a partition is degraded").otherwise("")
    return out.select("dataset_id", "partition_key", F.when(strict, "strict_trade_calendar").otherwise("not_applicable").alias("calendar"), F.lit(window).alias("required_window"), F.coalesce("available", F.lit(0)).alias("available"), F.coalesce("missing", none).alias("missing"), "first_day", "last_day", status.alias("status"), reason.alias("reason"))
