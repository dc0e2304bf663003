"""Versioned history of entity attributes from periodic snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import bounded_broadcast

OPEN_END = "99991231"


def clean_id(c: Column) -> Column:
    """Trimmed, lower-case id; blank is null."""
    t = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.when(t != "", t)


def _null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in cols:
        on = on & left[c].eqNullSafe(right[c])
    return on


def snapshot_diff(state: DataFrame, keys: Sequence[str], attributes: Sequence[str], seq: str) -> DataFrame:
    """Compare every snapshot with the one before it.

    ``state`` holds one row per (``keys``, ``seq``); ``seq`` numbers the snapshots without gaps.
    A null-safe full outer join of the state with itself shifted by one snapshot gives, per key
    and snapshot, ``change`` = inserted, changed, deleted or null (as before). Of a deleted key
    all columns but ``keys`` and ``seq`` are null. Null keys and attributes equal each other.
    """
    cur = state.withColumn("_here", F.lit(True))
    prev = state.select(*keys, (F.col(seq) + 1).alias(seq), *attributes, F.lit(True).alias("_before"))
    prev = prev.select(*[F.col(c).alias(f"_p_{c}") for c in prev.columns])
    on = cur[seq] == prev[f"_p_{seq}"]
    for k in keys:
        on = on & cur[k].eqNullSafe(prev[f"_p_{k}"])
    same = F.lit(True)
    for a in attributes:
        same = same & F.col(a).eqNullSafe(F.col(f"_p_{a}"))
    change = (
        F.when(F.col("_p__before").isNull(), "inserted").when(F.col("_here").isNull(), "deleted").when(~same, "changed")
    )
    here = F.col("_here").isNotNull()
    out = [F.when(here, F.col(k)).otherwise(F.col(f"_p_{k}")).alias(k) for k in keys]
    out.append(F.when(here, F.col(seq)).otherwise(F.col(f"_p_{seq}")).alias(seq))
    rest = [c for c in state.columns if c not in (*keys, seq)]
    return cur.join(prev, on, "full").select(*out, *rest, change.alias("change"))


def entity_history(
    rows: DataFrame,
    *,
    keys: Sequence[str],
    attributes: Sequence[str],
    snapshot: str,
    scope: str,
    received: str,
    stated_from: str,
    stated_to: str,
    max_calendar_rows: int = 100_000,
) -> DataFrame:
    """Every version of every entity with the period in which it was valid.

    Columns out: ``scope``, ``keys``, ``attributes``, ``version_no``, ``valid_from``, ``valid_to``.

    * Of several rows with one scope, key and snapshot the one received last counts; equal
      ``received`` values are settled by the attribute values, so reruns agree.
    * A version is a longest run of consecutive snapshots of the scope that keep the attributes.
      Null attributes are values like any other; null keys form an entity of their own.
    * Rows without a snapshot date are in no snapshot and give no version. An empty table gives an
      empty history. Other columns of ``rows`` are ignored, whatever their names.

    Plan: one map-side-combined aggregation collapses repeats (so a hot key shrinks before it is
    shuffled), the snapshot calendar is numbered (and broadcast only if proven small), the diff is
    one full outer join, and all later windows share one partitioning by entity, whose size is
    bounded by the number of snapshots.
    """
    blank = lambda c: F.when(F.trim(F.col(c)) != "", F.trim(F.col(c)))
    ent = [scope, *keys]
    latest = (
        rows.where(F.col(snapshot).isNotNull())
        .select(*ent, F.col(snapshot), F.struct(F.col(received).alias("r"), *[F.col(a) for a in attributes], blank(stated_from).alias("_sf"), blank(stated_to).alias("_st")).alias("_v"))
        .groupBy(*ent, snapshot)
        .agg(F.max("_v").alias("_v"))
    )
    dates = rows.where(F.col(snapshot).isNotNull()).select(scope, snapshot).distinct()
    by_scope = Window.partitionBy(scope).orderBy(snapshot)
    calendar = dates.select(scope, snapshot, F.row_number().over(by_scope).alias("_seq"), F.lead(snapshot).over(by_scope).alias("_next"))
    calendar = bounded_broadcast(calendar, max_calendar_rows)
    cal = calendar.select(F.col(scope).alias("_c_scope"), F.col(snapshot).alias("_c_snap"), "_seq", "_next")
    state = latest.join(cal, F.col(scope).eqNullSafe(F.col("_c_scope")) & (F.col(snapshot) == F.col("_c_snap"))).select(
        *ent, "_seq", F.col(snapshot).alias("_snap"), "_next", *[F.col(f"_v.{a}").alias(a) for a in attributes], F.col("_v._sf").alias("_sf"), F.col("_v._st").alias("_st")
    )
    diff = snapshot_diff(state, ent, attributes, "_seq")
    entity = Window.partitionBy(*ent).orderBy("_seq")
    runs = (
        diff.withColumn("version_no", F.count("change").over(entity.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*ent, "version_no")
        .agg(
            F.min(F.when(F.col("change").isNotNull(), F.struct("_seq", "change", "_snap", *attributes))).alias("e"),
            F.min("_sf").alias("_sf"),
            F.min("_st").alias("_st"),
            F.max(F.struct("_seq", "_next")).alias("_last"),
        )
        .select(
            *ent,
            "version_no",
            F.col("e.change").alias("_change"),
            *[F.col(f"e.{a}").alias(a) for a in attributes],
            F.coalesce("_sf", "e._snap").alias("valid_from"),
            "_st",
            F.col("_last._next").alias("_next"),
        )
    )
    following = Window.partitionBy(*ent).orderBy("version_no")
    end = F.coalesce(F.col("_st"), F.when(F.lead("_change").over(following) == "changed", F.lead("valid_from").over(following)), F.col("_next"), F.lit(OPEN_END))
    return (
        runs.withColumn("valid_to", end)
        .where(F.col("_change") != "deleted")
        .select(*ent, *attributes, "version_no", "valid_from", "valid_to")
    )
