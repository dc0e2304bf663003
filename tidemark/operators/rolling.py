"""Totals and averages over trailing calendar periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def standing_rows(rows: DataFrame, keys: Sequence[str], computed: str, values: Sequence[str]) -> DataFrame:
    """One row per key: the one computed last; ties are settled by the values, high first.

    The struct maximum combines map-side, so repeats of a hot key never reach the shuffle.
    """
    best = F.max(F.struct(F.col(computed), *[F.col(v) for v in values]))
    return rows.groupBy(*keys).agg(best.alias("_b")).select(*keys, *[F.col(f"_b.{v}").alias(v) for v in values])


def trailing_totals(daily: DataFrame, *, entity: str, day: str, value: str, periods: Sequence[int] = (7, 30)) -> DataFrame:
    """Per entity and calendar day: totals, fixed-denominator averages and active days.

    ``day`` is an integer day number, ``value`` a number. Columns out: ``entity``, ``day``,
    ``value`` (0 on a day without activity) and for each period n ``total_n``, ``avg_n`` (always
    divided by n) and ``active_days_n`` (days of the period that had a row with a value).

    * Several rows of one entity and day add up; null and NaN values count 0 and not as active.
    * Days run from the entity's first to its last row, inactive ones included; days before the
      first count 0. Rows without a day number can't be placed and are left out; a null entity is
      an entity of its own.

    Plan: daily sums combine map-side; the gap after each sparse day is filled from ``lead``, so
    the calendar needs no join; the range frames run on the same partitioning. A partition holds
    one entity's days, which the calendar bounds, however many rows the entity had.
    """
    v = F.when(F.isnan(F.col(value).cast("double")), None).otherwise(F.col(value))
    sparse = daily.where(F.col(day).isNotNull()).groupBy(entity, day).agg(F.coalesce(F.sum(v), F.lit(0.0)).alias("_v"), F.max(v.isNotNull().cast("int")).alias("_a"))
    by_entity = Window.partitionBy(entity).orderBy(day)
    filled = sparse.withColumn("_to", F.coalesce(F.lead(day).over(by_entity) - 1, F.col(day))).select(
        entity, F.col(day).alias("_from"), "_v", "_a", F.explode(F.sequence(F.col(day), F.col("_to"))).alias(day)
    )
    active = F.col(day) == F.col("_from")
    rows = filled.select(entity, day, F.when(active, F.col("_v")).otherwise(0.0).alias(value), F.when(active, F.col("_a")).otherwise(0).alias("_a"))
    out = []
    for n in periods:
        frame = by_entity.rangeBetween(1 - n, 0)
        total = F.sum(value).over(frame)
        out += [total.alias(f"total_{n}"), (total / n).alias(f"avg_{n}"), F.sum("_a").over(frame).alias(f"active_days_{n}")]
    return rows.select(entity, day, value, *out)
