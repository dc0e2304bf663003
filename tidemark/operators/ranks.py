"""Average percent ranks of a cross-section, in one window or over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import rank_pct


ONE_TASK_BYTES = 64_000_000


def with_ranks(frame: DataFrame, ranks: dict[str, str], by: Sequence[str], *, distributed: bool | None = None) -> DataFrame:
    """``frame`` with a column of average percent ranks (see :func:`rank_pct`) for each ``name -> value column``.

    A cross-section has one row per entity. One that surely fits a task (the optimizer's bound of its size, taken from the
    sizes of the files it comes from, is at most ONE_TASK_BYTES) is one window partition. Others, or all if ``distributed`` is set, go over many tasks:
    equal values are counted first, the counts are sorted by range, and a value's rank is what lies in the ranges
    before its own, what lies before it within, and half its ties. The results are the same.
    """
    if distributed is None:
        distributed = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > ONE_TASK_BYTES
    if not distributed:
        return frame.withColumns({name: rank_pct(value, by) for name, value in ranks.items()})
    keys = [f"_r_{i}" for i in range(len(by))]
    out = frame
    sizes = frame.groupBy(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)]).agg(F.count(F.lit(1)).alias("_r_rows"))
    for name, value in ranks.items():
        counts = frame.where(F.col(value).isNotNull()).groupBy(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(value).alias("_r_v")).agg(F.count(F.lit(1)).alias("_r_n"))
        spread = counts.repartitionByRange(*keys, "_r_v").withColumn("_r_part", F.spark_partition_id())
        spread = spread.withColumn("_r_in", F.sum("_r_n").over(Window.partitionBy("_r_part", *keys).orderBy("_r_v")))
        totals = spread.groupBy("_r_part", *keys).agg(F.sum("_r_n").alias("_r_sum"))  # one row per range and group
        order = Window.partitionBy(*keys).orderBy("_r_part")
        totals = totals.select(F.col("_r_part").alias("_t_part"), *[F.col(k).alias(f"_t{k}") for k in keys], (F.sum("_r_sum").over(order) - F.col("_r_sum")).alias("_t_before"), F.sum("_r_sum").over(Window.partitionBy(*keys)).alias("_t_all"))
        on = F.col("_r_part") == F.col("_t_part")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_t{k}"))
        placed = spread.join(totals, on).select(*keys, "_r_v", ((F.col("_t_before") + F.col("_r_in") - (F.col("_r_n") - 1) / 2.0) / F.col("_t_all")).alias("_r_rank"))
        same = out[value] == placed["_r_v"]
        for b, k in zip(by, keys, strict=True):
            same = same & out[b].eqNullSafe(placed[k])
        out = out.join(placed, same, "left").select(*out.columns, "_r_rank")
        alone = F.lit(True)
        for b, k in zip(by, keys, strict=True):
            alone = alone & out[b].eqNullSafe(sizes[k])
        rank = F.when(F.col("_r_rows") <= 1, F.lit(1.0)).otherwise(F.coalesce("_r_rank", F.lit(0.0)))
        out = out.join(sizes, alone, "left").withColumn(name, rank).drop("_r_rank", "_r_rows", *keys)
    return out
