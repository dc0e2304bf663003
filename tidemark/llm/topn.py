"""The N highest-ranked rows of every group, whatever the groups' sizes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _row_hash(rows: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c, kind in rows.dtypes if "map<" not in kind and kind != "variant" and c != "_part"])


def _ranked(rows: DataFrame, groups: Sequence[str | Column], order: Sequence[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*groups).orderBy(*order, _row_hash(rows))
    return rows.withColumn("rank_in_group", F.row_number().over(w)).where(F.col("rank_in_group") <= n)


def top_n_per_group(
    rows: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    n: int,
    *,
    heavy_rows: int = 5_000,
    max_broadcast: int = 10_000,
    standing: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """The first ``n`` rows of each group under ``order``, with ``rank_in_group`` from 1.

    ``order`` should end in a unique column: then ties always fall the same way. Rows that agree in
    all of it are told apart by a hash of the whole row. ``standing`` is applied to either side
    before ranking (deduplication by keys that contain the groups, filters).

    Exact counts of all groups split them. Groups of at most ``heavy_rows`` rows go to an ordinary
    window. Those above are sorted by range over (group, order, salt), so that one group spans many
    tasks; each task keeps the first ``n`` it has of each group, and only those meet again. At most
    rows / ``heavy_rows`` groups are heavy; their list is broadcast if it has no more than
    ``max_broadcast`` rows, else joined by shuffle.

    Null group values form a group. Empty tables give empty results, groups of fewer than ``n``
    rows come whole. A column called rank_in_group is replaced.
    """
    spark = rows.sparkSession
    rows = rows.drop("rank_in_group")
    heavy = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_h_rows")).where(F.col("_h_rows") > heavy_rows).select(*[F.col(g).alias(f"_h_{g}") for g in groups])
    known = heavy.limit(max_broadcast + 1).collect()
    if not known:
        return _ranked(standing(rows), groups, order, n)
    if len(known) <= max_broadcast:
        heavy = F.broadcast(spark.createDataFrame(known, heavy.schema))
    on = F.lit(True)
    for g in groups:
        on = on & rows[g].eqNullSafe(heavy[f"_h_{g}"])
    light = _ranked(standing(rows.join(heavy, on, "left_anti")), groups, order, n)
    hot = standing(rows.join(heavy, on, "left_semi"))
    spread = hot.repartitionByRange(*[F.col(g) for g in groups], *order, _row_hash(hot)).withColumn("_part", F.spark_partition_id())
    local = _ranked(spread, ["_part", *groups], order, n).drop("_part", "rank_in_group")
    return light.unionByName(_ranked(local, groups, order, n))
