"""Quality of table and feature partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import DatasetContract

BLOCKING = ("partition_mismatch", "schema_mismatch", "primary_key_violation", "empty")


def duplicate_key_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows stand in groups of equal keys (null equals null)."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_q_n"))
    return counts.agg(F.coalesce(F.sum(F.when(F.col("_q_n") > 1, F.col("_q_n"))), F.lit(0)).alias("duplicate_rows"))


def non_null_ratios(rows: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, non_null, rows, ratio for each column, in one pass; null for a ratio of no rows."""
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("non_null")) for i, c in enumerate(columns)])
    return counts.select("rows", F.explode(pairs).alias("p")).select("p.column_name", "p.non_null", "rows", F.try_divide(F.col("p.non_null").cast("double"), F.col("rows").cast("double")).alias("ratio"))


def mismatch_counts(rows: DataFrame, partition: dict[str, str]) -> DataFrame:
    """key and number of rows whose value differs from the partition's (null counts as the empty string)."""
    keys = [k for k in partition if k in rows.columns]
    if not keys:
        return rows.sparkSession.createDataFrame([], "key string, mismatches bigint")
    counts = rows.agg(*[F.count_if(F.coalesce(F.col(k).cast("string"), F.lit("")) != partition[k]).alias(f"m{i}") for i, k in enumerate(keys)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"m{i}").alias("mismatches")) for i, k in enumerate(keys)])).alias("m")).select("m.*").where(F.col("mismatches") > 0)


def table_quality(rows: DataFrame, contract: DatasetContract, partition: dict[str, str]) -> DataFrame:
    """One row: status, reason, rows, duplicate_rows, mismatched_rows of a partition about to be published.

    The first that applies: partition keys missing, values differing from the partition, required
    columns missing, duplicate keys, empty though forbidden, analysis columns missing (degraded), ok.
    Two aggregations, whatever the columns.
    """
    lacking_keys = [k for k in contract.partition_keys if k not in partition]
    lacking = [c for c in contract.required_columns if c not in rows.columns]
    analysis = [c for c in contract.analysis_columns if c not in rows.columns]
    here = [k for k in partition if k in rows.columns]
    differs = F.lit(False)
    for k in here:
        differs = differs | (F.coalesce(F.col(k).cast("string"), F.lit("")) != partition[k])
    marked = rows.withColumn("_differs", differs.cast("int"))
    keys = list(contract.primary_key) if all(k in rows.columns for k in contract.primary_key) else []
    per = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_q_n"), F.sum("_differs").alias("_q_d"))
    duplicates = F.sum(F.when(F.col("_q_n") > 1, F.col("_q_n"))) if keys else F.lit(0)
    total = per.agg(F.coalesce(F.sum("_q_n"), F.lit(0)).alias("rows"), F.coalesce(duplicates, F.lit(0)).alias("duplicate_rows"), F.coalesce(F.sum("_q_d"), F.lit(0)).alias("mismatched_rows"))
    rules = [
        (F.lit(bool(lacking_keys)), "partition_mismatch", "missing partition keys"),
        (F.col("mismatched_rows") > 0, "partition_mismatch", "partition column values do not match partition"),
        (F.lit(bool(lacking)), "schema_mismatch", "missing required columns"),
        (F.col("duplicate_rows") > 0, "primary_key_violation", "duplicate primary key rows"),
        ((F.col("rows") == 0) & F.lit(contract.empty_policy == "forbid_empty"), "empty", "empty partition is forbidden"),
        ((F.col("rows") > 0) & F.lit(bool(analysis)), "degraded", "missing analysis columns"),
    ]
    status, reason = F.lit("ok"), F.lit("")
    for cond, s, r in reversed(rules):
        status, reason = F.when(cond, s).otherwise(status), F.when(cond, r).otherwise(reason)
    return total.select(status.alias("status"), reason.alias("reason"), "rows", "duplicate_rows", "mismatched_rows")


def feature_quality(frame: DataFrame, columns: list[str], inputs: dict[str, tuple[str, str]], least: float = 0.8) -> DataFrame:
    """One row: status, reason, rows and the lowest non-null ratio of a feature partition.

    ``inputs``: dataset -> (role, status). Empty frames, missing analysis columns, and ratios below
    ``least`` degrade; so do inputs that are required or degrade_if_missing and not ok, but never optional ones.
    """
    missing = [c for c in columns if c not in frame.columns]
    there = [c for c in columns if c in frame.columns]
    counts = frame.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(there)])
    ratios = [F.try_divide(F.col(f"c{i}").cast("double"), F.col("rows").cast("double")) for i in range(len(there))]
    low = F.least(*ratios, F.lit(1.0)) if ratios else F.lit(1.0)
    bad_required = any(role == "required" and status != "ok" for role, status in inputs.values())
    bad = bad_required or any(role == "degrade_if_missing" and status != "ok" for role, status in inputs.values())
    rules = [
        ((F.col("rows") == 0) & F.lit(bool(columns)), "empty feature partition"),
        (F.lit(bool(missing)), "missing analysis columns"),
        (F.col("low") < least, "analysis columns below non-null threshold"),
        (F.lit(bad_required), "required feature inputs are not usable"),
        (F.lit(bad), "degraded feature inputs"),
    ]
    reason = F.lit("")
    for cond, r in reversed(rules):
        reason = F.when(cond, r).otherwise(reason)
    out = counts.withColumn("low", low).withColumn("reason", reason)
    return out.select(F.when(F.col("reason") == "", "ok").otherwise("degraded").alias("status"), "reason", "rows", F.col("low").alias("lowest_ratio"))
