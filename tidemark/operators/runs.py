"""Runs: recorded with an id of their own, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, question string, as_of string, created_at string, mart_refs array<string>, feature_refs array<string>, evidence_ids array<string>, relation_ids array<string>, output string, notes string"


def run_id(question: Column, as_of: Column, created_at: Column) -> Column:
    """Day, the question's Latin letters and digits (32 characters at most, "run" without any), and eight digits of a hash of all three."""
    slug = F.substring(F.regexp_replace(F.regexp_replace(F.lower(question), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, 32)
    digest = F.substring(F.sha2(F.concat_ws("|", question, as_of, created_at), 256), 1, 8)
    return F.concat_ws("-", as_of, F.when(slug != "", slug).otherwise("run"), digest)


def record_runs(runs: DataFrame, path: str) -> DataFrame:
    """Append runs as JSON lines, with their ids where they have none; gives what was written. Null references are none."""
    own = F.col("run_id") if "run_id" in runs.columns else F.lit(None).cast("string")
    rows = runs.withColumn("run_id", F.coalesce(own, run_id(F.col("question"), F.col("as_of"), F.col("created_at"))))
    none = F.array().cast("array<string>")
    cols = [c.split(" ")[0] for c in RUN_SCHEMA.split(", ")]
    get = lambda c: F.col(c) if c in rows.columns else F.lit(None)
    rows = rows.select(*[(F.coalesce(get(c).cast("array<string>"), none) if c.endswith(("refs", "ids")) else get(c).cast("string")).alias(c) for c in cols])
    rows.write.mode("append").json(path, ignoreNullFields=False)
    return rows


def replay_runs(spark: SparkSession, path: str) -> DataFrame:
    """All recorded runs."""
    return spark.read.schema(RUN_SCHEMA).json(path)


def run_refs(runs: DataFrame) -> DataFrame:
    """run_id, kind, ref: every reference of the runs, one row each, as ``gates.resolve_refs`` takes them."""
    kinds = (("mart", "mart_refs"), ("feature", "feature_refs"), ("evidence", "evidence_ids"), ("relation", "relation_ids"))

    def tag(kind: str):
        return lambda r: F.struct(F.lit(kind).alias("kind"), r.alias("ref"))

    tagged = [F.transform(F.coalesce(c, F.array().cast("array<string>")), tag(kind)) for kind, c in kinds]
    return runs.select("run_id", F.explode(F.concat(*tagged)).alias("r")).select("run_id", "r.kind", "r.ref")
