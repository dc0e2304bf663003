"""Checks of recorded runs against the data they refer to: one row per run and gate.

Only what can be told from the data is judged: that references resolve, are of the run's day and of good quality, and what gaps the
output itself declares. Rules about what an output may conclude belong to its users.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.catalog import parse_ref, roll_up

GATES = ("output_gate", "freshness_gate", "data_refs_gate", "source_refs_gate", "gap_gate")
DATA_KINDS = ("mart", "feature")


def resolve_refs(refs: DataFrame, datasets: DataFrame, partitions: DataFrame, evidence: DataFrame, relations: DataFrame) -> DataFrame:
    """``refs`` (run_id, kind, ref) with name, partition and status.

    kind is mart, feature (``id:k=v,k=v``), evidence or relation (an id). ``datasets``: name; ``partitions``: name,
    partition (map), status; ``evidence`` and ``relations``: id. A data reference is invalid without a partition, unregistered if
    its dataset is unknown, missing without such a partition, degraded if its quality isn't ok, else ok; an id is
    ok or missing. Repeated references stay.
    """
    name, parts = parse_ref(F.col("ref"))
    canon = lambda m: F.concat_ws(",", F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    data = refs.where(F.col("kind").isin(*DATA_KINDS)).withColumns({"name": name, "partition": parts})
    known = datasets.select(F.col("name").alias("_n")).distinct()
    held = partitions.select(F.col("name").alias("_pn"), canon(F.col("partition")).alias("_pp"), F.col("status").alias("_ps")).groupBy("_pn", "_pp").agg(F.max("_ps").alias("_ps"))
    data = data.withColumn("_p", canon(F.col("partition"))).join(known, F.col("name") == F.col("_n"), "left").join(held, (F.col("name") == F.col("_pn")) & (F.col("_p") == F.col("_pp")), "left")
    status = F.when(F.size("partition") == 0, "invalid").when(F.col("_n").isNull(), "unregistered").when(F.col("_pn").isNull(), "missing").when(F.coalesce("_ps", F.lit("")) != "ok", "degraded").otherwise("ok")
    out = [data.select("run_id", "kind", "ref", "name", "partition", status.alias("status"))]
    for kind, ids in (("evidence", evidence), ("relation", relations)):
        there = ids.where(F.col("id").isNotNull()).select(F.col("id").alias("_i")).distinct()
        mine = refs.where(F.col("kind") == kind).join(there, F.col("ref") == F.col("_i"), "left")
        out.append(mine.select("run_id", "kind", "ref", F.col("ref").alias("name"), F.lit(None).cast("map<string,string>").alias("partition"), F.when(F.col("_i").isNull(), "missing").otherwise("ok").alias("status")))
    return reduce(DataFrame.unionByName, out)


def run_gates(runs: DataFrame, resolved: DataFrame) -> DataFrame:
    """run_id, gate, status and items, five rows per run of ``runs`` (run_id, as_of, output as JSON or null).

    * output_gate: not_evaluated without an output; blocked if it states another day; passed.
    * freshness_gate: blocked by data references whose trade_date or as_of is another day.
    * data_refs_gate: blocked by references that can't be used; warning for degraded ones.
    * source_refs_gate: blocked by evidence or relations that are not in the stores.
    * gap_gate: blocked by declared gaps that block; warning without any data reference; degraded by gaps that degrade.

    ``items`` counts what a gate holds against the run. An output that is no JSON object counts as none. References are
    counted before they meet the runs, so a run with millions of them is one row by then.
    """
    data = F.col("kind").isin(*DATA_KINDS)
    day = F.coalesce(F.try_element_at("partition", F.lit("trade_date")), F.try_element_at("partition", F.lit("as_of")))
    dated = resolved.join(runs.select(F.col("run_id").alias("_r"), F.col("as_of").alias("_d")), F.col("run_id") == F.col("_r"))
    per = dated.groupBy("run_id").agg(
        F.count_if(data).alias("data"),
        F.count_if(data & (day != F.col("_d"))).alias("stale"),
        F.count_if(data & F.col("status").isin("missing", "invalid", "unregistered")).alias("unusable"),
        F.count_if(data & (F.col("status") == "degraded")).alias("degraded"),
        F.count_if(~data & (F.col("status") != "ok")).alias("unknown"),
    )
    gaps = F.from_json(F.get_json_object("output", "$.data_gaps"), "array<struct<impact:string>>")
    count = lambda impact: F.coalesce(F.size(F.filter(gaps, lambda g: g["impact"] == impact)), F.lit(0))
    given = F.coalesce(F.col("output").rlike(r"^\s*\{\s*\""), F.lit(False))
    stated = F.get_json_object("output", "$.as_of")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    blocks, degrades = F.greatest(count("block"), F.lit(0)), F.greatest(count("degrade"), F.lit(0))
    n = {"output_gate": F.when(given & stated.isNotNull() & (stated != F.col("as_of")), 1).otherwise(0), "freshness_gate": zero("stale"), "source_refs_gate": zero("unknown")}

    def gate(name: str, status: Column, items: Column) -> Column:
        return F.struct(F.lit(name).alias("gate"), status.alias("status"), items.cast("bigint").alias("items"))

    bad = lambda c: F.when(c > 0, "blocked").otherwise("passed")
    rows = [
        gate("output_gate", F.when(~given, "not_evaluated").otherwise(bad(n["output_gate"])), n["output_gate"]),
        gate("freshness_gate", bad(n["freshness_gate"]), n["freshness_gate"]),
        gate("data_refs_gate", F.when(zero("unusable") > 0, "blocked").when(zero("degraded") > 0, "warning").otherwise("passed"), F.when(zero("unusable") > 0, zero("unusable")).otherwise(zero("degraded"))),
        gate("source_refs_gate", bad(n["source_refs_gate"]), n["source_refs_gate"]),
        gate("gap_gate", F.when(blocks > 0, "blocked").when(zero("data") == 0, "warning").when(degrades > 0, "degraded").otherwise("passed"), F.when(blocks > 0, blocks).when(zero("data") == 0, 0).otherwise(degrades)),
    ]
    both = runs.join(per.withColumnRenamed("run_id", "_run"), F.col("run_id") == F.col("_run"), "left")
    return both.select("run_id", F.explode(F.array(*rows)).alias("g")).select("run_id", "g.gate", "g.status", "g.items")


def run_status(gates: DataFrame) -> DataFrame:
    """run_id, checks and status: blocked by any blocked gate, degraded by warnings, degraded and unevaluated ones, else ok."""
    return roll_up(gates, ["run_id"])
