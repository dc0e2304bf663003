"""What the stores hold: entries, summary and recovery plan over partition metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import DATE_KEYS
from tidemark.functions.exprs import due_period

# What a recovery plan takes up unless told otherwise.
RECOVERY_STATUSES = ("missing", "degraded")
RECOVERY_COVERAGES = ("none", "partial")


def requested(contracts: DataFrame, as_of: str | None) -> DataFrame:
    """``contracts`` with request_key and request_value: the partition key a day asks by, and what it asks for.

    Filings go by period, for which the day's last due period is asked; others by the first of their keys that is a date; the rest,
    and all without a day, ask for nothing.
    """
    filing = (F.col("temporal_mode") == "filing") & F.array_contains("partition_keys", "period")
    dates = F.filter("partition_keys", lambda k: k.isin(*DATE_KEYS))
    key = F.when(filing, "period").otherwise(F.get(dates, F.lit(0)))
    value = F.when(filing, due_period(F.lit(as_of))).otherwise(F.lit(as_of))
    asks = F.lit(as_of is not None) & key.isNotNull()
    return contracts.withColumns({"request_key": F.when(asks, key), "request_value": F.when(asks, value)})


def inventory_entries(partitions: DataFrame, contracts: DataFrame, recipes: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per contract: its partitions, the one in force at ``as_of``, its status and how far it covers what is asked.

    ``partitions``: dataset_id, partition (map), rows, status (of quality), published_at, one row each; ``contracts`` as
    ``Registry.frame`` gives them; ``recipes`` as ``RecipeBook.frame`` does.

    * Partitions are ordered by their values in the order of the contract's keys, as text.
    * In force is the greatest partition that matches what is asked; where none matches, the greatest before it, if
      the contract falls back to latest_before and has no other key; without a request the greatest of all.
    * Status: ready if its quality is ok, degraded if it is anything else, missing without one. A partition without a quality counts as ready if nothing was asked for, else as missing.
    * Coverage: full or partial (some keys left open) for a match, latest_before, latest (nothing asked), or none.

    Partitions of unknown datasets are left out. One aggregation by dataset, combined map-side.
    """
    asked = requested(contracts, as_of)
    keyed = partitions.join(F.broadcast(asked.select("dataset_id", "partition_keys", "as_of_policy", "request_key", "request_value")), "dataset_id")
    order = F.transform("partition_keys", lambda k: F.coalesce(F.try_element_at("partition", k), F.lit("")))
    held = F.coalesce(F.try_element_at("partition", F.col("request_key")), F.lit(""))
    matches = held == F.col("request_value")
    before = (F.col("as_of_policy") == "latest_before") & (F.size("partition_keys") == 1) & (held <= F.col("request_value"))
    row = F.struct(order.alias("o"), F.map_entries("partition").alias("p"), "rows", "status", "published_at")
    per = keyed.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("rows").alias("rows_total"),
        F.count_if(matches).alias("matched"),
        F.max(row).alias("last"),
        F.max(F.when(matches, row)).alias("match"),
        F.max(F.when(before, row)).alias("before"),
    )
    ways = recipes.groupBy("dataset_id").agg(F.array_sort(F.collect_set("recipe_id")).alias("recipes"), F.array_sort(F.collect_set("source_id")).alias("source_ids"))
    out = asked.join(per, "dataset_id", "left").join(ways, "dataset_id", "left")
    active = F.when(F.col("request_key").isNull(), F.col("last")).otherwise(F.coalesce("match", "before"))
    out = out.withColumn("active", active)
    quality = F.coalesce(F.col("active.status"), F.lit(""))
    status = F.when(F.col("active").isNull(), "missing").when(quality == "ok", "ready").when(quality != "", "degraded").when(F.col("request_key").isNull(), "ready").otherwise("missing")
    open_keys = F.array_except("partition_keys", F.array("request_key"))
    hit = F.coalesce("matched", F.lit(0)) > 0
    coverage = (
        F.when(F.col("request_key").isNull(), F.when(F.col("active").isNotNull(), "latest").otherwise("none"))
        .when(hit & (F.size(open_keys) > 0), "partial")
        .when(hit, "full")
        .when(F.col("active").isNotNull(), "latest_before")
        .otherwise("none")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    none = F.array().cast("array<string>")
    return out.select(
        "dataset_id", "domain", "role", status.alias("status"), coverage.alias("coverage"), "request_key", "request_value", zero("matched").alias("matched"), zero("partitions").alias("partitions"), zero("rows_total").alias("rows_total"),
        _named(F.col("active")).alias("active_partition"), zero("active.rows").alias("active_rows"), quality.alias("active_quality"), _named(F.col("last")).alias("latest_partition"), zero("last.rows").alias("latest_rows"),
        F.coalesce(F.col("last.status"), F.lit("")).alias("latest_quality"), F.coalesce("recipes", none).alias("recipes"), F.coalesce("source_ids", none).alias("source_ids"),
    )


def _named(row: Column) -> Column:
    """A partition as text: k=v, keys in order of name."""
    return F.concat_ws(",", F.transform(F.array_sort(row["p"]), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))))


def inventory_summary(entries: DataFrame) -> DataFrame:
    """kind (status or coverage), value, datasets, partitions and rows: how many entries there are of each."""
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("status", "coverage")])).alias("k")
    per = entries.select(both, "partitions", "rows_total").groupBy("k.kind", "k.value")
    return per.agg(F.count(F.lit(1)).alias("datasets"), F.sum("partitions").alias("partitions"), F.sum("rows_total").alias("rows_total"))


def feature_entries(metas: DataFrame, inputs: DataFrame, as_of: str | None = None) -> DataFrame:
    """feature_id, partitions, latest_as_of, latest_window, status of every feature in ``inputs``.

    ``metas``: feature_id, as_of, window, status; ``inputs``: feature_id, dataset_id, input_status (of its entry). A feature
    is missing without a partition, ready if the latest one's quality and all its inputs are, else degraded.
    """
    rows = metas if as_of is None else metas.where(F.col("as_of") == as_of)
    last = rows.groupBy("feature_id").agg(F.count(F.lit(1)).alias("partitions"), F.max(F.struct("as_of", "window", "status")).alias("last"))
    needs = inputs.groupBy("feature_id").agg(F.count_if(F.col("input_status") != "ready").alias("lacking"))
    out = needs.join(last, "feature_id", "left")
    status = F.when(F.col("last").isNull(), "missing").when((F.col("last.status") == "ok") & (F.col("lacking") == 0), "ready").otherwise("degraded")
    return out.select("feature_id", F.coalesce("partitions", F.lit(0)).alias("partitions"), F.col("last.as_of").alias("latest_as_of"), F.col("last.window").alias("latest_window"), status.alias("status"))


def recovery_plan(
    entries: DataFrame, contracts: DataFrame, recipes: DataFrame, steps: DataFrame, *, statuses: Sequence[str] = RECOVERY_STATUSES, coverages: Sequence[str] = RECOVERY_COVERAGES, limit: int = 0
) -> DataFrame:
    """What to run to fill the gaps: dataset_id, status, coverage, priority, action, recipe_id, pipeline_id, partition; most urgent first.

    An entry is taken up if its status or its coverage is among those given; with neither given all are. ``steps`` are
    pipeline steps: the action is the pipeline that has the dataset's preferred recipe as a step, else the recipe by itself,
    else manual. Priority: core facts 10, data that proves company exposure 20, evidence seeds 30, degraded 40, others 50. ``partition`` is what was asked for.
    """
    taken = F.col("status").isin(*statuses) | F.col("coverage").isin(*coverages) if statuses or coverages else F.lit(True)
    best = recipes.groupBy("dataset_id").agg(F.min(F.struct("priority", "recipe_id", "schedule")).alias("r")).select("dataset_id", F.col("r.recipe_id").alias("recipe_id"), F.col("r.schedule").alias("schedule"))
    of_step = steps.groupBy("recipe_id").agg(F.min("pipeline_id").alias("pipeline_id"))
    uses = contracts.select("dataset_id", (F.array_contains("allowed", "company_business_exposure") & ~F.array_contains("forbidden", "company_business_exposure")).alias("exposes"))
    rows = entries.where(taken).join(uses, "dataset_id").join(best, "dataset_id", "left").join(of_step, "recipe_id", "left")
    core = F.col("role") == "core_fact"
    priority = F.when(core, 10).when(F.col("exposes"), 20).when(F.col("role") == "evidence_seed", 30).when(F.col("status") == "degraded", 40).otherwise(50)
    action = F.when(F.col("pipeline_id").isNotNull(), "pipeline").when(F.col("recipe_id").isNotNull(), "recipe").otherwise("manual")
    asked = F.when(F.col("request_key").isNotNull(), F.concat_ws("=", "request_key", "request_value")).otherwise("")
    out = rows.select("dataset_id", "status", "coverage", priority.alias("priority"), action.alias("action"), "recipe_id", "pipeline_id", asked.alias("partition"))
    return out.orderBy("priority", "dataset_id").limit(limit) if limit > 0 else out


def source_map(sources: DataFrame, recipes: DataFrame, entries: DataFrame, steps: DataFrame) -> DataFrame:
    """Per source: its role, recipes, datasets, pipelines, and how many of the datasets are ready; sources without a recipe count 0."""
    state = entries.select("dataset_id", (F.col("status") == "ready").alias("ready"))
    used = recipes.join(state, "dataset_id", "left").join(steps.select("recipe_id", "pipeline_id"), "recipe_id", "left")
    per = used.groupBy("source_id").agg(
        F.countDistinct("recipe_id").alias("recipes"), F.countDistinct("dataset_id").alias("datasets"), F.countDistinct("pipeline_id").alias("pipelines"), F.countDistinct(F.when(F.col("ready"), F.col("dataset_id"))).alias("ready_datasets")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return sources.join(per, "source_id", "left").select("source_id", "source_role", "tier", "transport", *[zero(c) for c in ("recipes", "datasets", "pipelines", "ready_datasets")])
