"""Relations between entities: ids, validation, search, profile, neighbourhood and aliases.

A relation row has structs subject and object_ref (entity_type, entity_id, name, market_scope),
predicate, confidence, claim, valid_from, valid_to, source_ref and tags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import CONFIDENCES, ENTITY_TYPES, PREDICATES
from tidemark.functions.exprs import canonical_hash, matches, text

_ENTITY = ("entity_type", "entity_id", "name", "market_scope")


def relation_key() -> Column:
    """Content id: subject, predicate, object, source without raw_ref and query time, valid_from, claim."""
    parts = [F.col(f"{side}.{f}") for side in ("subject", "object_ref") for f in _ENTITY]
    src = [F.col(f"source_ref.{f}") for f in ("evidence_id", "source_name", "source_url", "published_at")]
    return canonical_hash(*parts, F.col("predicate"), *src, F.col("valid_from"), F.col("claim"))


def problems(records: DataFrame) -> DataFrame:
    """Records with ``problem``: the first rule a relation breaks, null if it is valid."""
    blank = lambda c: text(F.col(c)) == ""
    among = lambda c, values: F.coalesce(F.col(c).isin(*values), F.lit(False))
    stated = ~blank("source_ref.source_url")
    rules = [
        (~among("subject.entity_type", ENTITY_TYPES), "invalid subject entity_type"),
        (~among("object_ref.entity_type", ENTITY_TYPES), "invalid object entity_type"),
        (blank("subject.entity_id"), "subject.entity_id is required"),
        (blank("object_ref.entity_id"), "object.entity_id is required"),
        (blank("subject.name"), "subject.name is required"),
        (blank("object_ref.name"), "object.name is required"),
        (~among("predicate", PREDICATES), "invalid predicate"),
        (~among("confidence", CONFIDENCES), "invalid confidence"),
        (blank("source_ref.evidence_id") & blank("source_ref.raw_ref") & ~stated, "source requires evidence_id, raw_ref, or source_url"),
        (stated & (blank("source_ref.source_name") | blank("source_ref.published_at") | blank("source_ref.query_time")), "source_url requires source_name, published_at, and query_time"),
    ]
    out = F.lit(None).cast("string")
    for cond, message in reversed(rules):
        out = F.when(cond, message).otherwise(out)
    return records.withColumn("problem", out)


def _names(side: str, wanted: str | None) -> Column:
    return matches(F.col(f"{side}.entity_id"), wanted) | matches(F.col(f"{side}.name"), wanted)


def search(records: DataFrame, *, subject: str | None = None, predicate: str | None = None, object: str | None = None, evidence_id: str | None = None, tag: str | None = None, confidence: str | None = None, limit: int = 0) -> DataFrame:
    """Relations by substring of id or name, predicate, evidence, confidence, and whole tag; latest valid_from first."""
    out = records.where(_names("subject", subject) & matches(F.col("predicate"), predicate) & _names("object_ref", object) & matches(F.col("source_ref.evidence_id"), evidence_id) & matches(F.col("confidence"), confidence))
    if tag:
        out = out.where(F.coalesce(F.array_contains("tags", tag), F.lit(False)))
    out = out.orderBy(F.desc(F.coalesce("valid_from", F.lit(""))), F.desc(F.coalesce("relation_id", F.lit(""))))
    return out.limit(limit) if limit > 0 else out


def profile(records: DataFrame) -> DataFrame:
    """facet, key, records: counts by predicate, confidence, entity types, source reference and tag, in one aggregation."""
    ref = F.when(text(F.col("source_ref.evidence_id")) != "", "evidence_id").when(text(F.col("source_ref.raw_ref")) != "", "raw_ref").when(text(F.col("source_ref.source_url")) != "", "source_url").otherwise("unknown")
    facets = {"predicate": F.col("predicate"), "confidence": F.col("confidence"), "subject_type": F.col("subject.entity_type"), "object_type": F.col("object_ref.entity_type"), "source_ref": ref}
    fixed = F.array(*[F.struct(F.lit(k).alias("facet"), c.cast("string").alias("key")) for k, c in facets.items()])
    tags = F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda t: F.struct(F.lit("tag").alias("facet"), t.alias("key")))
    return records.select(F.explode(F.concat(fixed, tags)).alias("f")).select("f.facet", "f.key").where(F.col("key").isNotNull()).groupBy("facet", "key").agg(F.count(F.lit(1)).alias("records"))


def entities(records: DataFrame) -> DataFrame:
    """entity_type, entity_id, name, records: how often an entity is subject or object."""
    both = F.explode(F.array(*[F.struct(*[F.col(f"{s}.{f}").alias(f) for f in _ENTITY]) for s in ("subject", "object_ref")]))
    return records.select(both.alias("e")).groupBy("e.entity_type", "e.entity_id", "e.name").agg(F.count(F.lit(1)).alias("records"))


def top_entities(records: DataFrame, limit: int = 20) -> DataFrame:
    out = entities(records).orderBy(F.desc("records"), F.desc("entity_id"), F.desc("entity_type"), F.desc("name"))
    return out.limit(limit) if limit > 0 else out


def neighbourhood(records: DataFrame, entity: str) -> DataFrame:
    """Relations that touch an entity (substring of id or name), with ``direction`` outgoing, incoming or both."""
    out, inc = _names("subject", entity), _names("object_ref", entity)
    return records.where(out | inc).withColumn("direction", F.when(out & inc, "both").when(out, "outgoing").otherwise("incoming"))


def alias_terms(records: DataFrame) -> DataFrame:
    """term -> entity, each pair once: id, name and what follows the id's last colon, lower-case."""
    both = F.explode(F.array(*[F.struct(*[F.col(f"{s}.{f}").alias(f) for f in _ENTITY]) for s in ("subject", "object_ref")]))
    e = records.select(both.alias("e")).select("e.*").distinct()
    terms = F.array(F.col("entity_id"), F.col("name"), F.when(F.col("entity_id").contains(":"), F.substring_index("entity_id", ":", -1)))
    rows = e.select(F.explode(F.array_distinct(F.transform(terms, F.lower))).alias("term"), *_ENTITY)
    return rows.where(F.coalesce(F.col("term"), F.lit("")) != "").distinct()
