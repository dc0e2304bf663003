"""Recorded responses: bytes to text, JSON records to evidence by a mapping, export."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.sources.parsers import select_records

_FIELD = re.compile(r"\{([A-Za-z0-9_]+)\}")


def _decoded(raw: pd.Series, declared: pd.Series) -> pd.Series:
    def one(b, name):
        if b is None:
            return None
        for charset in (name, "utf-8", "gb18030"):
            try:
                if charset:
                    return bytes(b).decode(charset)
            except (UnicodeDecodeError, LookupError):
                continue
        return bytes(b).decode("utf-8", "replace")

    return pd.Series([one(b, n) for b, n in zip(raw, declared, strict=True)])


def decode_text(raw: Column, declared: Column) -> Column:
    """Bytes as text: the declared charset, then UTF-8, then GB18030, each strictly; at last UTF-8 with marks for what can't be read."""
    return pandas_udf(_decoded, "string")(raw, declared.cast("string"))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """``{name}`` filled from columns; null and unknown names are empty. Nothing else is special."""
    parts, at = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > at:
            parts.append(F.lit(template[at : m.start()]))
        parts.append(F.coalesce(values[m.group(1)].cast("string"), F.lit("")) if m.group(1) in values else F.lit(""))
        at = m.end()
    if at < len(template):
        parts.append(F.lit(template[at:]))
    return F.concat(*parts) if parts else F.lit("")


def evidence_from_json(payload: DataFrame, column: str, *, path: str, fields: dict[str, str], claim: str, static: dict[str, str] | None = None) -> DataFrame:
    """Claims of JSON documents: records at ``path``, ``fields`` name -> path, ``claim`` a template over fields and ``static`` values.

    A mapped value comes before a static one of its name; records without either leave it empty. Fields come along as columns.
    """
    rows = select_records(payload, column, path, fields)
    extra = static or {}
    values = {n: F.coalesce(F.col(n), F.lit(extra[n])) if n in extra else F.col(n) for n in rows.columns} | {n: F.lit(v) for n, v in extra.items() if n not in rows.columns}
    return rows.select(fill_template(claim, values).alias("claim"), *[v.alias(n) for n, v in values.items()])


@dataclass(frozen=True)
class EvidenceSource:
    """A JSON source of claims: where its records lie, what their fields are, and how a claim reads."""

    source_id: str
    path: str
    fields: dict[str, str]
    claim: str
    static: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if not self.source_id.strip() or not self.path.strip() or not self.claim.strip():
            raise ValueError("a source needs an id, a path and a claim")


class EvidenceSources:
    """Registered sources, kept as one JSON line each in a folder all can read. Ids given twice and unknown ids raise."""

    SCHEMA = "source_id string, path string, fields map<string,string>, claim string, static map<string,string>"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def list(self) -> list[EvidenceSource]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return []
        rows = self.spark.read.schema(self.SCHEMA).json(self.path).orderBy("source_id").collect()  # one row per registered source
        return [EvidenceSource(r.source_id, r.path, dict(r.fields or {}), r.claim, dict(r.static or {})) for r in rows]

    def add(self, source: EvidenceSource) -> None:
        if any(s.source_id == source.source_id for s in self.list()):
            raise ValueError(f"source registered twice: {source.source_id}")
        row = (source.source_id, source.path, source.fields, source.claim, source.static)
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("append").json(self.path)

    def require(self, source_id: str) -> EvidenceSource:
        for s in self.list():
            if s.source_id == source_id:
                return s
        raise ValueError(f"unknown source {source_id!r}")

    def claims(self, source_id: str, payload: DataFrame, column: str, limit: int = 0) -> DataFrame:
        """Claims of a registered source's documents; some ``limit`` of them where positive. A record that is no object counts as its field ``value``."""
        s = self.require(source_id)
        out = evidence_from_json(payload, column, path=s.path, fields=s.fields, claim=s.claim, static=s.static)
        return out.limit(limit) if limit > 0 else out


def backfill(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` in this order; those that are not there come as null."""
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])


def export_lines(records: DataFrame, path: str) -> None:
    """Records as JSON lines, null fields kept."""
    records.select(F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("errorifexists").text(path)
