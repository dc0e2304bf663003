"""Queries of the problems whose operators live in this subpackage."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.dedupe import ChunkStore, ingest_all
from tidemark.llm.encode import encode_texts
from tidemark.llm.mix import mixture_of, mixture_shares
from tidemark.llm.scan import damage, repair_texts
from tidemark.llm.spans import shared_chars, shared_spans
from tidemark.llm.split import split_texts
from tidemark.llm.topn import top_n_per_group
from tidemark.llm.wording import Claim, Wording, agree, claim_of, learn_wording
from tidemark.operators.rolling import standing_rows
from tidemark.session import load, scratch_path, written


def p3_top(spark: SparkSession, root: str) -> DataFrame:
    """The five best securities of each as_of and window_days, with their rank."""
    m = load(spark, root, "daily_momentum").select("as_of", "window_days", "security_id", "computed_at", "momentum_score", "window_return_pct")
    num = lambda c: F.when(~F.isnan(c), F.col(c))

    def standing(rows: DataFrame) -> DataFrame:
        kept = standing_rows(rows, ["as_of", "window_days", "security_id"], "computed_at", ["momentum_score", "window_return_pct"])
        kept = kept.withColumns({c: num(c) for c in ("momentum_score", "window_return_pct")})
        return kept.where(F.col("momentum_score").isNotNull())

    order = [F.desc("momentum_score"), F.desc_nulls_last("window_return_pct"), F.asc_nulls_last("security_id")]
    return top_n_per_group(m, ["as_of", "window_days"], order, 5, standing=standing)


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return p3_top(spark, root).select("as_of", "window_days", "security_id")


P3_SQL = """
WITH k AS (
  SELECT as_of, window_days, security_id, momentum_score, CASE WHEN NOT isnan(window_return_pct) THEN window_return_pct END AS ret FROM daily_momentum
  QUALIFY row_number() OVER (PARTITION BY as_of, window_days, security_id ORDER BY computed_at DESC NULLS LAST, momentum_score DESC NULLS LAST, window_return_pct DESC NULLS LAST) = 1)
SELECT as_of, window_days, security_id FROM k WHERE momentum_score IS NOT NULL AND NOT isnan(momentum_score)
QUALIFY row_number() OVER (PARTITION BY as_of, window_days ORDER BY momentum_score DESC, ret DESC NULLS LAST, security_id ASC NULLS LAST) <= 5
"""


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    found = damage(load(spark, root, "announcement_text"), key="fetch_no", text="text", name="security_name")
    return found.select("fetch_no", "kind", "item").distinct()


def p4_repaired(spark: SparkSession, root: str) -> DataFrame:
    return repair_texts(load(spark, root, "announcement_text"), key="fetch_no", text="text", name="security_name")


def claims_of(records: DataFrame, wording: list[tuple]) -> DataFrame:
    """(record_no, batch_no, content, guard, about): what sets each claim apart, its numbers, and all that ``agree`` asks, as JSON.

    Claims that are null or blank equal no other.
    """
    sent = records.sparkSession.sparkContext.broadcast(wording)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Wording(sent.value)
        for pdf in batches:
            cols = [pdf[c] for c in ("claim", "company", "metric", "period", "value_json")]
            made = [claim_of(*(x if isinstance(x, str) else None for x in row), known) for row in zip(*cols, strict=True)]
            lone = [f"\x00{n}" for n in pdf["record_no"]]
            yield pd.DataFrame({"record_no": pdf["record_no"], "batch_no": pdf["batch_no"], "content": [c.content or x for c, x in zip(made, lone, strict=True)], "guard": [c.numbers for c in made], "about": [json.dumps(c, ensure_ascii=False) for c in made]})

    return records.select("record_no", "batch_no", "claim", "company", "metric", "period", "value_json").mapInPandas(run, "record_no bigint, batch_no int, content string, guard string, about string")


def agreeing(spark: SparkSession, wording: list[tuple]) -> Callable[[DataFrame], DataFrame]:
    """The exact check of pairs of claims, in Arrow batches."""

    sent = spark.sparkContext.broadcast(wording)

    def check(pairs: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = Wording(sent.value)
            for pdf in batches:
                yield pdf[[agree(Claim(*json.loads(a)), Claim(*json.loads(b)), known) for a, b in zip(pdf["about"], pdf["other_about"], strict=True)]]

        return pairs.mapInPandas(run, pairs.schema)

    return check


AT_ONCE = 1_000_000  # rows of consecutive batches that are ingested together, where batches at hand are smaller


def spans_of(sizes: list[tuple[int, int]], at_once: int) -> list[tuple[int, int]]:
    """Consecutive batches (number, rows) in spans (first, last) of at most ``at_once`` rows, or one batch; the first batch alone."""
    out: list[list[int]] = []
    for i, (n, rows) in enumerate(sizes):
        if i > 1 and out[-1][2] + rows <= at_once:
            out[-1] = [out[-1][0], n, out[-1][2] + rows]
        else:
            out.append([n, n, rows])
    return [(a, b) for a, b, _ in out]


def decisions(spark: SparkSession, root: str, at_once: int) -> DataFrame:
    """Every evidence record with the first record that states the same, null if it is accepted.

    The first batch is the history, from which the wording is learned. Later ones are ingested against the store that those before
    them left, as many together as have ``at_once`` rows; that changes no decision.
    """
    records = load(spark, root, "evidence_records").withColumn("batch_no", F.coalesce("batch_no", F.lit(0)))
    sizes = sorted((r.batch_no, r["count"]) for r in records.groupBy("batch_no").count().collect())
    if not sizes:
        return spark.createDataFrame([], "record_no bigint, repeats bigint")
    wording = [tuple(r) for r in learn_wording(records.where(F.col("batch_no") == sizes[0][0])).collect()]  # bounded, see there
    rows = written(claims_of(records, wording), "claims")
    store = ChunkStore(spark, scratch_path(spark, "chunk-store"))
    batches = [(f"batch-{a}-{b}", rows.where(F.col("batch_no").between(a, b))) for a, b in spans_of(sizes, at_once)]
    return ingest_all(store, batches, key="record_no", content="content", guard="guard", about="about", agrees=agreeing(spark, wording))


def p6_decisions(spark: SparkSession, root: str) -> DataFrame:
    """The decisions of all records, every batch ingested by itself."""
    return decisions(spark, root, 0)


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    d = decisions(spark, root, AT_ONCE).where(F.col("repeats").isNotNull())
    return d.select(F.col("repeats").alias("record_no_a"), F.col("record_no").alias("record_no_b"))


def p7_pieces(spark: SparkSession, root: str) -> DataFrame:
    return split_texts(load(spark, root, "announcement_text"), key="fetch_no", text="text", limit=2000, overlap=150)


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return p7_pieces(spark, root).where((F.col("piece_no") == 0) & (F.col("n_chars") > 2000)).select("fetch_no", "forced")


P7_SQL = r"""
SELECT fetch_no, CAST(coalesce(list_max(list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: length(x))), 0) > 2000 AS INTEGER) AS forced
FROM announcement_text WHERE length(text) > 2000
"""


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    return encode_texts(load(spark, root, "documents"), key="doc_id", text="text")


def p9_mixture(spark: SparkSession, root: str) -> DataFrame:
    return mixture_of(load(spark, root, "documents"), load(spark, root, "mix_targets"), key="doc_id", text="text", source="source")[0]


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    targets = load(spark, root, "mix_targets")
    mixture, sizes = mixture_of(load(spark, root, "documents"), targets, key="doc_id", text="text", source="source")
    return mixture_shares(mixture, targets, sizes, key="doc_id")


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return shared_chars(load(spark, root, "documents"), key="doc_id", text="text", least=200).select("doc_id", "shared_chars")


def p10_spans(spark: SparkSession, root: str) -> DataFrame:
    """The shared stretches of each document, whole copies among them; partners by class of exact copies, where the anchor isn't crowded."""
    return shared_spans(load(spark, root, "documents"), key="doc_id", text="text", least=200)


P10_SQL = """
WITH w AS (SELECT doc_id, text, unnest(range(length(text) - 199)) AS i FROM documents WHERE length(text) >= 200),
h AS (SELECT doc_id, i, hash(substr(text, i + 1, 200)) AS k FROM w),
s AS (SELECT k FROM h GROUP BY k HAVING min(doc_id) <> max(doc_id)),
c AS (SELECT doc_id, lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i AS step FROM h SEMI JOIN s ON h.k = s.k)
SELECT doc_id, CAST(sum(least(200, coalesce(step, 200))) AS BIGINT) AS shared_chars FROM c GROUP BY doc_id
"""


QUERIES = {"p3_found": p3_found, "p4_found": p4_found, "p4_repaired": p4_repaired, "p6_found": p6_found, "p6_decisions": p6_decisions, "p7_found": p7_found, "p7_pieces": p7_pieces, "p8_ids": p8_ids, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p10_found": p10_found, "p10_spans": p10_spans}
SQL = {"p3_found": P3_SQL, "p7_found": P7_SQL, "p10_found": P10_SQL}
