"""Streams of source rows: incremental deduplication and keep-last tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ingest import keep_last


def distinct_records(stream: DataFrame, *, id_column: str, event_time: str, delay: str = "7 days") -> DataFrame:
    """Rows of a stream once per id; repeats that come within ``delay`` are dropped, and state older than that with them.

    Null ids stand for nothing and are left out.
    """
    return stream.where(F.col(id_column).isNotNull()).withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id_column])


def windowed_totals(stream: DataFrame, *, event_time: str, entity: str, value: str, every: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Totals, rows and latest value per entity and tumbling window; rows later than ``delay`` are not counted."""
    timed = stream.withWatermark(event_time, delay)
    return timed.groupBy(F.window(event_time, every).alias("w"), entity).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("rows"), F.max_by(value, event_time).alias("latest")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), entity, "total", "rows", "latest")


def keep_last_table(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], *, ordinal: str, buckets: int = 64) -> StreamingQuery:
    """Maintain the last row of each key below ``path``, in ``buckets`` by a hash of the key.

    A micro-batch reads and writes anew only the buckets its keys fall in, below ``v=<batch>``, and then a manifest that names the version
    of every bucket. A batch that is run again after a failure overwrites its own version only. Readers go by the greatest manifest.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = sorted(r._bucket for r in rows.select("_bucket").distinct().collect())  # at most ``buckets``
        held = versions(spark, path, below=batch_id)
        here = f"{path}/v={batch_id:012d}"
        before = [f"{path}/v={held[b]:012d}/_bucket={b}" for b in touched if b in held]
        if before:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(*before).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        keep_last(rows, ["_bucket", *keys], ordinal=ordinal).write.mode("overwrite").partitionBy("_bucket").parquet(here)
        _write_manifest(spark, path, batch_id, held | dict.fromkeys(touched, batch_id))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _hadoop(spark, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _write_manifest(spark, path: str, batch_id: int, held: dict[int, int]) -> None:
    name = f"{path}/_manifests/{batch_id:012d}"
    fs, draft = _hadoop(spark, f"{name}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(held, sort_keys=True).encode()))
    out.close()
    _, final = _hadoop(spark, name)
    fs.delete(final, False)
    fs.rename(draft, final)


def versions(spark, path: str, below: int | None = None) -> dict[int, int]:
    """Version of each bucket by the greatest manifest (below a batch, where given)."""
    fs, root = _hadoop(spark, f"{path}/_manifests")
    if not fs.exists(root):
        return {}
    names = sorted(n for s in fs.listStatus(root) if (n := s.getPath().getName()).isdigit() and (below is None or int(n) < below))
    if not names:
        return {}
    read = fs.open(_hadoop(spark, f"{path}/_manifests/{names[-1]}")[1])
    try:
        text = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(read)).decode()
    finally:
        read.close()
    return {int(k): v for k, v in json.loads(text).items()}


def read_table(spark, path: str, schema) -> DataFrame:
    """The last row of each key, as of the greatest manifest."""
    folders = [f"{path}/v={v:012d}/_bucket={b}" for b, v in versions(spark, path).items()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


__all__ = ["distinct_records", "keep_last_table", "read_table", "versions", "windowed_totals"]
