"""Contract-governed tables as Hive-partitioned Parquet, with one metadata row per partition."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.contracts import ContractError, DatasetContract, Registry, default_registry
from tidemark.functions.exprs import compact_date
from tidemark.operators.quality import BLOCKING, table_quality
from tidemark.operators.windows import last_partitions

META_SCHEMA = "dataset_id string, partition map<string,string>, rows bigint, columns array<string>, schema string, temporal map<string,string>, status string, reason string, lineage string, published_at string"


def folder_value(value: str) -> str:
    """A partition value as part of a folder name, in the escapes readers undo."""
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{}[]^" or ord(c) < 32 or ord(c) == 127 else c for c in value)


class TableStore:
    """One layer (raw, staging, mart) of tables below a folder.

    A dataset lies in ``<root>/<layer>/<domain>/<dataset>``, partitioned by its contract's keys. Folder values
    carry a leading letter, so readers never take them for numbers: leading zeros and date order hold. Metadata
    rows are appended as Parquet beside the data, in a folder readers skip; they also tell which partitions and
    columns there are, so neither listing partitions nor planning a scan reads data files.
    """

    def __init__(self, spark: SparkSession, root: str, layer: str = "mart", registry: Registry | None = None):
        self.spark, self.root, self.layer = spark, root.rstrip("/"), layer
        self.registry = registry or default_registry()

    def path(self, contract: DatasetContract) -> str:
        return f"{self.root}/{self.layer}/{contract.domain}/{contract.dataset_id}"

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def scan(self, dataset_id: str) -> DataFrame:
        """The whole dataset, lazily; filters on partition keys prune, columns are read as selected.

        Columns are those of all its partitions together; a partition without one holds null there. A column of two types raises.
        """
        contract = self.registry.require(dataset_id)
        mine = self.meta().where(F.col("dataset_id") == dataset_id)
        found = [StructType.fromJson(json.loads(r.schema)) for r in mine.groupBy("schema").agg(F.min("published_at").alias("at")).orderBy("at").collect()]  # one row per form of the dataset
        if not found:
            raise ContractError(f"{dataset_id}: no partition published")
        whole: dict = {}
        for form in found:
            for f in form:
                if whole.setdefault(f.name, f).dataType != f.dataType:
                    raise ContractError(f"{dataset_id}: column {f.name} is {whole[f.name].dataType.simpleString()} and {f.dataType.simpleString()}")
        schema = StructType([*[f for f in whole.values() if f.name not in contract.partition_keys], *StructType.fromDDL(", ".join(f"_pk_{k} string" for k in contract.partition_keys))])
        df = self.spark.read.schema(schema).option("basePath", self.path(contract)).parquet(self.path(contract))
        return df.withColumns({k: F.substring(f"_pk_{k}", 2, 2**31 - 1) for k in contract.partition_keys}).drop(*[f"_pk_{k}" for k in contract.partition_keys])

    def read(self, dataset_id: str, partition: dict[str, str], columns: list[str] | None = None) -> DataFrame:
        """Rows of one partition; all its keys must be given."""
        contract = self.registry.require(dataset_id)
        if set(partition) != set(contract.partition_keys):
            raise ContractError(f"{dataset_id}: partition keys must be {contract.partition_keys}")
        return self.matching(dataset_id, partition, columns)

    def matching(self, dataset_id: str, partition: dict[str, str], columns: list[str] | None = None, limit: int = 0) -> DataFrame:
        """Rows of all partitions that match part of the keys; the last ``limit`` of those partitions where given."""
        contract = self.registry.require(dataset_id)
        if unknown := set(partition) - set(contract.partition_keys):
            raise ContractError(f"{dataset_id}: unknown partition keys {sorted(unknown)}")
        df = self.scan(dataset_id)
        for k, v in partition.items():
            df = df.where(F.col(k) == v)  # on the folder value, so partitions are pruned
        if limit > 0:
            df = last_partitions(df, list(contract.partition_keys), limit)
        return df.select(*columns) if columns else df

    def window(self, dataset_id: str, as_of: str, count: int, *, key: str | None = None, columns: list[str] | None = None) -> DataFrame:
        """Rows of the last ``count`` partitions there are up to ``as_of``; datasets of several keys need ``key``."""
        contract = self.registry.require(dataset_id)
        if key is None and len(contract.partition_keys) > 1:
            raise ContractError(f"{dataset_id}: windows over several partition keys need a key")
        df = last_partitions(self.scan(dataset_id), list(contract.partition_keys), count, key=key, as_of=as_of)
        return df.select(*columns) if columns else df

    def partitions(self, dataset_id: str) -> DataFrame:
        """The partition values there are, one row each, from the metadata."""
        contract = self.registry.require(dataset_id)
        mine = self.meta().where(F.col("dataset_id") == dataset_id)
        return mine.select(*[F.try_element_at("partition", F.lit(k)).alias(k) for k in contract.partition_keys])

    def latest(self, dataset_id: str, as_of: str | None = None) -> DataFrame:
        """Rows of the greatest partition, up to ``as_of`` where given."""
        contract = self.registry.require(dataset_id)
        return last_partitions(self.scan(dataset_id), list(contract.partition_keys), 1, as_of=as_of)

    def meta(self) -> DataFrame:
        """The latest metadata row of every partition."""
        path = f"{self.root}/{self.layer}/_meta"
        if not self._exists(path):
            return self.spark.createDataFrame([], META_SCHEMA)
        rows = self.spark.read.schema(META_SCHEMA).parquet(path).withColumn("_k", F.sort_array(F.map_entries("partition")).cast("string"))
        last = rows.groupBy("dataset_id", "_k").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("dataset_id", "_k")]), "published_at").alias("m"))
        return last.select("dataset_id", "m.*")

    def publish(self, dataset_id: str, rows: DataFrame, partition: dict[str, str], *, lineage: dict | None = None, refresh: bool = False) -> dict:
        """Check a partition and write it; returns its metadata.

        Raises if the quality blocks it, or if it is there already and ``refresh`` isn't set. Data that is
        provisional must not replace final data; contracts keep the two in datasets of their own.
        """
        contract = self.registry.require(dataset_id)
        path = self.path(contract) + "".join(f"/_pk_{k}=v{folder_value(partition[k])}" for k in contract.partition_keys if k in partition)
        if self._exists(path) and not refresh:
            raise ContractError(f"{dataset_id}: partition exists: {partition}")
        staged = f"{self.root}/{self.layer}/_staged/{uuid.uuid4().hex}"
        fs, at = self._fs(staged)
        try:
            rows.write.parquet(staged)  # what is checked below is what is published, also if ``rows`` would come out otherwise a second time
            kept = self.spark.read.schema(rows.schema).parquet(staged)
            quality = table_quality(kept, contract, partition).first().asDict()
            if quality["status"] in BLOCKING:
                raise ContractError(f"{dataset_id}: {quality['status']}: {quality['reason']}")
            _, to = self._fs(path)
            fs.mkdirs(to.getParent())
            if fs.exists(to):
                fs.delete(to, True)
            if not fs.rename(at, to):
                raise OSError(f"{dataset_id}: could not publish {partition}")
        finally:
            fs.delete(at, True)
        temporal = {"temporal_mode": contract.temporal.temporal_mode, "finality": contract.temporal.finality, "available_after": contract.temporal.available_after, "as_of_policy": contract.temporal.as_of_policy}
        meta = (dataset_id, partition, quality["rows"], rows.columns, rows.schema.json(), temporal, quality["status"], quality["reason"], json.dumps(lineage or {}, sort_keys=True), datetime.now(UTC).isoformat(timespec="microseconds"))
        self.spark.createDataFrame([meta], META_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/{self.layer}/_meta")
        return quality


def coverage_entries(partitions: DataFrame, contracts: DataFrame, as_of: str) -> DataFrame:
    """Per dataset: partitions, matched, active and coverage status at ``as_of``.

    ``partitions`` has dataset_id, partition_date; ``contracts`` dataset_id, n_keys, as_of_policy. The
    date asked for is matched exactly; where there is none, latest_before falls back to the greatest date before it, never
    to a later one. Datasets without a partition have none.
    """
    d = compact_date(F.col("partition_date"))
    per = partitions.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("partitions"), F.count_if(d == as_of).alias("matched"), F.max(F.when(d <= as_of, d)).alias("before"))
    out = contracts.join(per, "dataset_id", "left").withColumns({"partitions": F.coalesce("partitions", F.lit(0)), "matched": F.coalesce("matched", F.lit(0))})
    fallback = (F.col("as_of_policy") == "latest_before") & (F.col("n_keys") == 1) & F.col("before").isNotNull()
    status = F.when((F.col("matched") > 0) & (F.col("n_keys") > 1), "partial").when(F.col("matched") > 0, "full").when(fallback, "latest_before").otherwise("none")
    active = F.when(F.col("matched") > 0, F.lit(as_of)).when(fallback, F.col("before"))
    return out.select("dataset_id", "partitions", "matched", active.alias("active"), status.alias("coverage"))


def append_records(batch: DataFrame, existing: DataFrame, path: str, *, id_column: str, ordinal: str) -> DataFrame:
    """Append the rows of a batch whose id is new to a JSON-lines folder; gives those rows."""
    from tidemark.operators.evidence import new_records
    from tidemark.session import written

    fresh = written(new_records(batch, existing, id_column=id_column, ordinal=ordinal), "fresh-records")
    fresh.write.mode("append").json(path)
    return fresh


def raw_path(root: str, source_id: str, api: str, params: dict, requested_at: str) -> str:
    import hashlib

    digest = hashlib.sha256(json.dumps({"source": source_id, "api": api, "params": params, "at": requested_at}, sort_keys=True).encode()).hexdigest()[:16]
    return f"{root.rstrip('/')}/raw/{source_id}/{api}/{digest}"


def write_raw(rows: DataFrame, root: str, source_id: str, api: str, params: dict, requested_at: str, artifacts: DataFrame | None = None) -> str:
    """Append-only raw layer: JSON lines below a hash of the request, each with the request as ``_request``; a request recorded already raises.

    ``artifacts`` (name, content as bytes) are kept beside them with their size and SHA-256, in a folder readers of the rows skip.
    """
    path = raw_path(root, source_id, api, params, requested_at)
    request = F.create_map(*[F.lit(str(x)) for kv in sorted(params.items()) for x in kv]) if params else F.create_map().cast("map<string,string>")
    rows.withColumn("_request", request).write.mode("errorifexists").json(path)
    if artifacts is not None:
        kept = artifacts.select("name", "content", F.length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"))
        kept.write.mode("errorifexists").parquet(f"{path}/_artifacts")
    return path


def recorded(spark: SparkSession, root: str, source_id: str, api: str, columns: str) -> DataFrame:
    """All recorded rows of an api, in ``columns`` (a DDL string), with the request they answered: what ``ingest.replay`` takes."""
    return spark.read.schema(f"{columns}, _request map<string,string>").json(f"{root.rstrip('/')}/raw/{source_id}/{api}/*")
