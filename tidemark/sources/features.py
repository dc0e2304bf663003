"""Feature partitions by (feature, as_of, window), with their quality."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import ContractError
from tidemark.operators.quality import feature_quality
from tidemark.sources.tables import folder_value

META = "feature_id string, as_of string, window int, rows bigint, status string, reason string, inputs string"


class FeatureStore:
    """Features below ``<root>/features/<domain>/<feature>``; one folder per as_of and window, metadata rows beside them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, feature_id: str) -> str:
        return f"{self.root}/features/{feature_id.split('.', 1)[0]}/{feature_id}"

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def write(self, feature_id: str, frame: DataFrame, *, as_of: str, window: int, analysis: Sequence[str] = (), inputs: dict[str, tuple[str, str]] | None = None, refresh: bool = False) -> dict:
        """Write one cross-section and its quality; a partition that is there already raises without ``refresh``.

        Degraded partitions are written too: their status tells.
        """
        quality = feature_quality(frame, list(analysis), inputs or {}).first()
        path = f"{self._path(feature_id)}/_pk_as_of=v{folder_value(as_of)}/_pk_window=v{window}"
        if self._exists(path) and not refresh:
            raise ContractError(f"{feature_id}: partition exists: {as_of}/{window}")
        frame.write.mode("overwrite" if refresh else "errorifexists").parquet(path)
        row = (feature_id, as_of, window, quality["rows"], quality["status"], quality["reason"], json.dumps({k: list(v) for k, v in (inputs or {}).items()}, sort_keys=True))
        self.spark.createDataFrame([row], META).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/features/_meta/{feature_id}/{folder_value(as_of)}-{window}")
        return quality.asDict()

    def read(self, feature_id: str, *, as_of: str, window: int, limit: int = 0) -> DataFrame:
        """Rows of one partition; the first ``limit`` where positive. Only its folder is read."""
        path = self._path(feature_id)
        if not self._exists(path):
            raise ContractError(f"{feature_id}: no partition")
        df = self.spark.read.parquet(path).where((F.col("_pk_as_of") == "v" + as_of) & (F.col("_pk_window") == f"v{window}")).drop("_pk_as_of", "_pk_window")
        return df.limit(limit) if limit > 0 else df

    def discover(self) -> DataFrame:
        """One metadata row per partition."""
        path = f"{self.root}/features/_meta"
        if not self._exists(path):
            return self.spark.createDataFrame([], META)
        return self.spark.read.schema(META).parquet(f"{path}/*/*")
