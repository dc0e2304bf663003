"""Session helpers: settings the plans rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share, named by the cluster in ``spark.checkpoint.dir``.

    Only where the setting is absent and everything runs on one machine (a local master, as in tests) a temporary folder is made; on a
    cluster its executors could not see it, so there the setting is required.
    """
    set_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_dir:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(set_dir)
        return set_dir.rstrip("/")
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: once per context, as an archive served by the driver."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="tidemark-archive-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = Path(__file__).resolve().parent
    with zipfile.ZipFile(f"{folder}/tidemark.zip", "w") as z:
        for f in sorted(package.rglob("*")):
            if f.suffix in (".py", ".psv"):
                z.write(f, f"{package.name}/{f.relative_to(package)}")
    sc.addPyFile(f"{folder}/tidemark.zip")
    sc._tidemark_shipped = True


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only if it is proven to have at most ``max_rows`` rows.

    The rows are fetched behind a limit of ``max_rows + 1``. A larger frame comes back without
    a hint, so the join falls back to a shuffled one.
    """
    from pyspark.sql import functions as F

    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")
