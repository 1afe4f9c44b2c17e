"""Tables written to the shared folder of the cluster, to cut lineage in long jobs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a folder of our own only in local mode where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "root" not in _own:
        _own["root"] = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, _own["root"], ignore_errors=True)
    return f"file://{_own['root']}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: every later use reads files that outlive executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
