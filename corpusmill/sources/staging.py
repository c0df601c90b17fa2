"""Stage tables: results that later steps read several times, kept on the shared file system.

A stage table cuts the lineage, survives the loss of an executor and gives the planner the true
size, so that a following join is broadcast by Spark only when the table really is small.
"""

from __future__ import annotations

import atexit
import hashlib
import json
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_root() -> str:
    path = tempfile.mkdtemp(prefix="corpusmill-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_root()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the staging root."""
    return f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet table and read it back with its schema."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to, which it does when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a committed write left its success marker under ``path``."""
    jvm = spark._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def materialize_or_load(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], params: dict | None = None
) -> DataFrame:
    """Load the stage under ``path`` made with the same parameters, or build and save it.

    Each parameter set has its own sub-folder, so a result is never reused for other parameters,
    and a folder without the success marker is written again.
    """
    text = json.dumps(params or {}, sort_keys=True, default=str)
    target = f"{path.rstrip('/')}/params={hashlib.sha256(text.encode()).hexdigest()[:16]}"
    if not is_complete(spark, target):
        build().write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def spread(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Shuffle the rows to ``partitions`` by ``key``: for a few files that cannot be split, before costly work per row."""
    return df.repartition(partitions, key)
