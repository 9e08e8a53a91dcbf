"""Materialised intermediate tables.

A cohort-month table is orders of magnitude smaller than the movements it counts
and is read several times (latest month, threshold, label). Writing it once to
the cluster's shared folder means the movements are scanned once, and that losing
an executor costs a re-read of a small Parquet table, not a rescan.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local-mode session without one gets a temporary folder of its own.
    """
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    named = named or spark.sparkContext.getCheckpointDir()
    # local[...] is one machine; local-cluster[...] and all other masters are not
    one_machine = spark.sparkContext.master.split("[")[0] == "local"
    if named:
        return named.rstrip("/")
    if not one_machine:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="ebbflow-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/ebbflow/{app}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
