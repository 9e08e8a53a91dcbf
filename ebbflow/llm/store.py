"""Intermediate tables of these operators, in the shared folder the session names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ebbflow.sources.layers import new_path


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write `df` once and return a scan of it: lineage ends there, a lost executor costs a re-read."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
