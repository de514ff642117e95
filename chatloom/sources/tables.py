"""Readers of the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table; timestamps without zone are read as UTC instants."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    ntz = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df
