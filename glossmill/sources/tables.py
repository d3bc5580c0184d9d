"""The page store's tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def host_of(url: Column) -> Column:
    """Host of a URL, in lower case; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def optional(df: DataFrame, name: str, kind: str, default=None) -> DataFrame:
    """``df`` with a column ``name``; older stores lack some columns."""
    return df if name in df.columns else df.withColumn(name, F.lit(default).cast(kind))
