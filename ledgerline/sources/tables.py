"""Parquet tables of one input directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    """The table `name` of `directory`; with `columns`, only those (the scan reads no others)."""
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return df.select(*columns) if columns else df


def filled(df: DataFrame, *columns: str) -> DataFrame:
    """Those columns of df, in that order; what df lacks is a null text."""
    have = set(df.columns)
    return df.select(*(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns))
