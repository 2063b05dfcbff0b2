"""Shared by the operators: stored tables and row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnout.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as parquet below ``spark.checkpoint.dir`` and read from there.

    Cuts the plan, survives lost executors, and lets a later join see two plain
    exchanges, which adaptive execution can split when a key is hot.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))
