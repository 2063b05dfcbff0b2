"""Ledgers of evaluation results, kept as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from turnout.schemas import ALS_TUNE_LEDGER


def read_metric_ledger(
    spark: SparkSession, path: str, schema: T.StructType = ALS_TUNE_LEDGER
) -> DataFrame:
    """Rows shorter than the header get NULL in the missing tail; ``nan`` becomes NULL."""
    rows = spark.read.schema(schema).csv(
        path, header=True, mode="PERMISSIVE", nanValue="nan", enforceSchema=True)
    return rows.select(*[
        F.nanvl(F.col(f.name), F.lit(None)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in schema
    ])


def write_metric_ledger(df: DataFrame, path: str) -> None:
    """Append results to a ledger."""
    df.write.mode("append").csv(path, header=True)


def tuning_curve(ledger: DataFrame, factors: int) -> DataFrame:
    """Rank by alpha for one factor count, next to the model's mean popularity rank."""
    return ledger.filter(F.col("factors") == factors).select(
        "als_model", "alpha", "model_rank",
        F.avg("popular_rank").over(W.partitionBy("als_model")).alias("mean_popular_rank"))
