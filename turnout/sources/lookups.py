"""Small lookup files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnout.schemas import EVENT_ZIPS, SERIES_ASSIGNMENTS


def read_series_assignments(spark: SparkSession, path: str) -> DataFrame:
    """Event to series assignments; the file puts text in single quotes."""
    rows = spark.read.schema(SERIES_ASSIGNMENTS).csv(path, header=True, quote="'")
    return rows.withColumn("series_id", F.col("series_id").cast("int"))


def read_event_zips(spark: SparkSession, path: str) -> DataFrame:
    """Event to venue zip; drops the row index and trailing blanks of names."""
    rows = spark.read.schema(EVENT_ZIPS).csv(path, header=True)
    return rows.drop("row_index").withColumn(
        "event_name", F.regexp_replace("event_name", r"\s+$", ""))
