"""Counts, sizes and summaries of participation frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnout.operators.attendance import event_counts, person_counts
from turnout.operators.position import exact_quantiles, null_safe_join
from turnout.session import cut_lineage


def dataset_summary(parts: DataFrame) -> DataFrame:
    """People, events, participations, possible pairs and percent of pairs that did not happen.

    Distinct counts come from grouped keys: with two of them in one aggregate Spark
    would repeat every row once per key.
    """
    people = parts.groupBy("person_id").agg(F.count(F.lit(1)).alias("_n"))
    events = parts.select("event_id").distinct().agg(F.count(F.lit(1)).alias("events")).scalar()
    totals = people.agg(F.count(F.lit(1)).alias("people"), F.sum("_n").alias("participations"))
    possible = F.col("people") * F.col("events")
    return totals.withColumn("events", events).select(
        "people", "events", "participations", possible.alias("possible"),
        F.round((1 - F.try_divide("participations", possible)) * 100).alias("sparsity_pct"))


def group_size_range(parts: DataFrame) -> DataFrame:
    """Smallest and largest event, fewest and most events of a person."""
    sizes = [("event", event_counts(parts).select(F.col("total_part_count").alias("n"))),
             ("person", person_counts(parts).select(F.col("event_count").alias("n")))]
    rows = [df.agg(F.min("n").alias("min_size"), F.max("n").alias("max_size"))
            .withColumn("grouped_by", F.lit(name)) for name, df in sizes]
    return rows[0].unionByName(rows[1])


def size_histogram(sizes: DataFrame, column: str, buckets: int = 20) -> DataFrame:
    """Equal-width buckets between the smallest and largest size; the last one is closed."""
    counts = sizes.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    limits = sizes.agg(F.min(column).cast("double").alias("lo"),
                       F.max(column).cast("double").alias("hi"))
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    placed = F.when(hi > lo, F.least(
        F.floor((F.col(column) - lo) / ((hi - lo) / buckets)).cast("int") + 1, F.lit(buckets))
    ).otherwise(F.lit(1))
    filled = counts.withColumn("bucket", placed).groupBy("bucket").agg(F.sum("_n").alias("_n"))
    numbers = sizes.sparkSession.range(1, buckets + 1).select(F.col("id").cast("int").alias("bucket"))
    return numbers.join(filled, "bucket", "left").select(
        "bucket", (lo + (F.col("bucket") - 1) * (hi - lo) / buckets).alias("low"),
        (lo + F.col("bucket") * (hi - lo) / buckets).alias("high"),
        F.coalesce("_n", F.lit(0)).alias("n"))


def share_at_most(sizes: DataFrame, column: str, limits: list[int]) -> DataFrame:
    """Share of groups with at most k members, one row per k."""
    shares = sizes.agg(*[F.avg((F.col(column) <= k).cast("double")).alias(f"_{k}") for k in limits])
    entries = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_{k}").alias("share")) for k in limits])
    return shares.select(F.inline(entries))


def count_join_back(parts: DataFrame, key: str, attribute: str, n: int = 20) -> DataFrame:
    """The n largest groups with their attribute values, one row per distinct pair.

    Rows are reduced to pairs first, so only pairs are joined to the counts.
    """
    pairs = parts.groupBy(key, attribute).agg(F.count(F.lit(1)).alias("_n"))
    totals = pairs.groupBy(key).agg(F.sum("_n").alias("count"))
    return totals.join(pairs.select(key, attribute), key).select(key, attribute, "count").orderBy(
        F.desc("count"), key, attribute).limit(n)


def largest_events(parts: DataFrame, attributes: list[str]) -> DataFrame:
    """Events by attendance, with their attributes."""
    return parts.groupBy("event_id").agg(
        *[F.min(c).alias(c) for c in attributes], F.count("person_id").alias("attendance"),
    ).orderBy(F.desc("attendance"), "event_id")


def most_active_people(parts: DataFrame, attributes: list[str], order: list[str],
                       n: int = 10) -> DataFrame:
    """The n people with most rows, with the attributes of their first row."""
    first = F.min_by(F.struct(*attributes), F.struct(*order)).alias("_first")
    return parts.groupBy("person_id").agg(first, F.count(F.lit(1)).alias("attendance")).select(
        "person_id", "_first.*", "attendance").orderBy(F.desc("attendance"), "person_id").limit(n)


def max_group_mean(parts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Largest group mean of each column."""
    means = parts.groupBy(key).agg(*[F.avg(c).alias(c) for c in columns])
    return means.agg(*[F.max(c).alias(f"max_mean_{c}") for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def null_profile(df: DataFrame) -> DataFrame:
    """Values present per column, and the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(c) for c in df.columns])


def prediction_describe(scored: DataFrame, label: str = "participated",
                        prediction: str = "prediction") -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of predictions per label.

    ``scored`` is read once: all of it follows from the stored counts of distinct values.
    """
    value = F.nanvl(F.col(prediction).cast("double"), F.lit(None))
    counts = cut_lineage(scored.select(label, value.alias("p")).groupBy(label, "p").agg(F.count(F.lit(1)).alias("_n")))
    labels = counts.select(label).distinct()
    present = counts.filter("p IS NOT NULL")
    sums = present.groupBy(label).agg(
        F.sum("_n").alias("n"), F.try_divide(F.sum(F.col("p") * F.col("_n")), F.sum("_n")).alias("mean"),
        F.min("p").alias("min"), F.max("p").alias("max"))
    away = F.col("p") - F.col("mean")
    spread = null_safe_join(present, sums.select(label, "mean"), [label]).groupBy(label).agg(
        F.sqrt(F.try_divide(F.sum(away * away * F.col("_n")), F.sum("_n") - 1)).alias("std"))
    quartiles = exact_quantiles(present, label, "p", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, "_n")
    plain = null_safe_join(null_safe_join(labels, sums, [label], "left"), spread, [label], "left").select(
        label, F.coalesce("n", F.lit(0)).alias("n"), "mean", "std", "min", "max")
    return null_safe_join(plain, quartiles, [label], "left")


def distinct_rows(df: DataFrame, keys: list[str] | None = None,
                  order: list[str] | None = None) -> DataFrame:
    """Whole-row duplicates removed, or the first row per key by ``order``."""
    if not keys:
        return df.distinct()
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*(order or rest))).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def frame_diff(left: DataFrame, right: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Keys whose value differs between two frames, or that only one of them has."""
    a = left.select(*keys, F.col(column).alias("left_value"), F.lit(True).alias("_a"))
    b = right.select(*keys, F.col(column).alias("right_value"), F.lit(True).alias("_b"))
    both = a.join(b, keys, "full")
    kind = (F.when(F.col("_b").isNull(), F.lit("only_left"))
            .when(F.col("_a").isNull(), F.lit("only_right"))
            .when(~F.col("left_value").eqNullSafe(F.col("right_value")), F.lit("changed")))
    return both.withColumn("difference", kind).filter(F.col("difference").isNotNull()).drop("_a", "_b")
