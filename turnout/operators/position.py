"""Positions in a total order, without sorting all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from turnout.session import cut_lineage

# bits of an id that one step of a selection looks at: 65,536 ranges a step
STEP_BITS = 16


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key equals a null key; keeps the left side's keys."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def running_total(df: DataFrame, coarse: str, fine: list[Column | str], amount: Column,
                  within: list[str] | None = None) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` over all earlier rows.

    Rows are ordered by ``coarse`` then ``fine``, separately per ``within``; nulls
    are values like others there and come last in ``coarse``. Only
    the totals per coarse value are ordered as a whole; inside a coarse value each
    task orders its own rows.
    """
    within = within or []
    totals = df.groupBy(*within, coarse).agg(F.sum(amount).alias("_total"))
    earlier = W.partitionBy(*within).orderBy(F.col(coarse).asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1)
    offsets = totals.select(
        *within, coarse, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(*within, coarse).orderBy(*fine).rowsBetween(W.unboundedPreceding, -1)
    return (
        null_safe_join(df, offsets, [*within, coarse])
        .withColumn("before", F.col("_offset") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_offset")
    )


def running_position(df: DataFrame, coarse: str, fine: list[Column | str],
                     within: list[str] | None = None) -> DataFrame:
    """Adds ``position``, counted from 1, by ``coarse`` then ``fine``."""
    placed = running_total(df, coarse, fine, F.lit(1), within)
    return placed.withColumn("position", F.col("before") + 1).drop("before")


def dense_codes(df: DataFrame, column: str) -> DataFrame:
    """(id, code): every distinct value of a column and its number from 0, in order. Nulls have no code."""
    ids = df.select(F.col(column).alias("id")).filter("id IS NOT NULL").distinct()
    return cut_lineage(ranged_total(ids, [F.col("id")], F.lit(1)).select("id", F.col("before").alias("code")))


def ranged_total(df: DataFrame, order: list[Column], amount: Column) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` over all earlier rows by ``order``, which tells all rows apart.

    Rows are dealt to ranges of the whole order by a sample of it, so neither an outlying
    value nor a large group of ties fills a range. The ranges are stored; a row's sum is
    that of all earlier ranges plus that of the earlier rows of its own.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(
        W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return ranged.join(F.broadcast(offsets), "_part").withColumn(
        "before", F.col("_offset") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).drop("_part", "_offset")


def nth_ids(members: DataFrame, wanted: DataFrame, group: str, id_col: str) -> DataFrame:
    """The id at which the running count of ``members`` reaches ``wanted.quota``.

    ``members``: group, id (whole number), n (rows of that id); it is read once a step.
    ``wanted``: group, quota (>= 1). Returns group, quota, boundary_id, and
    ``boundary_rows``: how many rows of that id the quota takes.

    The id is found from its leading bits on: ids are counted by ``STEP_BITS`` more bits
    in each step, and only the range that holds the boundary is looked at in the next.
    A step orders at most 65,536 counts per boundary, wherever the ids lie; there are as
    many steps as the span of the ids asks for, four at most.
    """
    low, high = members.agg(F.min(id_col), F.max(id_col)).first()
    bits = (low ^ high).bit_length() if low is not None and (low < 0) == (high < 0) else 64
    shift = max(0, bits - STEP_BITS)
    hits = wanted.select(group, "quota", F.col("quota").alias("_left"), F.lit(0).cast("long").alias("_range"))
    rows = members.withColumns({"_range": F.lit(0).cast("long"), "_next": F.shiftright(F.col(id_col).cast("long"), shift)})
    while True:
        totals = rows.groupBy(group, "_range", "_next").agg(F.sum("n").alias("_n"))
        upto = F.sum("_n").over(W.partitionBy(group, "_range").orderBy("_next"))
        hits = totals.withColumn("_upto", upto).join(hits, [group, "_range"]).filter(
            (F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left"))
        ).select(group, "quota", (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left"),
                 F.col("_next").alias("_range"))
        if not shift:
            return hits.select(group, "quota", F.col("_range").alias("boundary_id"), F.col("_left").alias("boundary_rows"))
        hits = cut_lineage(hits)
        before, shift = shift, max(0, shift - STEP_BITS)
        rows = members.withColumns({
            "_range": F.shiftright(F.col(id_col).cast("long"), before),
            "_next": F.shiftright(F.col(id_col).cast("long"), shift),
        }).join(F.broadcast(hits.select(group, "_range").distinct()), [group, "_range"], "left_semi")


def exact_quantiles(df: DataFrame, group: str, value: str, shares: dict[str, float],
                    n: str | None = None) -> DataFrame:
    """Interpolated quantiles per group, from counts of distinct values.

    ``percentile`` keeps all distinct values of a group in one task's memory; here they
    are counted and ordered range by range. ``n`` names the counts of a frame that has
    each value once.
    """
    counts = df.filter(F.col(value).isNotNull())
    if n is None:
        n, counts = "_n", counts.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = ranged_total(counts, [F.col(group), F.col(value)], F.col(n))
    starts = placed.groupBy(group).agg(F.min("before").alias("_start"), F.sum(n).alias("_rows"))
    placed = null_safe_join(placed, starts, [group]).withColumn("before", F.col("before") - F.col("_start"))
    picks = []
    for name, share in shares.items():
        rank = F.lit(share) * (F.col("_rows") - 1)
        first, upper = F.col("before"), F.col("before") + F.col(n)
        low = F.max(F.when((first <= F.floor(rank)) & (F.floor(rank) < upper), F.col(value)))
        high = F.max(F.when((first <= F.ceil(rank)) & (F.ceil(rank) < upper), F.col(value)))
        part = F.max(rank - F.floor(rank))
        picks.append((low + (high - low) * part).alias(name))
    return placed.groupBy(group).agg(*picks)
