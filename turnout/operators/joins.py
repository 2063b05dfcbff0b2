"""Joins of the source tables and of lookups.

No side is broadcast by hint: lookups are small today, but their size is not
known here. Spark measures them (static sizes, then adaptive ones), broadcasts
those below its threshold and sort-merges the rest with skew splitting. For the
latter a lookup has to be a stored table: adaptive execution splits a hot key only
if both sides of the join come straight out of a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from turnout.schemas import PARTICIPATION


def ci_key_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a text key, ignoring case; keeps the left spelling."""
    folded = right.withColumn("_key", F.lower(key)).drop(key)
    return left.withColumn("_key", F.lower(key)).join(folded, "_key", "left").drop("_key")


def composite_key_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left")


def master_join(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All lookups on the registrations: one wide participation row each.

    What hangs on the event is joined to the event first, so that registrations are
    moved once for it and not four times; the full join keeps series of events that
    the event table lacks. A lookup key that repeats multiplies rows, as in SQL;
    check a table with ``assert_unique_keys`` where that must not happen.
    """
    events = (
        tables["events"].join(tables["series_events"], "event_id", "full")
        .join(tables["event_types"], "event_type_id", "left")
        .join(tables["series"], "series_id", "left")
    )
    wide = ci_key_join(tables["person_events"], tables["distances"], "distance")
    wide = wide.join(events, "event_id", "left").join(tables["persons"], "person_id", "left")
    wide = composite_key_join(wide, tables["ss_team_people"], ["person_id", "event_id"])
    return wide.withColumnRenamed("prereg", "ss_prereg").select(*PARTICIPATION.names)


def override_lookup(df: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """Take the lookup's value where it lists the key (even a NULL), else keep the row's."""
    found = lookup.select(key, F.col(column).alias("_new"), F.lit(True).alias("_listed"))
    return (
        df.join(found, key, "left")
        .withColumn(column, F.when(F.col("_listed"), F.col("_new")).otherwise(F.col(column)))
        .drop("_new", "_listed")
    )


def strict_lookup(df: DataFrame, lookup: DataFrame, key: str, column: str,
                  strict: bool = True) -> DataFrame:
    """Add a column by key; a key the lookup does not list is an error if ``strict``."""
    found = lookup.select(key, column, F.lit(True).alias("_listed"))
    joined = df.join(found, key, "left")
    if strict:
        message = F.concat(F.lit(f"no {column} for {key} "), F.col(key).cast("string"))
        joined = joined.withColumn(
            column, F.when(F.col("_listed"), F.col(column)).otherwise(F.raise_error(message)))
    return joined.drop("_listed")
