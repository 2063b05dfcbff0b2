"""Participations condensed to one row per person and event, and lists of ids.

Condensing comes first wherever a person's or an event's rows are brought
together: it aggregates before the shuffle, and afterwards a person has at most
as many rows as there are events, however many rows one person started with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# a list of person ids covers this many consecutive ids
ROSTER_RANGE = 10_000


def attendance(parts: DataFrame, *attributes: str) -> DataFrame:
    """person_id, event_id, visits (rows), smallest value of each attribute."""
    return parts.groupBy("person_id", "event_id").agg(
        F.count(F.lit(1)).alias("visits"), *[F.min(c).alias(c) for c in attributes])


def person_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("person_id").agg(F.count("event_id").alias("event_count"))


def event_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("event_id").agg(F.count("person_id").alias("total_part_count"))


def event_attributes(parts: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per event: its attributes and whole-number mean fee and miles.

    Attributes are properties of the event and equal on all its rows; where they
    are not, the smallest is taken.
    """
    keep = keep or ["event_date", "series_id", "event_type_id", "venue_zip"]
    return parts.groupBy("event_id").agg(
        *[F.min(c).alias(c) for c in keep],
        F.round(F.avg("fee")).cast("int").alias("total_fee_avg"),
        F.round(F.avg("miles")).cast("int").alias("miles_avg"))


def user_attributes(parts: DataFrame, order: list[str]) -> DataFrame:
    """One row per person: first gender and mean age as a whole number."""
    return parts.groupBy("person_id").agg(
        F.min_by("gender", F.struct(*order)).alias("gender"),
        F.round(F.avg("age")).cast("int").alias("age_avg"))


def paged_roster(pairs: DataFrame, *attributes: str, ids: Column | None = None) -> DataFrame:
    """Person ids per event as lists: event_id, page, n_people, person_ids.

    ``pairs`` has one row per event and person. A page holds the ids of one range
    of ``ROSTER_RANGE`` ids, so a list has a fixed upper size even if the event
    has drawn a third of all people; all pages together are the whole list.
    """
    person = ids if ids is not None else F.col("person_id")
    return (
        pairs.withColumn("page", F.floor(person / ROSTER_RANGE))
        .groupBy("event_id", "page")
        .agg(*[F.min(c).alias(c) for c in attributes],
             F.count(F.lit(1)).alias("n_people"),
             F.sort_array(F.collect_list(person)).alias("person_ids"))
    )


def event_roster(parts: DataFrame, *attributes: str) -> DataFrame:
    """Who took part in each event, in pages."""
    return paged_roster(attendance(parts, *attributes), *attributes)
