"""Recommendation lists from scored person x event rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from turnout.operators.attendance import paged_roster


def top_k_per_person(scored: DataFrame, k: int = 5) -> DataFrame:
    """The k best-scored rows per person with ``place``; ties go by event id.

    The filter on the window lets Spark keep k rows per person before anything
    moves. A person has at most one row per event.
    """
    order = W.partitionBy("person_id").orderBy(F.desc("prediction"), "event_id")
    return scored.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def top_event_counts(top: DataFrame) -> DataFrame:
    """How many top lists an event is in, most frequent first."""
    return top.groupBy("event_id").agg(F.count(F.lit(1)).alias("top_count")).orderBy(
        F.desc("top_count"), "event_id")


def likely_audience(top: DataFrame) -> DataFrame:
    """People with the event in their top list, in pages of bounded size."""
    return paged_roster(top)


def top_event_details(top: DataFrame, parts: DataFrame, attributes: list[str]) -> DataFrame:
    """Top-list counts next to event attributes, mean fee and mean miles (two decimals)."""
    details = parts.groupBy("event_id").agg(
        *[F.min(c).alias(c) for c in attributes],
        F.round(F.avg("fee"), 2).alias("mean_fee"), F.round(F.avg("miles"), 2).alias("mean_miles"))
    counts = top.groupBy("event_id").agg(F.count(F.lit(1)).alias("top_count"))
    return counts.join(details, "event_id").orderBy(F.desc("top_count"), "event_id")


def top_events_snapshot(top: DataFrame, parts: DataFrame, attributes: list[str],
                        n: int = 10) -> DataFrame:
    """The n most recommended events with their actual attendance."""
    counts = top.groupBy("event_id").agg(F.count(F.lit(1)).alias("top_count"))
    actual = parts.groupBy("event_id").agg(
        *[F.min(c).alias(c) for c in attributes], F.count("person_id").alias("attendance"))
    return counts.join(actual, "event_id").orderBy(F.desc("top_count"), "event_id").limit(n)


def person_profile(parts: DataFrame, attributes: list[str], order: list[str]) -> DataFrame:
    """One row per person: the attributes of the person's first row by ``order``."""
    first = parts.groupBy("person_id").agg(
        F.min_by(F.struct(*attributes), F.struct(*order)).alias("_first"))
    return first.select("person_id", "_first.*")


def audience_profile(top: DataFrame, profiles: DataFrame) -> DataFrame:
    """Audience of every event, one row per event and person, with person attributes."""
    return top.select("event_id", "person_id").join(profiles, "person_id")


def audience_gender_share(audience: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per event the shares of men and women in the audience and in the population.

    Audience shares are of all its people, population shares of those recorded as
    male or female.
    """
    def share(gender: str):
        return F.avg(F.coalesce(F.col("gender") == gender, F.lit(False)).cast("double"))

    population = profiles.filter(F.col("gender").isin("Male", "Female")).agg(
        share("Male").alias("male"), share("Female").alias("female"))
    return audience.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("audience"),
        share("Male").alias("male_share"), share("Female").alias("female_share"),
    ).withColumns({
        "population_male_share": population.select("male").scalar(),
        "population_female_share": population.select("female").scalar(),
    })


def audience_age(audience: DataFrame, parts: DataFrame) -> DataFrame:
    """Per event the mean age of its audience, and that over all participations."""
    overall = parts.agg(F.round(F.avg("age"), 1).alias("age")).scalar()
    return audience.groupBy("event_id").agg(
        F.round(F.avg("age"), 1).alias("audience_age")).withColumn("population_age", overall)
