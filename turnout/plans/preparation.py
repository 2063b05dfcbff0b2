"""From source tables to the clean participation table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from turnout import fixed_values as fv
from turnout.functions import cleaning as fn
from turnout.operators import prepare as step
from turnout.operators.joins import master_join, override_lookup, strict_lookup


def clean(raw: DataFrame, series_assignments: DataFrame, strict_miles: bool = False) -> DataFrame:
    """All cleaning steps on the wide participation table.

    The order matters: means of age and miles are taken before rows without a time
    are dropped, the mean fee after, and the series flag before missing series
    become 0. ``raw`` is read once per mean and once for the rows, so hand in a
    stored frame.
    """
    df = step.cast_ids(raw, "person_id")
    df = step.impute_age(df).drop("age")
    df = step.fill_defaults(df, ["distance"])
    df = step.impute_miles(df, strict_miles).drop("miles")
    df = step.fill_defaults(df, ["gender"])
    df = step.clean_times(df).drop("time")
    # the mean fee needs only these columns of the rows kept, not the filled ones
    fees = step.clean_times(raw.select("event_id", "time", "total_fee"))
    fee = fn.number_or_null(F.col("total_fee"))
    mean_fee = fees.agg(F.round(F.avg(fee), 2).alias("mean_fee")).scalar()
    df = df.withColumn("total_fee", F.coalesce(fee, mean_fee))
    df = step.prereg_flag(df).drop("ss_prereg", "registration_time")
    df = step.presence_flag(df, "emergency_contact_name", "has_emerg_contact")
    df = step.fill_defaults(df, ["tshirt", "hoodie"])
    df = override_lookup(step.unify_series(df), series_assignments, "event_id", "series_id")
    df = df.withColumn("has_series", fn.has_series_flag(F.col("series_id")))
    df = df.na.fill({"series_id": fv.DEFAULT_SERIES}).drop("series", "how_heard")
    return step.bucket_contact(step.bucket_payment(df))


def enrich(df: DataFrame, event_zips: DataFrame, strict: bool = True) -> DataFrame:
    """Adds the venue zip of each event."""
    return strict_lookup(df, event_zips, "event_id", "venue_zip", strict)


def prepare_participations(tables: Mapping[str, DataFrame], series_assignments: DataFrame,
                           event_zips: DataFrame, stage_path: str, strict: bool = True) -> DataFrame:
    """Master join, stored at ``stage_path``, then cleaning and enrichment."""
    from turnout.sources.tables import snapshot

    raw = snapshot(master_join(tables), stage_path)
    return enrich(clean(raw, series_assignments, strict), event_zips, strict)


def participation_core(clean_df: DataFrame) -> DataFrame:
    """The columns the grid, the recommenders and the retention report work on."""
    return clean_df.select(
        "person_id", "event_id", "event_date", "series_id", "event_type_id", "venue_zip",
        F.col("total_fee").alias("fee"), F.col("miles2").alias("miles"))


#: What lists of events and descriptions of their audience need on top of the core.
DETAILS = ("event_name", "event_type", "gender", "age2")


def participation_details(clean_df: DataFrame) -> DataFrame:
    """The core columns with event names and person attributes, a row per participation."""
    core = participation_core(clean_df).columns
    return clean_df.withColumns({"fee": F.col("total_fee"), "miles": F.col("miles2")}).select(
        *core, *[F.col(c).alias("age" if c == "age2" else c) for c in DETAILS])
