"""Recommended events and the people they are recommended to, in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame

from turnout.operators import recommend
from turnout.session import cut_lineage

EVENT_ATTRIBUTES = ["event_name", "event_date", "event_type", "series_id", "venue_zip"]
PERSON_ATTRIBUTES = ["gender", "age"]


def audience_run(scored: DataFrame, details: DataFrame, k: int = 5, n: int = 10,
                 event_attributes: list[str] = EVENT_ATTRIBUTES) -> dict[str, DataFrame]:
    """Top lists, what the events in them are like, and who their audience is.

    ``scored``: person_id, event_id, prediction; read once, as the top lists are stored.
    ``details``: participations with event and person attributes. A person is described by
    the first participation by event date and id.
    """
    top = cut_lineage(recommend.top_k_per_person(scored.select("person_id", "event_id", "prediction"), k))
    people = cut_lineage(recommend.person_profile(
        details, PERSON_ATTRIBUTES, ["event_date", "event_id", *PERSON_ATTRIBUTES]))
    audience = recommend.audience_profile(top, people)
    return {
        "top_lists": top,
        "event_counts": recommend.top_event_counts(top),
        "event_details": recommend.top_event_details(top, details, event_attributes),
        "snapshot": recommend.top_events_snapshot(top, details, event_attributes, n),
        "likely_audience": recommend.likely_audience(top),
        "gender_share": recommend.audience_gender_share(audience, people),
        "age": recommend.audience_age(audience, details),
    }
