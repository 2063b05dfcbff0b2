"""The retention report in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame

from turnout.operators import retention
from turnout.session import cut_lineage


def attendance_report(parts: DataFrame, waterline: int = 40) -> dict[str, DataFrame]:
    """Person summary, event summary and the figures drawn from them.

    The event summary is stored, since five of the results start from it.
    """
    people = retention.person_summary(parts)
    events = cut_lineage(retention.event_summary(people))
    return {
        "people": people,
        "events": events,
        "repeat_report": retention.repeat_report(people),
        "single_series_breakdown": retention.single_series_breakdown(people),
        "cutoff": retention.observation_cutoff(events),
        "return_series": retention.return_series(events, "under"),
        "events_of_interest": retention.events_of_interest(events, "under", waterline),
    }
