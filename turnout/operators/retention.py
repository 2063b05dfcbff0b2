"""One-off, repeat and cross-series attendance, and returns of first-timers.

Everything starts from one frame, a row per person with the person's events in
order. Event figures are taken from it by exploding, so persons and events are
never joined and each person's rows move once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnout import fixed_values as fv
from turnout.functions.cleaning import decode_series, zero_to_null
from turnout.operators.attendance import ROSTER_RANGE, attendance, paged_roster
from turnout.operators.position import null_safe_join, running_position
from turnout.session import cut_lineage

UNDER, OVER = (f"{word} {fv.RETURN_WINDOW_DAYS} days" for word in ("Under", "Over"))


def repeat_lag(event_count: Column, first: Column, second: Column,
               days: int = fv.RETURN_WINDOW_DAYS) -> Column:
    """One Off, Under or Over the window between the first two dates; equal is Over."""
    return (F.when(event_count == 1, F.lit(fv.ONE_OFF))
            .when(F.datediff(second, first) < days, F.lit(f"Under {days} days"))
            .otherwise(F.lit(f"Over {days} days")))


def cross_series_status(event_count: Column, series: Column) -> Column:
    """One Off, 'Single - <series>' or Multiple, from an array of series ids."""
    distinct = F.array_distinct(series)
    single = F.concat(F.lit("Single - "), F.element_at(distinct, 1).cast("string"))
    return (F.when(event_count == 1, F.lit(fv.ONE_OFF))
            .when(F.size(distinct) == 1, single)
            .otherwise(F.lit(fv.MULTIPLE)))


def person_summary(parts: DataFrame, days: int = fv.RETURN_WINDOW_DAYS) -> DataFrame:
    """One row per person: ordered history, repeat lag and cross-series status.

    ``history`` lists each event once with its number of visits, so it is never
    longer than the event table. A second visit on the first date counts as the
    second date.
    """
    dated = parts.select("person_id", "event_id", "series_id",
                         F.to_date("event_date").alias("event_date"))
    visit = F.struct("event_date", "event_id", "series_id", "visits")
    people = attendance(dated, "event_date", "series_id").groupBy("person_id").agg(
        F.sum("visits").alias("event_count"), F.sort_array(F.collect_list(visit)).alias("history"))
    first = F.col("history")[0]
    second = F.when(first["visits"] > 1, first["event_date"]).otherwise(
        F.get("history", F.lit(1))["event_date"])
    return people.withColumns({
        "first_date": first["event_date"],
        "repeat_lag": repeat_lag(F.col("event_count"), first["event_date"], second, days),
        "cross_series": cross_series_status(F.col("event_count"), F.col("history.series_id")),
    })


def person_history_lists(parts: DataFrame) -> DataFrame:
    """Per person lists of event ids, dates, series and visits, by date then event."""
    return person_summary(parts).select(
        "person_id", "event_count",
        F.col("history.event_id").alias("event_ids"),
        F.col("history.event_date").alias("event_dates"),
        F.col("history.series_id").alias("series_ids"),
        F.col("history.visits").alias("visits"))


def repeat_report(people: DataFrame) -> DataFrame:
    """Percent repeat, and of the repeaters percent in one series and in several."""
    single = F.count_if(F.col("cross_series").startswith("Single"))
    multiple = F.count_if(F.col("cross_series") == fv.MULTIPLE)
    repeats = F.count_if(F.col("event_count") > 1)
    return people.agg(
        F.count(F.lit(1)).alias("people"), repeats.alias("repeats"),
        single.alias("single_series"), multiple.alias("multi_series"),
        F.count_if(F.col("cross_series") == fv.ONE_OFF).alias("one_off"),
        F.round(F.try_divide(single + multiple, F.count(F.lit(1))) * 100).alias("pct_repeat"),
        F.round(F.try_divide(single, repeats) * 100).alias("pct_single"),
        F.round(F.try_divide(multiple, repeats) * 100).alias("pct_multi"))


def single_series_breakdown(people: DataFrame) -> DataFrame:
    """Of the people repeating in one series only, how many percent per series."""
    single = people.filter(F.col("cross_series").startswith("Single"))
    total = single.agg(F.count(F.lit(1)).alias("n")).scalar()
    return single.groupBy("cross_series").agg(F.count(F.lit(1)).alias("people")).withColumn(
        "pct", F.round(F.col("people") / total * 100))


def visits(people: DataFrame) -> DataFrame:
    """Back to one row per person and event, with the person's status and first-timer flag."""
    flat = people.select("person_id", "first_date", "repeat_lag", "cross_series",
                         F.explode("history").alias("_v"))
    return flat.select(
        "person_id", "_v.*", "repeat_lag", "cross_series",
        (F.col("_v.event_date") == F.col("first_date")).alias("first_timer"))


def _visits_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("visits"))), F.lit(0))


def event_attendee_mix(people: DataFrame) -> DataFrame:
    """Per event: attendees seen in one series, in several, and only once."""
    status = F.col("cross_series")
    return visits(people).groupBy("event_id").agg(
        _visits_if(status.startswith("Single")).alias("repeat_single_series"),
        _visits_if(status == fv.MULTIPLE).alias("repeat_multi_series"),
        _visits_if(status == fv.ONE_OFF).alias("single_attend"))


def event_first_timers(people: DataFrame) -> DataFrame:
    """Per event: first-timers, how many of them returned under and over the window, and their ids.

    The ids come in pages of bounded size, a row per page with the event's figures on each;
    all pages together are the whole list. An event without first-timers has a row without a page.
    """
    first, figures = F.col("first_timer"), ["first_timers", "repeat_under", "repeat_over"]
    pages = cut_lineage(visits(people).groupBy("event_id", F.floor(F.col("person_id") / ROSTER_RANGE).alias("page")).agg(
        _visits_if(first).alias("first_timers"),
        _visits_if(first & (F.col("repeat_lag") == UNDER)).alias("repeat_under"),
        _visits_if(first & (F.col("repeat_lag") == OVER)).alias("repeat_over"),
        F.count_if(first).alias("n_people"),
        F.sort_array(F.collect_list(F.when(first, F.col("person_id")))).alias("person_ids")))
    events = pages.groupBy("event_id").agg(*[F.sum(c).alias(c) for c in figures])
    return null_safe_join(events, pages.filter("n_people > 0").drop(*figures), ["event_id"], "left")


def first_timer_roster(people: DataFrame) -> DataFrame:
    """Ids of the first-timers of each event, in pages of bounded size."""
    return paged_roster(visits(people).filter("first_timer"))


def event_summary(people: DataFrame) -> DataFrame:
    """One row per event with size, attendee mix, first-timers and return rates."""
    first, status, lag = F.col("first_timer"), F.col("cross_series"), F.col("repeat_lag")
    events = visits(people).groupBy("event_id").agg(
        F.min("event_date").alias("event_date"), F.min("series_id").alias("series_id"),
        F.sum("visits").alias("total_part_count"),
        _visits_if(status.startswith("Single")).alias("repeat_single_series"),
        _visits_if(status == fv.MULTIPLE).alias("repeat_multi_series"),
        _visits_if(status == fv.ONE_OFF).alias("single_attend"),
        _visits_if(first).alias("first_timers"),
        _visits_if(first & (lag == UNDER)).alias("repeat_under"),
        _visits_if(first & (lag == OVER)).alias("repeat_over"))
    return event_return_rates(events)


def event_return_rates(events: DataFrame) -> DataFrame:
    """Adds whole percents of first-timers who returned, cut not rounded; NULL without any."""
    def percent(column: str) -> Column:
        return F.try_divide(F.col(column) * 100, F.col("first_timers")).cast("int")

    return events.withColumns(
        {"pct_under": percent("repeat_under"), "pct_over": percent("repeat_over")})


def normalised_return_rate(events: DataFrame) -> DataFrame:
    """Adds the return rate scaled by the share of first-timers at the event."""
    scaled = F.try_divide(F.col("pct_under") * F.col("first_timers"), F.col("total_part_count"))
    return events.withColumn("normalised_under", scaled)


def first_timer_waterline(events: DataFrame, n: int = 80, level: float = 30.0) -> DataFrame:
    """Share of first-timers over the first n events by date, times ``level``."""
    early = running_position(events, "event_date", ["event_id"]).filter(F.col("position") <= n)
    return early.agg((F.try_divide(F.sum("first_timers"), F.sum("total_part_count"))
                      * level).alias("waterline"))


def _last_observed(events: DataFrame, days: int) -> DataFrame:
    """One row: the last date at least ``days`` before the latest, and its first event."""
    limit = events.agg(F.date_sub(F.max("event_date"), days).alias("limit")).scalar()
    key = F.struct(F.col("event_date").alias("d"), (-F.col("event_id")).alias("e"))
    last = events.filter(F.col("event_date") <= limit).agg(F.max(key).alias("_k"))
    return last.select(F.col("_k.d").alias("last_date"), (-F.col("_k.e")).alias("last_event"))


def observed(events: DataFrame, days: int = fv.RETURN_WINDOW_DAYS) -> DataFrame:
    """Events up to the first event on the last date with a full window after it."""
    last = _last_observed(events, days)
    date, event = last.select("last_date").scalar(), last.select("last_event").scalar()
    return events.filter((F.col("event_date") < date)
                         | ((F.col("event_date") == date) & (F.col("event_id") == event)))


def observation_cutoff(events: DataFrame, days: int = fv.RETURN_WINDOW_DAYS) -> DataFrame:
    """How many events, by date, have a full window after them."""
    return observed(events, days).agg(F.count(F.lit(1)).alias("max_index"))


def _rate(timeframe: str) -> Column:
    rates = {"under": F.col("pct_under"), "over": F.col("pct_over"),
             "all": F.col("pct_under") + F.col("pct_over")}
    if timeframe not in rates:
        raise ValueError("timeframe must be 'under', 'over' or 'all'")
    return rates[timeframe]


def return_series(events: DataFrame, timeframe: str) -> DataFrame:
    """Return rate by date for 'under', 'over' or 'all', as far as it is observed."""
    return observed(events).select(
        "event_id", "event_date", F.lit(timeframe).alias("timeframe"), _rate(timeframe).alias("pct"))


def events_of_interest(events: DataFrame, timeframe: str, waterline: int,
                       compat: bool = False) -> DataFrame:
    """Events with a return rate above the waterline, with the series label.

    ``compat`` keeps the older order of steps: threshold first, then as many of the
    remaining events as the cut-off counts.
    """
    above = _rate(timeframe) > waterline
    if compat:
        cutoff = observation_cutoff(events).scalar()
        found = running_position(events.filter(above), "event_date", ["event_id"]).filter(
            F.col("position") <= cutoff)
    else:
        found = observed(events).filter(above)
    return found.select("event_id", "event_date", decode_series(F.col("series_id")).alias("series"),
                        _rate(timeframe).alias("pct"))


def most_first_timers(events: DataFrame) -> Column:
    """The event with the most first-timers, the earliest id on a tie."""
    best = F.max_by("event_id", F.struct("first_timers", -F.col("event_id")))
    return events.agg(best.alias("event_id")).scalar()


def first_repeat_spread(people: DataFrame, events: DataFrame, origin: Column) -> DataFrame:
    """At which later event the first-timers of one event were seen next.

    One row per later event; NULL where nobody returned first. The next event stands
    right after the origin in a person's ordered history.
    """
    place = F.array_position(F.col("history.event_id"), origin).cast("int")
    placed = people.withColumn("_place", place).filter("_place > 0")
    starters = placed.filter(
        F.get("history", F.col("_place") - 1)["event_date"] == F.col("first_date"))
    following = starters.select(F.get("history", F.col("_place"))["event_id"].alias("event_id"))
    repeats = following.filter("event_id IS NOT NULL").groupBy("event_id").agg(
        F.count(F.lit(1)).alias("_n"))
    start = events.filter(F.col("event_id") == origin).select("event_date").scalar()
    later = events.filter((F.col("event_date") > start)
                          | ((F.col("event_date") == start) & (F.col("event_id") > origin)))
    return later.select("event_id", "event_date", "series_id").join(
        repeats, "event_id", "left").withColumn(
        "repeats", zero_to_null(F.coalesce("_n", F.lit(0)))).drop("_n")
