import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from turnout.operators import retention as rt
from turnout.plans.attendance_report import attendance_report

DAY = dt.date(2016, 1, 1)
SCHEMA = "person_id long, event_id long, event_date date, series_id int"


def frame(spark, visits, series=None):
    """visits: person -> list of (event, day offset)."""
    rows = [(p, e, DAY + dt.timedelta(days=d), (series or {}).get(e, 0))
            for p, events in visits.items() for e, d in events]
    return spark.createDataFrame(rows, SCHEMA)


def test_lag_boundary_and_status(spark):
    visits = {1: [(1, 0)], 2: [(1, 0), (2, 182)], 3: [(1, 0), (3, 183)], 4: [(1, 0), (4, 184)],
              5: [(1, 0), (1, 0)], 6: [(3, 183), (1, 0), (2, 182)]}
    people = {r.person_id: r for r in rt.person_summary(frame(spark, visits, {2: 2, 3: 0})).collect()}
    lags = {p: r.repeat_lag for p, r in people.items()}
    assert lags == {1: "One Off", 2: "Under 183 days", 3: "Over 183 days", 4: "Over 183 days",
                    5: "Under 183 days", 6: "Under 183 days"}
    assert {p: r.cross_series for p, r in people.items()} == {
        1: "One Off", 2: "Multiple", 3: "Single - 0", 4: "Single - 0", 5: "Single - 0", 6: "Multiple"}
    assert people[5].event_count == 2 and len(people[5].history) == 1
    report = rt.repeat_report(rt.person_summary(frame(spark, visits, {2: 2, 3: 0}))).first()
    assert (report.pct_repeat, report.pct_single, report.pct_multi) == (83, 60, 40)


def test_two_events_on_the_first_date_and_an_event_without_first_timers(spark):
    visits = {1: [(1, 0), (2, 0), (3, 300)], 2: [(2, 0), (3, 300)], 3: [(1, 0)]}
    people = rt.person_summary(frame(spark, visits))
    events = {r.event_id: r for r in rt.event_summary(people).collect()}
    assert (events[1].first_timers, events[2].first_timers, events[3].first_timers) == (2, 2, 0)
    assert (events[1].pct_under, events[1].pct_over) == (50, 0)
    assert (events[2].pct_under, events[2].pct_over) == (50, 50)
    assert events[3].pct_under is None
    roster = {r.event_id: r.person_ids for r in rt.first_timer_roster(people).collect()}
    assert roster == {1: [1, 3], 2: [1, 2]}


def test_percent_is_cut_not_rounded(spark):
    visits = {p: [(1, 0)] for p in range(2)} | {9: [(1, 0), (2, 10)]}
    assert rt.event_summary(rt.person_summary(frame(spark, visits))).filter("event_id = 1").first().pct_under == 33


def test_cutoff_takes_the_first_event_of_the_last_observed_date(spark):
    visits = {1: [(1, 0), (2, 100), (3, 100), (4, 150), (5, 283)]}
    people = rt.person_summary(frame(spark, visits))
    events = rt.event_summary(people)
    assert rt.observation_cutoff(events).first()[0] == 2
    assert sorted(r.event_id for r in rt.observed(events).collect()) == [1, 2]
    assert rt.first_timer_waterline(events, n=2, level=30).first()[0] == pytest.approx(15)
    above = [r.event_id for r in rt.events_of_interest(events, "under", 50).collect()]
    assert above == [1]
    with pytest.raises(ValueError):
        rt.return_series(events, "never")
    early = rt.event_summary(rt.person_summary(frame(spark, {1: [(1, 0), (2, 5)]})))
    assert rt.observation_cutoff(early).first()[0] == 0


def brute_spread(rows, origin):
    """Walk the later events in order and count first-timers not yet seen."""
    dates = {e: d for _, e, d, _ in rows}
    order = sorted(dates, key=lambda e: (dates[e], e))
    first = {}
    for p, _, d, _ in rows:
        first[p] = min(d, first.get(p, d))
    open_people = {p for p, e, d, _ in rows if e == origin and first[p] == d}
    found = {}
    for event in order[order.index(origin) + 1:]:
        back = {p for p, e, _, _ in rows if e == event} & open_people
        found[event] = len(back) or None
        open_people -= back
    return found


def test_first_repeat_spread(spark):
    pick = random.Random(7)
    visits = {p: [(e, e // 2 * 20) for e in pick.sample(range(9), pick.randint(1, 4))] for p in range(60)}
    parts = frame(spark, visits)
    rows = [tuple(r) for r in parts.collect()]
    people = rt.person_summary(parts)
    events = rt.event_summary(people)
    for origin in (0, 3):
        found = {r.event_id: r.repeats for r in rt.first_repeat_spread(people, events, F.lit(origin).cast("long")).collect()}
        assert found == brute_spread(rows, origin)


def test_report_runs_in_one_call(spark):
    visits = {p: [(1, 0), (2, 30 + p)] for p in range(3)} | {7: [(3, 400)]}
    report = attendance_report(frame(spark, visits), waterline=10)
    assert report["events_of_interest"].count() == 1 and report["cutoff"].first()[0] >= 1


def test_first_timers_of_an_event_come_with_their_ids(spark):
    visits = {1: [(1, 0), (2, 0), (3, 300)], 2: [(2, 0), (3, 300)], 3: [(1, 0)], 25_000: [(1, 0), (1, 0)], 25_001: [(1, 9), (2, 0)]}
    rows = rt.event_first_timers(rt.person_summary(frame(spark, visits))).collect()
    found = {(r.event_id, r.page): (r.first_timers, r.repeat_under, r.repeat_over, r.n_people, r.person_ids) for r in rows}
    assert len(found) == len(rows) and found == {
        (1, 0): (4, 3, 0, 2, [1, 3]), (1, 2): (4, 3, 0, 1, [25_000]),
        (2, 0): (3, 2, 1, 2, [1, 2]), (2, 2): (3, 2, 1, 1, [25_001]), (3, None): (0, 0, 0, None, None)}
    # an event without an id keeps its figures and its people
    unknown = frame(spark, {7: [(None, 0)]})
    only = rt.event_first_timers(rt.person_summary(unknown)).collect()
    assert [tuple(r) for r in only] == [(None, 1, 0, 0, 0, 1, [7])]
