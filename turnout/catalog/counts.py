"""Counts, sizes, retention figures."""

from __future__ import annotations


from turnout.catalog import views as v
from turnout.catalog.registry import ids_text, query, six, six_all
from turnout.operators import attendance, profile, retention
from turnout.operators.grid import participation_grid

PAGE = attendance.ROSTER_RANGE


def sparse_people(spark, sf_dir):
    return retention.person_summary(v.sparse_participations(spark, sf_dir))


def sparse_events(spark, sf_dir):
    return retention.event_summary(sparse_people(spark, sf_dir))


@query("person_counts", f"WITH {v.P} SELECT person_id, count(event_id) AS event_count FROM p GROUP BY person_id")
def person_counts(spark, sf_dir):
    return attendance.person_counts(v.participations(spark, sf_dir))


@query("event_counts", f"WITH {v.P} SELECT event_id, count(person_id) AS total_part_count FROM p GROUP BY event_id")
def event_counts(spark, sf_dir):
    return attendance.event_counts(v.participations(spark, sf_dir))


@query("person_history_lists", f"""WITH {v.S}
SELECT person_id, count(*) AS event_count, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_date, event_id) AS event_ids,
  string_agg(strftime(event_date, '%Y-%m-%d'), ',' ORDER BY event_date, event_id) AS event_dates,
  string_agg(CAST(series_id AS VARCHAR), ',' ORDER BY event_date, event_id) AS series_ids FROM s GROUP BY person_id""")
def person_history_lists(spark, sf_dir):
    lists = retention.person_history_lists(v.sparse_participations(spark, sf_dir))
    return lists.select("person_id", "event_count", *[
        ids_text(c).alias(c) for c in ("event_ids", "event_dates", "series_ids")])


@query("event_attributes", f"WITH {v.EV} SELECT * FROM ev")
def event_attributes(spark, sf_dir):
    return attendance.event_attributes(v.participations(spark, sf_dir))


@query("event_roster", f"""WITH {v.P}
SELECT event_id, CAST(floor(person_id / {PAGE}) AS BIGINT) AS page, min(event_date) AS event_date, min(series_id) AS series_id,
  count(*) AS n_people, string_agg(CAST(person_id AS VARCHAR), ',' ORDER BY person_id) AS person_ids
FROM p GROUP BY event_id, CAST(floor(person_id / {PAGE}) AS BIGINT)""")
def event_roster(spark, sf_dir):
    pages = attendance.event_roster(v.participations(spark, sf_dir), "event_date", "series_id")
    return pages.withColumn("person_ids", ids_text("person_ids"))


@query("dataset_summary", f"""WITH {v.P}, c AS (SELECT count(DISTINCT person_id) AS people, count(DISTINCT event_id) AS events, count(*) AS participations FROM p)
SELECT people, events, participations, CAST(people * events AS BIGINT) AS possible,
  round((1 - CAST(participations AS DOUBLE) / (people * events)) * 100) AS sparsity_pct FROM c""")
def dataset_summary(spark, sf_dir):
    return profile.dataset_summary(v.participations(spark, sf_dir))


@query("group_size_range", f"""WITH {v.P}
SELECT 'event' AS grouped_by, min(n) AS min_size, max(n) AS max_size FROM (SELECT count(person_id) AS n FROM p GROUP BY event_id)
UNION ALL SELECT 'person', min(n), max(n) FROM (SELECT count(event_id) AS n FROM p GROUP BY person_id)""")
def group_size_range(spark, sf_dir):
    return profile.group_size_range(v.participations(spark, sf_dir))


@query("size_histogram", f"""WITH {v.P}, c AS (SELECT count(event_id) AS n FROM p GROUP BY person_id),
b AS (SELECT CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) AS DOUBLE) AS hi FROM c),
f AS (SELECT least(CAST(floor((n - lo) / ((hi - lo) / 20)) AS INT) + 1, 20) AS bucket, count(*) AS n FROM c, b GROUP BY 1)
SELECT CAST(i AS INT) AS bucket, round(lo + (i - 1) * (hi - lo) / 20, 6) AS low, round(lo + i * (hi - lo) / 20, 6) AS high,
  coalesce(f.n, 0) AS n FROM range(1, 21) r(i) CROSS JOIN b LEFT JOIN f ON f.bucket = i""")
def size_histogram(spark, sf_dir):
    sizes = attendance.person_counts(v.participations(spark, sf_dir))
    return six_all(profile.size_histogram(sizes, "event_count"), "low", "high")


@query("share_at_most", f"""WITH {v.S}, c AS (SELECT count(event_id) AS n FROM s GROUP BY person_id)
SELECT CAST(k AS INT) AS k, round(avg(CASE WHEN n <= k THEN 1.0 ELSE 0.0 END), 6) AS share FROM c, (VALUES (1), (5), (10)) t(k) GROUP BY k""")
def share_at_most(spark, sf_dir):
    sizes = attendance.person_counts(v.sparse_participations(spark, sf_dir))
    return six_all(profile.share_at_most(sizes, "event_count", [1, 5, 10]), "share")


@query("repeat_report", f"""WITH {v.PERSONS}, c AS (
SELECT count(*) AS people, count(*) FILTER (WHERE event_count > 1) AS repeats,
  count(*) FILTER (WHERE starts_with(cross_series, 'Single')) AS single_series,
  count(*) FILTER (WHERE cross_series = 'Multiple') AS multi_series,
  count(*) FILTER (WHERE cross_series = 'One Off') AS one_off FROM people)
SELECT *, round(CAST(single_series + multi_series AS DOUBLE) / people * 100) AS pct_repeat,
  round(CAST(single_series AS DOUBLE) / repeats * 100) AS pct_single, round(CAST(multi_series AS DOUBLE) / repeats * 100) AS pct_multi FROM c""")
def repeat_report(spark, sf_dir):
    return retention.repeat_report(sparse_people(spark, sf_dir))


@query("single_series_breakdown", f"""WITH {v.PERSONS}
SELECT cross_series, count(*) AS people, round(count(*) * 100.0 / (SELECT count(*) FROM people WHERE starts_with(cross_series, 'Single'))) AS pct
FROM people WHERE starts_with(cross_series, 'Single') GROUP BY cross_series""")
def single_series_breakdown(spark, sf_dir):
    return retention.single_series_breakdown(sparse_people(spark, sf_dir))


@query("event_attendee_mix", f"WITH {v.EVENTS} SELECT event_id, repeat_single_series, repeat_multi_series, single_attend FROM es")
def event_attendee_mix(spark, sf_dir):
    return retention.event_attendee_mix(sparse_people(spark, sf_dir))


_ROSTER = f"""SELECT event_id, CAST(floor(person_id / {PAGE}) AS BIGINT) AS page, count(*) AS n_people,
  string_agg(CAST(person_id AS VARCHAR), ',' ORDER BY person_id) AS person_ids
FROM v WHERE ft GROUP BY event_id, CAST(floor(person_id / {PAGE}) AS BIGINT)"""


@query("event_first_timers", f"""WITH {v.EVENTS}
SELECT es.event_id, first_timers, repeat_under, repeat_over, page, n_people, person_ids
FROM es LEFT JOIN ({_ROSTER}) r ON es.event_id IS NOT DISTINCT FROM r.event_id""")
def event_first_timers(spark, sf_dir):
    """Figures of each event and the ids of its first-timers, a row per page of ids."""
    pages = retention.event_first_timers(sparse_people(spark, sf_dir))
    return pages.withColumn("person_ids", ids_text("person_ids"))


@query("first_timer_roster", f"""WITH {v.EVENTS}
SELECT event_id, CAST(floor(person_id / {PAGE}) AS BIGINT) AS page, count(*) AS n_people,
  string_agg(CAST(person_id AS VARCHAR), ',' ORDER BY person_id) AS person_ids
FROM v WHERE ft GROUP BY event_id, CAST(floor(person_id / {PAGE}) AS BIGINT)""")
def first_timer_roster(spark, sf_dir):
    pages = retention.first_timer_roster(sparse_people(spark, sf_dir))
    return pages.withColumn("person_ids", ids_text("person_ids"))


@query("event_summary", f"WITH {v.EVENTS} SELECT * FROM er")
def event_summary(spark, sf_dir):
    return sparse_events(spark, sf_dir)


@query("event_return_rates", f"WITH {v.EVENTS} SELECT event_id, first_timers, pct_under, pct_over FROM er")
def event_return_rates(spark, sf_dir):
    return sparse_events(spark, sf_dir).select("event_id", "first_timers", "pct_under", "pct_over")


@query("normalised_return_rate", f"""WITH {v.EVENTS}
SELECT event_id, round(CAST(pct_under * first_timers AS DOUBLE) / total_part_count, 6) AS normalised_under FROM er""")
def normalised_return_rate(spark, sf_dir):
    rates = retention.normalised_return_rate(sparse_events(spark, sf_dir))
    return rates.select("event_id", six("normalised_under").alias("normalised_under"))


@query("first_timer_waterline", f"""WITH {v.EVENTS}
SELECT round(CAST(sum(first_timers) AS DOUBLE) / sum(total_part_count) * 30, 6) AS waterline
FROM (SELECT * FROM er ORDER BY event_date, event_id LIMIT 80)""")
def first_timer_waterline(spark, sf_dir):
    return six_all(retention.first_timer_waterline(sparse_events(spark, sf_dir), 80, 30.0), "waterline")


@query("max_group_mean", f"""WITH {v.P}
SELECT round(max(fee), 6) AS max_mean_fee, round(max(miles), 6) AS max_mean_miles
FROM (SELECT avg(fee) AS fee, avg(miles) AS miles FROM p GROUP BY event_id)""")
def max_group_mean(spark, sf_dir):
    means = profile.max_group_mean(v.participations(spark, sf_dir), "event_id", ["fee", "miles"])
    return six_all(means, "max_mean_fee", "max_mean_miles")


@query("value_counts", f"WITH {v.D} SELECT payment_method, count(*) AS n FROM d GROUP BY payment_method")
def value_counts(spark, sf_dir):
    return profile.value_counts(v.registrations(spark, sf_dir), "payment_method")


@query("prediction_describe", f"""WITH {v.K}
SELECT participated, count(prediction) AS n, round(avg(prediction), 6) AS mean, round(stddev_samp(prediction), 6) AS std,
  min(prediction) AS min, max(prediction) AS max, round(quantile_cont(prediction, 0.25), 6) AS q25,
  round(quantile_cont(prediction, 0.5), 6) AS q50, round(quantile_cont(prediction, 0.75), 6) AS q75 FROM k GROUP BY participated""")
def prediction_describe(spark, sf_dir):
    cells = v.pseudo_score(participation_grid(v.participations(spark, sf_dir)))
    return six_all(profile.prediction_describe(cells), "mean", "std", "q25", "q50", "q75")


_PROFILED = ["person_id", "age", "gender", "distance", "miles", "time", "total_fee", "ss_prereg",
             "registration_time", "payment_method", "contact", "series_id", "tshirt"]


@query("null_profile", f"WITH {v.D} SELECT count(*) AS n_rows, " + ", ".join(
    f"count({c}) AS {c}" for c in _PROFILED) + " FROM d")
def null_profile(spark, sf_dir):
    return profile.null_profile(v.registrations(spark, sf_dir).select(*_PROFILED))
