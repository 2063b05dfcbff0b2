"""Windows, splits, top lists, metrics and row-wise ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnout.catalog import views as v
from turnout.catalog.counts import PAGE, sparse_events, sparse_people
from turnout.catalog.joins import FIVE_SQL, ITEMS, five_predictions, top_lists
from turnout.catalog.registry import ids_text, query, six, six_all
from turnout.operators import ensemble, evaluate, profile, recommend, retention, split
from turnout.operators.grid import make_grid, participation_grid
from turnout.session import scratch_path
from turnout.sources.tables import snapshot


def scored(spark, sf_dir):
    return v.pseudo_score(participation_grid(v.participations(spark, sf_dir)))


# -- retention windows -----------------------------------------------------

@query("repeat_lag", f"WITH {v.PERSONS} SELECT person_id, event_count, repeat_lag FROM people")
def repeat_lag(spark, sf_dir):
    return sparse_people(spark, sf_dir).select("person_id", "event_count", "repeat_lag")


@query("cross_series_status", f"WITH {v.PERSONS} SELECT person_id, cross_series FROM people")
def cross_series_status(spark, sf_dir):
    return sparse_people(spark, sf_dir).select("person_id", "cross_series")


@query("observation_cutoff", f"WITH {v.EVENTS} SELECT count(*) AS max_index FROM ob")
def observation_cutoff(spark, sf_dir):
    return retention.observation_cutoff(sparse_events(spark, sf_dir))


@query("return_series", f"""WITH {v.EVENTS}
SELECT event_id, event_date, 'under' AS timeframe, pct_under AS pct FROM ob
UNION ALL SELECT event_id, event_date, 'over', pct_over FROM ob
UNION ALL SELECT event_id, event_date, 'all', pct_under + pct_over FROM ob""")
def return_series(spark, sf_dir):
    from turnout.session import cut_lineage

    events = cut_lineage(sparse_events(spark, sf_dir))
    return split.append_parts([retention.return_series(events, t) for t in ("under", "over", "all")])


_DECODED = """CASE series_id WHEN 0 THEN 'No Series' WHEN 1 THEN 'Winter Series' WHEN 2 THEN 'Half Marathon Series'
  WHEN 3 THEN 'Summer Series' WHEN 4 THEN 'Street Scramble' END"""


@query("events_of_interest", f"WITH {v.EVENTS} SELECT event_id, event_date, {_DECODED} AS series, pct_under AS pct FROM ob WHERE pct_under > 40")
def events_of_interest(spark, sf_dir):
    return retention.events_of_interest(sparse_events(spark, sf_dir), "under", 40)


@query("events_of_interest_compat", f"""WITH {v.EVENTS}
SELECT event_id, event_date, {_DECODED} AS series, pct_under + pct_over AS pct FROM (
  SELECT *, row_number() OVER (ORDER BY event_date, event_id) AS rn FROM er WHERE pct_under + pct_over > 40)
WHERE rn <= (SELECT count(*) FROM ob)""")
def events_of_interest_compat(spark, sf_dir):
    return retention.events_of_interest(sparse_events(spark, sf_dir), "all", 40, compat=True)


@query("first_repeat_spread", f"""WITH {v.EVENTS},
o AS (SELECT event_id AS oid, event_date AS odate FROM er ORDER BY first_timers DESC, event_id LIMIT 1),
st AS (SELECT person_id FROM v, o WHERE event_id = oid AND ft),
nx AS (SELECT person_id, event_id FROM (SELECT s.person_id, s.event_id,
  row_number() OVER (PARTITION BY s.person_id ORDER BY s.event_date, s.event_id) AS rn
  FROM s JOIN st ON s.person_id = st.person_id, o WHERE s.event_date > odate OR (s.event_date = odate AND s.event_id > oid)) WHERE rn = 1),
c AS (SELECT event_id, count(*) AS n FROM nx GROUP BY event_id)
SELECT er.event_id, er.event_date, er.series_id, c.n AS repeats FROM er LEFT JOIN c ON er.event_id = c.event_id, o
WHERE er.event_date > odate OR (er.event_date = odate AND er.event_id > oid)""")
def first_repeat_spread(spark, sf_dir):
    from turnout.session import cut_lineage

    people = sparse_people(spark, sf_dir)
    events = cut_lineage(retention.event_summary(people))
    return retention.first_repeat_spread(people, events, retention.most_first_timers(events))


# -- splits ----------------------------------------------------------------

@query("temporal_split", f"WITH {v.SPLIT_G} SELECT person_id, event_id, participated, split FROM gs")
def temporal_split(spark, sf_dir):
    cells = split.split_cells(make_grid(v.participations(spark, sf_dir)))
    return cells.select("person_id", "event_id", "participated", "split")


@query("temporal_split_participations", f"WITH {v.SPLIT_P} SELECT person_id, event_id, split FROM ps")
def temporal_split_participations(spark, sf_dir):
    return split.split_rows(v.participations(spark, sf_dir)).select("person_id", "event_id", "split")


@query("temporal_split_by_series", f"""WITH {v.G},
gp AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY event_date, event_id, person_id) AS pos,
  count(*) OVER (PARTITION BY series_id) AS n FROM g)
SELECT person_id, event_id, series_id, CASE WHEN pos > round(n*0.8) THEN 'test' WHEN pos > round(round(n*0.8)*0.8) THEN 'validate' ELSE 'train' END AS split FROM gp""")
def temporal_split_by_series(spark, sf_dir):
    cells = split.split_cells(make_grid(v.participations(spark, sf_dir)), by="series_id")
    return cells.select("person_id", "event_id", "series_id", "split")


@query("ordered_cut", f"""WITH {v.K}, o AS (SELECT *, row_number() OVER (ORDER BY event_date, event_id, person_id) AS pos, count(*) OVER () AS n FROM k)
SELECT person_id, event_id, prediction, CASE WHEN pos > round(n*0.8) THEN 'validate' ELSE 'train' END AS split FROM o""")
def ordered_cut(spark, sf_dir):
    rows = scored(spark, sf_dir).select("person_id", "event_id", "event_date", "prediction")
    return split.ordered_cut(rows).select("person_id", "event_id", "prediction", "split")


@query("append_parts", f"WITH {v.P} SELECT person_id, event_id, series_id FROM p")
def append_parts(spark, sf_dir):
    """The splits of the participations, stored once, put together again."""
    rows = split.split_rows(v.participations(spark, sf_dir).select(
        "person_id", "event_id", "event_date", "series_id"))
    parts = snapshot(rows, scratch_path(spark, "splits"))
    wanted = ["person_id", "event_id", "series_id"]
    return split.append_parts([
        parts.filter(F.col("split") == s).select(*wanted) for s in ("train", "validate", "test")])


def _overlap_sql(key):
    return f"""SELECT '{key}' AS key, count(*) FILTER (WHERE a) AS in_train, count(*) FILTER (WHERE b) AS in_validate, count(*) FILTER (WHERE c) AS in_test,
  count(*) FILTER (WHERE a AND b) AS in_train_and_validate, count(*) FILTER (WHERE a AND c) AS in_train_and_test
FROM (SELECT {key}, bool_or(split = 'train') AS a, bool_or(split = 'validate') AS b, bool_or(split = 'test') AS c FROM ps GROUP BY {key})"""


@query("split_overlap_report", f"WITH {v.SPLIT_P} {_overlap_sql('person_id')} UNION ALL {_overlap_sql('event_id')} UNION ALL {_overlap_sql('venue_zip')}")
def split_overlap_report(spark, sf_dir):
    rows = split.split_rows(v.participations(spark, sf_dir))
    return split.split_overlap_report(rows, ["person_id", "event_id", "venue_zip"])


@query("cold_start_report", f"""WITH {v.SPLIT_P}
SELECT count(DISTINCT person_id) AS cold_keys, count(*) AS cold_rows FROM ps
WHERE split = 'validate' AND person_id NOT IN (SELECT person_id FROM ps WHERE split = 'train')""")
def cold_start_report(spark, sf_dir):
    return split.cold_start_report(split.split_rows(v.participations(spark, sf_dir)), "person_id")


# -- top lists -------------------------------------------------------------

@query("top_k_per_person", f"WITH {v.TOP5} SELECT * FROM top")
def top_k_per_person(spark, sf_dir):
    return top_lists(spark, sf_dir)


@query("top_event_counts", f"WITH {v.TOP5} SELECT event_id, count(*) AS top_count FROM top GROUP BY event_id")
def top_event_counts(spark, sf_dir):
    return recommend.top_event_counts(top_lists(spark, sf_dir))


@query("likely_audience", f"""WITH {v.TOP5}
SELECT event_id, CAST(floor(person_id / {PAGE}) AS BIGINT) AS page, count(*) AS n_people,
  string_agg(CAST(person_id AS VARCHAR), ',' ORDER BY person_id) AS person_ids FROM top GROUP BY event_id, CAST(floor(person_id / {PAGE}) AS BIGINT)""")
def likely_audience(spark, sf_dir):
    pages = recommend.likely_audience(top_lists(spark, sf_dir))
    return pages.withColumn("person_ids", ids_text("person_ids"))


@query("top_events_snapshot", f"""WITH {v.TOP5},
c AS (SELECT event_id, count(*) AS top_count FROM top GROUP BY event_id),
a AS (SELECT event_id, min(event_type_id) AS event_type_id, min(series_id) AS series_id, count(*) AS attendance FROM p GROUP BY event_id)
SELECT c.event_id, c.top_count, a.event_type_id, a.series_id, a.attendance FROM c JOIN a ON c.event_id = a.event_id
ORDER BY top_count DESC, c.event_id LIMIT 10""")
def top_events_snapshot(spark, sf_dir):
    return recommend.top_events_snapshot(
        top_lists(spark, sf_dir), v.participations(spark, sf_dir), ["event_type_id", "series_id"])


# -- metrics ---------------------------------------------------------------

POPULARITY_SQL = """
SELECT event_id, attendance, (row_number() OVER (ORDER BY attendance DESC, event_id) - 1) * 100.0 / count(*) OVER () AS rank_ui
FROM (SELECT event_id, CAST(sum(participated) AS BIGINT) AS attendance FROM k GROUP BY event_id HAVING sum(participated) > 0)"""


@query("popularity_rank", f"""WITH {v.K}, pop AS ({POPULARITY_SQL}) SELECT event_id, attendance, round(rank_ui, 6) AS rank_ui FROM pop""")
def popularity_rank(spark, sf_dir):
    return six_all(evaluate.popularity_rank(scored(spark, sf_dir), "event_id"), "rank_ui")


@query("user_rank_ui", f"""WITH {v.K}, m AS (SELECT *, max(prediction) OVER (PARTITION BY person_id) AS best FROM k)
SELECT person_id, event_id, round(CASE WHEN best > 0 THEN (1 - prediction / best) * 100 ELSE 0 END, 6) AS rank_ui FROM m""")
def user_rank_ui(spark, sf_dir):
    ranked = evaluate.user_rank_ui(scored(spark, sf_dir))
    return ranked.select("person_id", "event_id", six("rank_ui").alias("rank_ui"))


_RANK_UI = "m AS (SELECT *, max(prediction) OVER (PARTITION BY person_id) AS best FROM k), r AS (SELECT *, CASE WHEN best > 0 THEN (1 - prediction / best) * 100 ELSE 0 END AS rank_ui FROM m)"


@query("rank_bar", f"WITH {v.K}, {_RANK_UI} SELECT round(sum(participated * rank_ui) / sum(participated), 6) AS rank_bar FROM r")
def rank_bar(spark, sf_dir):
    return six_all(evaluate.rank_bar(scored(spark, sf_dir)), "rank_bar")


@query("percentile_rank_bar", f"""WITH {v.K},
r AS (SELECT *, percent_rank() OVER (PARTITION BY person_id ORDER BY prediction DESC) * 100 AS pr FROM k)
SELECT round(sum(participated * pr) / sum(participated), 6) AS percentile_rank_bar FROM r""")
def percentile_rank_bar(spark, sf_dir):
    return six_all(evaluate.percentile_rank_bar(scored(spark, sf_dir)), "percentile_rank_bar")


@query("rank_detail", f"""WITH {v.K}, {_RANK_UI}
SELECT person_id, count(*) AS n_rows, max(prediction) AS max_prediction, round(sum(participated * rank_ui), 6) AS weighted_rank,
  CAST(sum(participated) AS BIGINT) AS attended FROM r GROUP BY person_id""")
def rank_detail(spark, sf_dir):
    return six_all(evaluate.rank_detail(scored(spark, sf_dir)), "weighted_rank")


@query("popularity_rank_bar", f"""WITH {v.K}, pop AS ({POPULARITY_SQL})
SELECT round(sum(k.participated * pop.rank_ui) / sum(k.participated), 6) AS popularity_rank_bar
FROM k LEFT JOIN pop ON k.event_id = pop.event_id WHERE k.participated = 1""")
def popularity_rank_bar(spark, sf_dir):
    return six_all(evaluate.popularity_rank_bar(scored(spark, sf_dir), "event_id"), "popularity_rank_bar")


def with_gaps(spark, sf_dir):
    """The scored grid without predictions for one venue."""
    return scored(spark, sf_dir).withColumn(
        "prediction", F.when(F.col("venue_zip") != 98003, F.col("prediction")))


_ERRORS = """kk AS (SELECT participated AS y, CASE WHEN venue_zip <> 98003 THEN prediction END AS p FROM k),
f AS (SELECT y, coalesce(p, (SELECT avg(p) FROM kk)) AS p FROM kk)"""


@query("regression_metrics", f"""WITH {v.K}, {_ERRORS}
SELECT round(sqrt(avg((y-p)*(y-p))), 6) AS rmse, round(avg((y-p)*(y-p)), 6) AS mse,
  round(1 - avg((y-p)*(y-p)) / var_pop(y), 6) AS r2, round(avg(abs(y-p)), 6) AS mae FROM f""")
def regression_metrics(spark, sf_dir):
    return six_all(evaluate.regression_metrics(with_gaps(spark, sf_dir)), "rmse", "mse", "r2", "mae")


@query("r2_score", f"WITH {v.K}, {_ERRORS} SELECT round(1 - avg((y-p)*(y-p)) / var_pop(y), 6) AS r2 FROM f")
def r2_score(spark, sf_dir):
    return six_all(evaluate.r2_score(with_gaps(spark, sf_dir)), "r2")


# -- sets and row-wise expressions -----------------------------------------

@query("distinct_rows", f"WITH {v.P} SELECT DISTINCT series_id, event_type_id, venue_zip FROM p")
def distinct_rows(spark, sf_dir):
    return profile.distinct_rows(
        v.participations(spark, sf_dir).select("series_id", "event_type_id", "venue_zip"))


@query("distinct_by_key", f"""WITH {v.P}
SELECT person_id, event_id, miles FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY event_id) AS rn FROM p) WHERE rn = 1""")
def distinct_by_key(spark, sf_dir):
    parts = v.participations(spark, sf_dir).select("person_id", "event_id", "miles")
    return profile.distinct_rows(parts, ["person_id"], ["event_id"])


@query("frame_diff", f"""WITH {v.P}, {v.S.split(v.LI + ',')[1]}
SELECT coalesce(p.person_id, s.person_id) AS person_id, coalesce(p.event_id, s.event_id) AS event_id, p.miles AS left_value, s.miles AS right_value,
  CASE WHEN s.person_id IS NULL THEN 'only_left' WHEN p.person_id IS NULL THEN 'only_right' ELSE 'changed' END AS difference
FROM p FULL JOIN s ON p.person_id = s.person_id AND p.event_id = s.event_id
WHERE s.person_id IS NULL OR p.person_id IS NULL OR p.miles IS DISTINCT FROM s.miles""")
def frame_diff(spark, sf_dir):
    return profile.frame_diff(
        v.participations(spark, sf_dir), v.sparse_participations(spark, sf_dir),
        ["person_id", "event_id"], "miles")


ALL = [f"{i}_prediction" for i in ITEMS]
SUM_SQL = " + ".join(ALL)


@query("mean_ensemble", f"WITH {FIVE_SQL} SELECT person_id, event_id, participated, round(({SUM_SQL}) / 5, 6) AS prediction FROM five")
def mean_ensemble(spark, sf_dir):
    return six_all(ensemble.mean_ensemble(five_predictions(spark, sf_dir)), "prediction").select(
        "person_id", "event_id", "participated", "prediction")


@query("k_extreme_mean", f"""WITH {FIVE_SQL}, l AS (SELECT *, list_sort([{', '.join(ALL)}]) AS ordered FROM five)
SELECT person_id, event_id, round((ordered[1] + ordered[2]) / 2, 6) AS low_two, round((ordered[4] + ordered[5]) / 2, 6) AS high_two
FROM l WHERE series_id_prediction IS NOT NULL""")
def k_extreme_mean(spark, sf_dir):
    five = five_predictions(spark, sf_dir).filter("series_id_prediction IS NOT NULL")
    low = ensemble.extreme_ensemble(five, ALL).withColumnRenamed("prediction", "low_two")
    both = ensemble.extreme_ensemble(low, ALL, which="largest").withColumnRenamed("prediction", "high_two")
    return six_all(both, "low_two", "high_two").select("person_id", "event_id", "low_two", "high_two")


@query("fill_prediction_mean", f"WITH {FIVE_SQL} SELECT person_id, event_id, participated, event_date, " + ", ".join(
    f"round(coalesce({c}, avg({c}) OVER ()), 6) AS {c}" for c in ALL) + " FROM five")
def fill_prediction_mean(spark, sf_dir):
    return six_all(ensemble.fill_prediction_mean(five_predictions(spark, sf_dir)), *ALL)


@query("hybrid_label", f"WITH {v.K} SELECT person_id, event_id, CASE WHEN participated = 1 THEN 1.0 ELSE prediction END AS y_label FROM k")
def hybrid_label(spark, sf_dir):
    return ensemble.hybrid_labels(scored(spark, sf_dir)).select("person_id", "event_id", "y_label")


_DOMAINS = {"series_id": [0, 1, 2, 3, 4], "event_type_id": [1, 2, 3, 4, 5, 6]}


@query("dummy_columns", f"WITH {v.EV} SELECT event_id, " + ", ".join(
    f"CAST(CASE WHEN {c} = {x} THEN 1 ELSE 0 END AS INT) AS {c}_{x}" for c, d in _DOMAINS.items() for x in d[1:]) + " FROM ev")
def dummy_columns(spark, sf_dir):
    from turnout.operators.attendance import event_attributes

    events = event_attributes(v.participations(spark, sf_dir))
    return ensemble.dummy_columns(
        events.select("event_id", "series_id", "event_type_id"), ["series_id", "event_type_id"])


@query("align_columns", f"""WITH {v.EV}
SELECT event_id, CAST(CASE WHEN series_id = 1 THEN 1 ELSE 0 END AS INT) AS series_id_1,
  CAST(CASE WHEN series_id = 2 THEN 1 ELSE 0 END AS INT) AS series_id_2, 0 AS series_id_9 FROM ev""")
def align_columns(spark, sf_dir):
    """Columns of a later frame brought to those of an earlier one."""
    from turnout.operators.attendance import event_attributes

    events = event_attributes(v.participations(spark, sf_dir)).select("event_id", "series_id")
    coded = ensemble.dummy_columns(events, ["series_id"])
    return ensemble.align_columns(coded, ["event_id", "series_id_1", "series_id_2", "series_id_9"])


_VALUES = ("venue_zip", "event_id", "person_id")


@query("dummy_vectors", f"WITH {v.P}, " + ", ".join(
    f"v_{c} AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS x FROM p))"
    for c in _VALUES) + " " + " UNION ALL ".join(
    f"SELECT person_id, event_id, '{c}' AS feature, CAST(n - 1 AS BIGINT) AS size, CAST(CASE WHEN place > 0 THEN place - 1 END AS BIGINT) AS place"
    f" FROM p JOIN v_{c} ON CAST({c} AS VARCHAR) = x" for c in _VALUES))
def dummy_vectors(spark, sf_dir):
    """Size of each column's sparse vector and where it is set, for columns of any number of values."""
    parts = v.participations(spark, sf_dir)
    keys = parts.withColumns({"_p": F.col("person_id"), "_e": F.col("event_id")}).select("_p", "_e", *_VALUES)
    rows = ensemble.dummy_vectors(keys, ensemble.vocabulary(parts, list(_VALUES)))
    read = [F.struct(F.lit(c).alias("feature"), ensemble.vector_size(f"{c}_dummies").alias("size"),
                     ensemble.vector_place(f"{c}_dummies").alias("place")) for c in _VALUES]
    return rows.select(F.col("_p").alias("person_id"), F.col("_e").alias("event_id"), F.inline(F.array(*read)))
