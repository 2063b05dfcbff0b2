"""Joins of source tables, lookups, the grid and merged predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnout import fixed_values as fv
from turnout.catalog import views as v
from turnout.catalog.registry import query, six_all
from turnout.operators import ensemble, grid, joins, profile, recommend
from turnout.operators.attendance import user_attributes
from turnout.operators.grid import als_matrix, participation_grid
from turnout.schemas import PARTICIPATION


# -- stand-ins for the source tables ---------------------------------------

def source_tables(spark, sf_dir):
    lines, orders = v.table(spark, sf_dir, "lineitem"), v.table(spark, sf_dir, "orders")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    text = {name: flag for name in ("payment_method", "street_address", "city", "state_province",
                                    "emergency_contact_name", "zip_code", "country")}
    text |= {name: status for name in ("contact", "tshirt", "hoodie")}
    return {
        "person_events": lines.select(
            F.col("l_suppkey").alias("person_id"), F.col("l_orderkey").alias("event_id"),
            F.concat(flag, F.lit(" Run "), status).alias("distance"),
            F.col("l_linenumber").cast("string").alias("time"), F.col("l_quantity").alias("age"),
            F.col("l_shipdate").alias("registration_time"),
            F.col("l_partkey").cast("string").alias("total_fee"),
            *[c.alias(n) for n, c in text.items()]),
        "events": orders.select(
            F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("event_name"),
            F.col("o_orderdate").alias("event_date"), (F.col("o_orderstatus") == "F").alias("own_event"),
            (F.col("o_custkey") % 25).cast("int").alias("event_type_id")),
        "series_events": orders.filter("o_orderstatus <> 'P'").select(
            F.col("o_orderkey").alias("event_id"),
            (F.col("o_orderkey") % 6).cast("int").alias("series_id")),
        "distances": lines.select(
            F.concat(F.lower(flag), F.lit(" rUN "), status).alias("distance"),
            F.ascii(flag).cast("double").alias("miles")).filter(status == "F").distinct(),
        "event_types": v.table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("event_type_id"), F.col("n_name").alias("event_type")),
        "persons": v.table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("person_id"),
            F.when(F.col("s_nationkey") < 12, "Male").when(F.col("s_nationkey") < 20, "Female").alias("gender")),
        "series": v.table(spark, sf_dir, "region").select(
            F.col("r_regionkey").alias("series_id"), F.col("r_name").alias("series")),
        "ss_team_people": lines.filter(flag == "R").select(
            F.col("l_suppkey").alias("person_id"), F.col("l_orderkey").alias("event_id")).distinct()
            .withColumns({"prereg": F.lit(True), "how_heard": F.lit("web")}),
    }


SOURCES_SQL = """
person_events AS (SELECT l_suppkey AS person_id, l_orderkey AS event_id,
  l_returnflag || ' Run ' || l_linestatus AS distance, CAST(l_linenumber AS VARCHAR) AS time, l_quantity AS age,
  l_shipdate AS registration_time, CAST(l_partkey AS VARCHAR) AS total_fee,
  l_returnflag AS payment_method, l_returnflag AS street_address, l_returnflag AS city, l_returnflag AS state_province,
  l_returnflag AS emergency_contact_name, l_returnflag AS zip_code, l_returnflag AS country,
  l_linestatus AS contact, l_linestatus AS tshirt, l_linestatus AS hoodie FROM lineitem),
ev_t AS (SELECT o_orderkey AS event_id, o_orderpriority AS event_name, o_orderdate AS event_date,
  o_orderstatus = 'F' AS own_event, CAST(o_custkey % 25 AS INT) AS event_type_id FROM orders),
series_events AS (SELECT o_orderkey AS event_id, CAST(o_orderkey % 6 AS INT) AS series_id FROM orders WHERE o_orderstatus <> 'P'),
distances AS (SELECT DISTINCT lower(l_returnflag) || ' rUN ' || l_linestatus AS distance, CAST(ascii(l_returnflag) AS DOUBLE) AS miles
  FROM lineitem WHERE l_linestatus = 'F'),
event_types AS (SELECT n_nationkey AS event_type_id, n_name AS event_type FROM nation),
persons AS (SELECT s_suppkey AS person_id, CASE WHEN s_nationkey < 12 THEN 'Male' WHEN s_nationkey < 20 THEN 'Female' END AS gender FROM supplier),
series_t AS (SELECT r_regionkey AS series_id, r_name AS series FROM region),
team AS (SELECT DISTINCT l_suppkey AS person_id, l_orderkey AS event_id, TRUE AS prereg, 'web' AS how_heard FROM lineitem WHERE l_returnflag = 'R')"""

_FROM_PE = {"person_id", "event_id", "age", "distance", "time", "total_fee", "registration_time", "payment_method",
            "street_address", "city", "state_province", "zip_code", "country", "emergency_contact_name", "contact",
            "tshirt", "hoodie"}
_FROM = {"event_name": "e", "event_date": "e", "own_event": "e", "event_type_id": "e", "miles": "ds", "gender": "pr",
         "event_type": "et", "series_id": "se", "series": "sr", "how_heard": "tm"}
_MASTER_COLUMNS = ", ".join(
    "tm.prereg AS ss_prereg" if c == "ss_prereg" else f"{'pe' if c in _FROM_PE else _FROM[c]}.{c}"
    for c in PARTICIPATION.names)


@query("master_join", f"""WITH {SOURCES_SQL}
SELECT {_MASTER_COLUMNS} FROM person_events pe
LEFT JOIN ev_t e ON pe.event_id = e.event_id LEFT JOIN series_events se ON pe.event_id = se.event_id
LEFT JOIN distances ds ON lower(pe.distance) = lower(ds.distance)
LEFT JOIN event_types et ON e.event_type_id = et.event_type_id LEFT JOIN persons pr ON pr.person_id = pe.person_id
LEFT JOIN team tm ON pe.person_id = tm.person_id AND pe.event_id = tm.event_id
LEFT JOIN series_t sr ON se.series_id = sr.series_id""")
def master_join(spark, sf_dir):
    return joins.master_join(source_tables(spark, sf_dir))


@query("ci_key_join", f"""WITH {SOURCES_SQL}
SELECT pe.person_id, pe.event_id, pe.distance, ds.miles FROM person_events pe
LEFT JOIN distances ds ON lower(pe.distance) = lower(ds.distance)""")
def ci_key_join(spark, sf_dir):
    t = source_tables(spark, sf_dir)
    return joins.ci_key_join(t["person_events"].select("person_id", "event_id", "distance"),
                             t["distances"], "distance")


@query("composite_key_join", f"""WITH {SOURCES_SQL}
SELECT pe.person_id, pe.event_id, pe.time, tm.prereg, tm.how_heard FROM person_events pe
LEFT JOIN team tm ON pe.person_id = tm.person_id AND pe.event_id = tm.event_id""")
def composite_key_join(spark, sf_dir):
    t = source_tables(spark, sf_dir)
    return joins.composite_key_join(t["person_events"].select("person_id", "event_id", "time"),
                                    t["ss_team_people"], ["person_id", "event_id"])


@query("override_lookup", f"""WITH {v.D},
lk AS (SELECT DISTINCT event_id, CAST(t AS INT) AS new_id FROM (SELECT event_id, event_id % 1000 AS t FROM d) WHERE t < 4)
SELECT d.person_id, d.order_id, d.line_no, d.event_id, CASE WHEN lk.event_id IS NOT NULL THEN lk.new_id ELSE d.series_id END AS series_id
FROM d LEFT JOIN lk ON d.event_id = lk.event_id""")
def override_lookup(spark, sf_dir):
    d = v.registrations(spark, sf_dir)
    number = F.col("event_id") % 1000
    listed = d.filter(number < 4).select("event_id", number.cast("int").alias("series_id")).distinct()
    return joins.override_lookup(
        d.select("person_id", "order_id", "line_no", "event_id", "series_id"), listed, "event_id", "series_id")


@query("strict_lookup", f"""WITH {v.D}
SELECT person_id, order_id, line_no, event_id, CAST(98000 + event_id % 9 AS INT) AS venue_zip FROM d""")
def strict_lookup(spark, sf_dir):
    d = v.registrations(spark, sf_dir)
    zips = d.select("event_id").distinct().withColumn(
        "venue_zip", (98000 + F.col("event_id") % 9).cast("int"))
    return joins.strict_lookup(
        d.select("person_id", "order_id", "line_no", "event_id"), zips, "event_id", "venue_zip")


# -- grid ------------------------------------------------------------------

@query("participation_grid", f"WITH {v.G} SELECT * FROM g")
def grid_of_all(spark, sf_dir):
    return participation_grid(v.participations(spark, sf_dir))


@query("implicit_zeros", f"WITH {v.G} SELECT * FROM g WHERE participated = 0")
def implicit_zeros(spark, sf_dir):
    return grid.implicit_zeros(v.participations(spark, sf_dir))


@query("positives_only", f"WITH {v.G} SELECT * FROM g WHERE participated = 1")
def positives_only(spark, sf_dir):
    return grid.positives_only(v.participations(spark, sf_dir))


@query("als_matrix", f"WITH {v.G} SELECT person_id, series_id, participated, event_date FROM g")
def matrix(spark, sf_dir):
    return als_matrix(participation_grid(v.participations(spark, sf_dir)), "series_id")


# -- merged predictions ----------------------------------------------------

ITEMS = list(fv.RECOMMENDER_RANKS)
COLD_ZIP = 98003


def scored_by(cells, item):
    """Pseudo-predictions on an item; the rows of one venue are left out as cold."""
    return v.pseudo_score(cells, "prediction", item).filter(F.col("venue_zip") != COLD_ZIP)


def _score_sql(item):
    return f"CASE WHEN venue_zip <> {COLD_ZIP} THEN CAST((person_id*31 + {item}*17) % 1000 AS DOUBLE)/1000 END"


FIVE_SQL = v.G + ",\nfive AS (SELECT person_id, event_id, participated, event_date, " + ", ".join(
    f"{_score_sql(i)} AS {i}_prediction" for i in ITEMS) + " FROM g)"


def five_predictions(spark, sf_dir):
    cells = participation_grid(v.participations(spark, sf_dir))
    warm = F.col("venue_zip") != COLD_ZIP
    for item in ITEMS:
        score = ((F.col("person_id") * 31 + F.col(item) * 17) % 1000).cast("double") / 1000
        cells = cells.withColumn(f"{item}_prediction", F.when(warm, score))
    return cells.select("person_id", "event_id", "participated", "event_date",
                        *[f"{i}_prediction" for i in ITEMS])


@query("merge_predictions", f"""WITH {v.G}
SELECT person_id, event_id, participated, event_date, event_type_id, total_fee_avg, miles_avg, venue_zip,
  {_score_sql('series_id')} AS series_id_prediction FROM g""")
def merge_predictions(spark, sf_dir):
    cells = participation_grid(v.participations(spark, sf_dir))
    return ensemble.merge_predictions(cells, scored_by(cells, "series_id"), "series_id")


@query("merge_predictions_on_feature", f"""WITH {v.G},
pr AS (SELECT person_id, participated, event_date, series_id, {_score_sql('series_id')} AS prediction FROM g WHERE venue_zip <> {COLD_ZIP})
SELECT g.person_id, g.event_id, g.participated, g.event_date, g.event_type_id, g.total_fee_avg, g.miles_avg, g.venue_zip,
  pr.prediction AS series_id_prediction FROM g LEFT JOIN pr ON g.person_id = pr.person_id
  AND g.participated = pr.participated AND g.event_date = pr.event_date AND g.series_id = pr.series_id""")
def merge_on_feature(spark, sf_dir):
    cells = participation_grid(v.participations(spark, sf_dir))
    return ensemble.merge_predictions(cells, scored_by(cells, "series_id"), "series_id", on_feature=True)


@query("merge_all_predictions", f"WITH {FIVE_SQL} SELECT * FROM five")
def merge_all(spark, sf_dir):
    cells = participation_grid(v.participations(spark, sf_dir))
    return ensemble.merge_all_predictions(cells, {i: scored_by(cells, i) for i in ITEMS})


@query("merge_labels_predictions", f"""WITH {v.G}
SELECT person_id, event_id, participated, event_date, series_id, {_score_sql('series_id')} AS prediction FROM g""")
def merge_labels(spark, sf_dir):
    cells = participation_grid(v.participations(spark, sf_dir))
    kept = cells.select("person_id", "event_id", "participated", "event_date", "series_id")
    return ensemble.merge_labels_predictions(kept, scored_by(cells, "series_id"))


USERS_SQL = """
SELECT person_id, min(gender) AS gender, CAST(round(avg(age)) AS INT) AS age_avg FROM d GROUP BY person_id"""


@query("user_attributes", f"WITH {v.D} {USERS_SQL}")
def users(spark, sf_dir):
    return user_attributes(v.registrations(spark, sf_dir), ["order_id", "line_no"])


@query("attach_user_features", f"""WITH {v.G}, {v.D.split(v.LI + ',')[1]}, u AS ({USERS_SQL})
SELECT g.person_id, g.event_id, g.participated, u.gender, u.age_avg FROM g LEFT JOIN u ON g.person_id = u.person_id""")
def attach_users(spark, sf_dir):
    cells = participation_grid(v.participations(spark, sf_dir))
    return ensemble.attach_user_features(
        cells.select("person_id", "event_id", "participated"), users(spark, sf_dir))


# -- counts joined to attributes -------------------------------------------

@query("count_join_back", f"""WITH {v.P}
SELECT event_id, event_type_id, count(*) AS count FROM p GROUP BY event_id, event_type_id
ORDER BY count DESC, event_id, event_type_id LIMIT 20""")
def count_join_back(spark, sf_dir):
    return profile.count_join_back(v.participations(spark, sf_dir), "event_id", "event_type_id")


@query("largest_events", f"""WITH {v.P}
SELECT event_id, min(event_type_id) AS event_type_id, min(series_id) AS series_id, min(event_date) AS event_date,
  count(*) AS attendance FROM p GROUP BY event_id""")
def largest_events(spark, sf_dir):
    return profile.largest_events(
        v.participations(spark, sf_dir), ["event_type_id", "series_id", "event_date"])


FIRST_ROW_SQL = """fr AS (SELECT person_id, gender, age FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY order_id, line_no, event_id, age) AS rn FROM d) WHERE rn = 1)"""
FIRST_ROW = ["order_id", "line_no", "event_id", "age"]


@query("most_active_people", f"""WITH {v.D}, {FIRST_ROW_SQL}, c AS (SELECT person_id, count(*) AS attendance FROM d GROUP BY person_id)
SELECT c.person_id, fr.gender, fr.age, c.attendance FROM c JOIN fr ON c.person_id = fr.person_id
ORDER BY attendance DESC, c.person_id LIMIT 10""")
def most_active(spark, sf_dir):
    return profile.most_active_people(v.registrations(spark, sf_dir), ["gender", "age"], FIRST_ROW)


def top_lists(spark, sf_dir, k=5):
    cells = v.pseudo_score(participation_grid(v.participations(spark, sf_dir)))
    return recommend.top_k_per_person(
        cells.select("person_id", "event_id", "participated", "prediction"), k)


@query("top_event_details", f"""WITH {v.TOP5},
c AS (SELECT event_id, count(*) AS top_count FROM top GROUP BY event_id),
a AS (SELECT event_id, min(event_date) AS event_date, min(event_type_id) AS event_type_id, min(series_id) AS series_id,
  min(venue_zip) AS venue_zip, round(avg(fee), 2) AS mean_fee, round(avg(miles), 2) AS mean_miles FROM p GROUP BY event_id)
SELECT c.event_id, c.top_count, a.event_date, a.event_type_id, a.series_id, a.venue_zip, a.mean_fee, a.mean_miles
FROM c JOIN a ON c.event_id = a.event_id""")
def top_event_details(spark, sf_dir):
    return recommend.top_event_details(
        top_lists(spark, sf_dir), v.participations(spark, sf_dir),
        ["event_date", "event_type_id", "series_id", "venue_zip"])


AUDIENCE_SQL = f"""{v.TOP5}, {v.D.split(v.LI + ',')[1]}, {FIRST_ROW_SQL},
aud AS (SELECT top.event_id, top.person_id, fr.gender, fr.age FROM top JOIN fr ON top.person_id = fr.person_id)"""


def audience(spark, sf_dir):
    people = recommend.person_profile(v.registrations(spark, sf_dir), ["gender", "age"], FIRST_ROW)
    return recommend.audience_profile(top_lists(spark, sf_dir), people), people


@query("audience_profile_join", f"WITH {AUDIENCE_SQL} SELECT * FROM aud")
def audience_profile(spark, sf_dir):
    return audience(spark, sf_dir)[0]


@query("audience_gender_share", f"""WITH {AUDIENCE_SQL}
SELECT event_id, count(*) AS audience,
  round(avg(CASE WHEN gender = 'Male' THEN 1.0 ELSE 0.0 END), 6) AS male_share,
  round(avg(CASE WHEN gender = 'Female' THEN 1.0 ELSE 0.0 END), 6) AS female_share,
  (SELECT round(avg(CASE WHEN gender = 'Male' THEN 1.0 ELSE 0.0 END), 6) FROM fr WHERE gender IN ('Male', 'Female')) AS population_male_share,
  (SELECT round(avg(CASE WHEN gender = 'Female' THEN 1.0 ELSE 0.0 END), 6) FROM fr WHERE gender IN ('Male', 'Female')) AS population_female_share
FROM aud GROUP BY event_id""")
def gender_share(spark, sf_dir):
    found, people = audience(spark, sf_dir)
    return six_all(recommend.audience_gender_share(found, people), "male_share", "female_share",
                   "population_male_share", "population_female_share")


@query("audience_age", f"""WITH {AUDIENCE_SQL}
SELECT event_id, round(avg(age), 1) AS audience_age, (SELECT round(avg(age), 1) FROM d) AS population_age FROM aud GROUP BY event_id""")
def audience_age(spark, sf_dir):
    found, _ = audience(spark, sf_dir)
    return recommend.audience_age(found, v.registrations(spark, sf_dir))
