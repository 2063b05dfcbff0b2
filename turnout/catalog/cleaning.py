"""Cleaning steps on dirty registrations."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnout.catalog import views as v
from turnout.catalog.registry import query
from turnout.functions import cleaning as fn
from turnout.operators import prepare as step

KEYS = ["person_id", "order_id", "line_no"]
KEYS_SQL = "person_id, order_id, line_no"


def dirty(spark, sf_dir, *columns):
    d = v.registrations(spark, sf_dir)
    return d.select(*KEYS, *columns) if columns else d


@query("cast_ids", "SELECT CAST(l_orderkey AS BIGINT) AS event_id, CAST(l_suppkey AS BIGINT) AS person_id, l_linenumber AS line_no FROM lineitem")
def cast_ids(spark, sf_dir):
    raw = v.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("event_id"),
        F.col("l_suppkey").cast("double").alias("person_id"), F.col("l_linenumber").alias("line_no"))
    return step.cast_ids(raw, "event_id", "person_id")


@query("impute_age", f"""WITH {v.D},
a AS (SELECT *, CAST(round_even(avg(age) OVER (PARTITION BY person_id), 0) AS INT) AS person_age FROM d),
b AS (SELECT *, coalesce(CAST(age AS INT), person_age) AS filled FROM a)
SELECT {KEYS_SQL}, CAST(coalesce(filled, (SELECT trunc(avg(filled)) FROM b)) AS INT) AS age2 FROM b""")
def impute_age(spark, sf_dir):
    return step.impute_age(dirty(spark, sf_dir, "age")).select(*KEYS, "age2")


@query("backfill_gender", f"""WITH {v.D},
f AS (SELECT person_id, arg_min(gender, order_id * 10 + line_no) AS found FROM d WHERE gender IS NOT NULL GROUP BY person_id)
SELECT d.person_id, d.order_id, d.line_no, coalesce(d.gender, f.found, 'Other') AS gender FROM d LEFT JOIN f ON d.person_id = f.person_id""")
def backfill_gender(spark, sf_dir):
    return step.backfill_gender(dirty(spark, sf_dir, "gender"), ["order_id", "line_no"]).select(*KEYS, "gender")


@query("fill_defaults", f"""WITH {v.D} SELECT {KEYS_SQL}, coalesce(distance, 'Variable-SS') AS distance,
coalesce(gender, 'Other') AS gender, coalesce(tshirt, 'N') AS tshirt, coalesce(series_id, 0) AS series_id FROM d""")
def fill_defaults(spark, sf_dir):
    return step.fill_defaults(dirty(spark, sf_dir, "distance", "gender", "tshirt", "series_id"))


@query("impute_miles", f"""WITH {v.D},
m AS (SELECT *, coalesce(miles, CASE distance WHEN '1/2 Marathon' THEN 13.0 WHEN '5k early start' THEN 3.0
  WHEN '22 mile' THEN 22.0 WHEN '10 k' THEN 6.0 END) AS known FROM d)
SELECT {KEYS_SQL}, CAST(coalesce(known, (SELECT round(avg(known), 0) FROM m)) AS DOUBLE) AS miles2 FROM m""")
def impute_miles(spark, sf_dir):
    filled = step.fill_defaults(dirty(spark, sf_dir, "distance", "miles"), ["distance"])
    return step.impute_miles(filled, strict=True).select(*KEYS, "miles2")


@query("clean_times", f"""WITH {v.D}
SELECT {KEYS_SQL}, event_id, CASE WHEN event_id > 999 THEN '1:30:00.0' ELSE time END AS time2 FROM d
WHERE event_id > 999 OR time IS NOT NULL""")
def clean_times(spark, sf_dir):
    return step.clean_times(dirty(spark, sf_dir, "event_id", "time")).drop("time")


@query("coerce_fee", f"""WITH {v.D}, n AS (SELECT *, try_cast(total_fee AS DOUBLE) AS fee FROM d)
SELECT {KEYS_SQL}, coalesce(fee, (SELECT round(avg(fee), 2) FROM n)) AS total_fee FROM n""")
def coerce_fee(spark, sf_dir):
    return step.coerce_fee(dirty(spark, sf_dir, "total_fee"))


@query("prereg_flag", f"""WITH {v.D}
SELECT {KEYS_SQL}, CAST(CASE WHEN ss_prereg OR registration_time IS NOT NULL THEN 1 ELSE 0 END AS INT) AS preregistered FROM d""")
def prereg_flag(spark, sf_dir):
    return step.prereg_flag(dirty(spark, sf_dir, "ss_prereg", "registration_time")).select(*KEYS, "preregistered")


@query("presence_flag", f"""WITH {v.D}
SELECT {KEYS_SQL}, CAST(CASE WHEN tshirt IS NOT NULL THEN 1 ELSE 0 END AS INT) AS has_tshirt FROM d""")
def presence_flag(spark, sf_dir):
    return step.presence_flag(dirty(spark, sf_dir, "tshirt"), "tshirt", "has_tshirt")


PAYMENT_SQL = """CASE WHEN payment_method IN ('Cash', 'cash/comp') THEN 'cash' WHEN payment_method = 'Check' THEN 'check'
  WHEN payment_method IN ('Authorize', 'CC', 'cc', '$261 CC, $30 cash', 'credit') THEN 'credit'
  WHEN payment_method IN ('PayPal', 'PayPal pending') THEN 'paypal' WHEN payment_method = 'Comp' THEN 'comp'
  WHEN payment_method IS NOT NULL THEN 'other' END"""


@query("bucket_payment", f"WITH {v.D} SELECT {KEYS_SQL}, {PAYMENT_SQL} AS payment_method FROM d")
def bucket_payment(spark, sf_dir):
    return step.bucket_payment(dirty(spark, sf_dir, "payment_method")).drop("has_pay_method")


@query("has_payment_flag", f"""WITH {v.D}
SELECT {KEYS_SQL}, CASE WHEN payment_method IS NULL THEN 'N' ELSE 'Y' END AS has_pay_method FROM d""")
def has_payment_flag(spark, sf_dir):
    return step.bucket_payment(dirty(spark, sf_dir, "payment_method")).drop("payment_method")


CONTACT_SQL = """CASE WHEN contact IN ('no', 'NO', '0') THEN 'No' WHEN contact IN ('yes', 'YES', '-1') THEN 'Yes'
  WHEN contact IS NULL THEN 'No Response' ELSE contact END"""


@query("bucket_contact", f"WITH {v.D} SELECT {KEYS_SQL}, {CONTACT_SQL} AS contact FROM d")
def bucket_contact(spark, sf_dir):
    return step.bucket_contact(dirty(spark, sf_dir, "contact"))


UNIFY_SQL = """CASE WHEN event_type = 'Street Scramble' THEN 4 WHEN series_id = 4 THEN 1 WHEN series_id = 5 THEN 2
  WHEN series_id = 6 THEN 3 ELSE series_id END"""


@query("unify_series", f"WITH {v.D} SELECT {KEYS_SQL}, CAST({UNIFY_SQL} AS INT) AS series_id FROM d")
def unify_series(spark, sf_dir):
    return step.unify_series(dirty(spark, sf_dir, "series_id", "event_type")).drop("event_type")


@query("has_series_flag", f"""WITH {v.D}
SELECT {KEYS_SQL}, CASE WHEN ({UNIFY_SQL}) IS NOT NULL THEN 'Y' ELSE 'N' END AS has_series FROM d""")
def has_series_flag(spark, sf_dir):
    unified = step.unify_series(dirty(spark, sf_dir, "series_id", "event_type"))
    return unified.select(*KEYS, fn.has_series_flag(F.col("series_id")).alias("has_series"))


@query("decode_series", f"""WITH {v.P}
SELECT person_id, event_id, CASE series_id WHEN 0 THEN 'No Series' WHEN 1 THEN 'Winter Series' WHEN 2 THEN 'Half Marathon Series'
  WHEN 3 THEN 'Summer Series' WHEN 4 THEN 'Street Scramble' END AS series FROM p""")
def decode_series(spark, sf_dir):
    return v.participations(spark, sf_dir).select(
        "person_id", "event_id", fn.decode_series(F.col("series_id")).alias("series"))


@query("parse_zip", f"""WITH {v.D}
SELECT {KEYS_SQL}, coalesce(try_cast(CASE WHEN series_id IS NULL THEN 'none' WHEN series_id = 1 THEN NULL
  ELSE CAST(98000 + order_id % 200 AS VARCHAR) END AS INT), -1) AS venue_zip FROM d""")
def parse_zip(spark, sf_dir):
    text = F.when(F.col("series_id").isNull(), "none").when(
        F.col("series_id") != 1, (98000 + F.col("order_id") % 200).cast("string"))
    return dirty(spark, sf_dir, "series_id").select(*KEYS, fn.parse_zip(text).alias("venue_zip"))


@query("patch_value", f"""WITH {v.P}
SELECT person_id, event_id, CAST(CASE WHEN series_id = 2 THEN 98177 ELSE venue_zip END AS INT) AS venue_zip FROM p""")
def patch_value(spark, sf_dir):
    return v.participations(spark, sf_dir).select(
        "person_id", "event_id",
        fn.patch_value(F.col("venue_zip"), F.col("series_id") == 2, 98177).alias("venue_zip"))


@query("project_drop", f"WITH {v.P} SELECT DISTINCT event_id, event_date, series_id, event_type_id, venue_zip FROM p")
def project_drop(spark, sf_dir):
    frames = step.project_frames(
        v.participations(spark, sf_dir), ["person_id"],
        ["event_id", "event_date", "series_id", "event_type_id", "venue_zip"])
    return frames["event"]


@query("add_label", f"WITH {v.P} SELECT person_id, event_id, event_date, 1 AS participated FROM p")
def add_label(spark, sf_dir):
    return step.add_label(v.participations(spark, sf_dir).select("person_id", "event_id", "event_date"))


@query("item_bucket", f"""WITH {v.P}
SELECT person_id, event_id, CAST(round(fee) AS INT) AS fee_item, CAST(round(miles / 2.0) AS INT) AS miles_item FROM p""")
def item_bucket(spark, sf_dir):
    return v.participations(spark, sf_dir).select(
        "person_id", "event_id", fn.item_bucket(F.col("fee")).alias("fee_item"),
        fn.item_bucket(F.col("miles") / 2).alias("miles_item"))


@query("truncate_dates", """SELECT o_custkey AS person_id,
  string_agg(strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d'), ',' ORDER BY o_orderdate) AS days
FROM orders GROUP BY o_custkey""")
def truncate_dates(spark, sf_dir):
    """Order times per customer, every one of them, cut to days."""
    orders = v.table(spark, sf_dir, "orders")
    lists = orders.groupBy(F.col("o_custkey").alias("person_id")).agg(
        F.sort_array(F.collect_list("o_orderdate")).alias("moments"))
    days = fn.truncate_dates(F.col("moments")).cast("array<string>")
    return lists.select("person_id", F.array_join(days, ",").alias("days"))


@query("epoch_align", """SELECT event_id, date_trunc('second', ts) AS second,
  CAST(floor(epoch(ts)) AS BIGINT) * 1000000000 AS event_ns FROM events""")
def epoch_align(spark, sf_dir):
    ts = F.col("ts")
    return v.table(spark, sf_dir, "events").select(
        "event_id", fn.whole_seconds(ts).cast("timestamp_ntz").alias("second"),
        fn.epoch_align(ts).alias("event_ns"))


@query("zero_to_null", f"WITH {v.P} SELECT person_id, event_id, nullif(series_id, 0) AS series_id FROM p")
def zero_to_null(spark, sf_dir):
    return v.participations(spark, sf_dir).select(
        "person_id", "event_id", fn.zero_to_null(F.col("series_id")).alias("series_id"))


@query("filter_by_value", f"WITH {v.EV} SELECT * FROM ev WHERE series_id = 2")
def filter_by_value(spark, sf_dir):
    from turnout.operators.attendance import event_attributes

    events = event_attributes(v.participations(spark, sf_dir))
    return step.filter_by_value(events, "series_id", 2, ["event_date", "event_id"])


@query("missing_value_domain", f"WITH {v.D} SELECT DISTINCT distance FROM d WHERE miles IS NULL")
def missing_value_domain(spark, sf_dir):
    return step.missing_value_domain(dirty(spark, sf_dir), "miles", "distance")


# -- the whole chain -------------------------------------------------------

@query("clean_registrations", f"""WITH {v.D},
a AS (SELECT *, CAST(round_even(avg(age) OVER (PARTITION BY person_id), 0) AS INT) AS person_age FROM d),
b AS (SELECT *, coalesce(CAST(age AS INT), person_age) AS filled, coalesce(miles, CASE distance WHEN '1/2 Marathon' THEN 13.0
  WHEN '5k early start' THEN 3.0 WHEN '22 mile' THEN 22.0 WHEN '10 k' THEN 6.0 END) AS known FROM a),
c AS (SELECT *, CAST(coalesce(filled, (SELECT trunc(avg(filled)) FROM b)) AS INT) AS age2,
  CAST(coalesce(known, (SELECT round(avg(known), 0) FROM b)) AS DOUBLE) AS miles2, try_cast(total_fee AS DOUBLE) AS fee FROM b),
e AS (SELECT * FROM c WHERE event_id > 999 OR time IS NOT NULL),
f AS (SELECT *, CASE WHEN event_id < 3 THEN 0 ELSE CAST({UNIFY_SQL} AS INT) END AS sid FROM e)
SELECT {KEYS_SQL}, event_id, age2, coalesce(gender, 'Other') AS gender, coalesce(distance, 'Variable-SS') AS distance, miles2,
  CASE WHEN event_id > 999 THEN '1:30:00.0' ELSE time END AS time2,
  coalesce(fee, (SELECT round(avg(fee), 2) FROM e)) AS total_fee,
  CAST(CASE WHEN ss_prereg OR registration_time IS NOT NULL THEN 1 ELSE 0 END AS INT) AS preregistered,
  CASE WHEN sid IS NOT NULL THEN 'Y' ELSE 'N' END AS has_series, coalesce(sid, 0) AS series_id,
  {PAYMENT_SQL} AS payment_method, {CONTACT_SQL} AS contact, coalesce(tshirt, 'N') AS tshirt FROM f""")
def clean_registrations(spark, sf_dir):
    from turnout.plans.preparation import clean

    d = v.registrations(spark, sf_dir).withColumns({
        "emergency_contact_name": F.col("tshirt"), "hoodie": F.col("tshirt"),
        "series": F.col("event_type"), "how_heard": F.col("contact")})
    assigned = d.select("event_id").distinct().filter("event_id < 3").withColumn("series_id", F.lit(0))
    return clean(d, assigned, strict_miles=True).select(
        *KEYS, "event_id", "age2", "gender", "distance", "miles2", "time2", "total_fee",
        "preregistered", "has_series", "series_id", "payment_method", "contact", "tshirt")
