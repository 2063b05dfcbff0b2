"""Sources and sinks: files are written from the test tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnout.catalog import views as v
from turnout.catalog.registry import query, six, six_all
from turnout.operators.attendance import event_attributes
from turnout.schemas import ALS_FINAL_LEDGER, SOURCE_TABLES, typed_frame
from turnout.session import scratch_path
from turnout.sources import ledger, lookups, tables

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@query("load_tables", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def load_tables(spark, sf_dir):
    schemas = {t: v.table(spark, sf_dir, t).schema for t in TABLES}
    return tables.table_sizes(tables.load_tables(spark, sf_dir, schemas, suffix=".parquet"))


# registrations as a CSV export with source spellings; some ages are words, some people have no id
_EXPORT = """x AS (SELECT CASE WHEN order_id % 13 = 0 THEN NULL ELSE CAST(person_id AS VARCHAR) END AS person,
  CAST(event_id AS VARCHAR) AS event, distance, time,
  CASE WHEN order_id % 17 = 0 THEN 'unknown' ELSE CAST(age AS VARCHAR) END AS age, order_id, line_no FROM d)"""
_CHECKED = ("person_id", "event_id", "distance", "time", "age")


def _checked_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    order = F.col("order_id")
    v.registrations(spark, sf_dir).select(
        F.when(order % 13 != 0, F.col("person_id").cast("string")).alias("PersonID"),
        F.col("event_id").cast("string").alias("Event ID"), F.col("distance").alias("Distance"),
        F.col("time").alias("Time"),
        F.when(order % 17 == 0, F.lit("unknown")).otherwise(F.col("age").cast("string")).alias("Age"),
    ).write.csv(path, header=True)
    wanted = SOURCE_TABLES["person_events"]
    schema = type(wanted)([wanted[c] for c in _CHECKED])
    return tables.load_checked(spark, path, schema, required=("person_id",))


@query("load_checked", f"""WITH {v.D}, {_EXPORT}
SELECT CAST(person AS BIGINT) AS person_id, CAST(event AS BIGINT) AS event_id, distance, time, TRY_CAST(age AS DOUBLE) AS age
FROM x WHERE person IS NOT NULL AND age IS DISTINCT FROM 'unknown'""")
def load_checked(spark, sf_dir):
    """Rows of an export that fit the declared schema."""
    return _checked_export(spark, sf_dir)[0]


@query("load_rejected", f"""WITH {v.D}, {_EXPORT}
SELECT CASE WHEN person IS NULL AND age = 'unknown' THEN 'person_id,age' WHEN person IS NULL THEN 'person_id' ELSE 'age' END AS reasons,
  count(*) AS n_rows FROM x WHERE person IS NULL OR age = 'unknown' GROUP BY 1""")
def load_rejected(spark, sf_dir):
    """Rejected rows of the export by the columns in question."""
    rejected = _checked_export(spark, sf_dir)[1]
    return rejected.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("row").alias("n_rows"))


@query("read_series_assignments", f"""WITH {v.EV}
SELECT event_id, concat('Event, no ', CAST(event_id AS VARCHAR)) AS event_name, event_date, series_id FROM ev""")
def read_series_assignments(spark, sf_dir):
    path = scratch_path(spark, "series-assignments")
    name = F.concat(F.lit("Event, no "), F.col("event_id").cast("string"))
    event_attributes(v.participations(spark, sf_dir)).select(
        F.col("event_id").alias("EventID"), name.alias("Event_Name"),
        F.col("event_date").alias("Event_Date"), F.col("series_id").cast("double").alias("SeriesID"),
    ).write.csv(path, header=True, quote="'")
    return lookups.read_series_assignments(spark, path)


@query("read_event_zips", f"""WITH {v.EV}
SELECT event_id, concat('Event ', CAST(event_id AS VARCHAR)) AS event_name, venue_zip FROM ev""")
def read_event_zips(spark, sf_dir):
    path = scratch_path(spark, "event-zips")
    name = F.concat(F.lit("Event "), F.col("event_id").cast("string"), F.lit("\t"))
    event_attributes(v.participations(spark, sf_dir)).select(
        F.col("event_id").alias("_c0"), F.col("event_id").alias("EventID"),
        name.alias("Event_Name"), F.col("venue_zip").alias("Venue_Zip2"),
    ).write.csv(path, header=True, ignoreTrailingWhiteSpace=False)
    return lookups.read_event_zips(spark, path)


LEDGER_SQL = """
SELECT concat('type_', CAST(event_type_id AS VARCHAR)) AS als_model, CAST(venue_zip - 98000 AS DOUBLE) AS alpha,
  CAST(CASE WHEN series_id > 0 THEN 5 ELSE 10 END AS INT) AS factors,
  round(avg(prediction)*100, 6) AS model_rank, round(avg(participated)*100, 6) AS popular_rank
FROM k GROUP BY event_type_id, venue_zip, CASE WHEN series_id > 0 THEN 5 ELSE 10 END"""


def ledger_rows(spark, sf_dir):
    """Means of the pseudo-scored grid in the form of a tuning ledger."""
    from turnout.operators.grid import participation_grid

    cells = v.pseudo_score(participation_grid(v.participations(spark, sf_dir)))
    factors = F.when(F.col("series_id") > 0, 5).otherwise(10)
    return cells.groupBy(
        F.concat(F.lit("type_"), F.col("event_type_id").cast("string")).alias("als_model"),
        (F.col("venue_zip") - 98000).cast("double").alias("alpha"), factors.alias("factors"),
    ).agg(six(F.avg("prediction") * 100).alias("model_rank"),
          six(F.avg("participated") * 100).alias("popular_rank"))


@query("read_metric_ledger", f"""WITH {v.K}, led AS ({LEDGER_SQL})
SELECT als_model, 'test' AS split, alpha, factors, model_rank, popular_rank,
  CAST(CASE WHEN factors = 5 THEN 0 END AS BIGINT) AS cold_starts_dropped FROM led""")
def read_metric_ledger(spark, sf_dir):
    """Written as lines of which some lack the last field."""
    path = scratch_path(spark, "final-ledger")
    header = "als_model,trainvstest,alpha,factors,model_rank,popular_rank,cold_starts_dropped"
    line = F.concat_ws(",", "als_model", F.lit("test"), "alpha", "factors", "model_rank", "popular_rank")
    short = F.when(F.col("factors") == 5, F.concat(line, F.lit(",0"))).otherwise(line)
    lines = ledger_rows(spark, sf_dir).select(F.lit(1).alias("part"), short.alias("value"))
    titled = spark.createDataFrame([(0, header)], "part int, value string").unionByName(lines)
    titled.coalesce(1).sortWithinPartitions("part").select("value").write.text(path)
    return ledger.read_metric_ledger(spark, path, ALS_FINAL_LEDGER)


@query("write_metric_ledger", f"WITH {v.K} {LEDGER_SQL}")
def write_metric_ledger(spark, sf_dir):
    path = scratch_path(spark, "tune-ledger")
    rows = ledger_rows(spark, sf_dir)
    ledger.write_metric_ledger(rows.filter("factors = 5"), path)
    ledger.write_metric_ledger(rows.filter("factors <> 5"), path)
    return ledger.read_metric_ledger(spark, path)


@query("tuning_curve", f"""WITH {v.K}, led AS ({LEDGER_SQL})
SELECT als_model, alpha, model_rank, round(avg(popular_rank) OVER (PARTITION BY als_model), 6) AS mean_popular_rank
FROM led WHERE factors = 5""")
def tuning_curve(spark, sf_dir):
    return six_all(ledger.tuning_curve(ledger_rows(spark, sf_dir), 5), "mean_popular_rank")


@query("snapshot", f"WITH {v.EV} SELECT * FROM ev")
def snapshot(spark, sf_dir):
    events = event_attributes(v.participations(spark, sf_dir))
    return tables.snapshot(events, scratch_path(spark, "events"))


@query("sample_rows", f"""WITH {v.P}
SELECT person_id, event_id, event_date, miles FROM p ORDER BY person_id, event_id LIMIT 10""")
def sample_rows(spark, sf_dir):
    parts = v.participations(spark, sf_dir)
    return tables.sample_rows(
        parts, ["person_id", "event_id", "event_date", "miles"], ["person_id", "event_id"], 10)


# 28 positional columns out of an order line
_TYPED = [
    ("person_id", "l_suppkey", "l_suppkey", "BIGINT"),
    ("event_id", "l_orderkey", "l_orderkey", "BIGINT"),
    ("age", "l_quantity", "l_quantity", "DOUBLE"),
    ("gender", "l_returnflag", "l_returnflag", "VARCHAR"),
    ("distance", "l_linestatus", "l_linestatus", "VARCHAR"),
    ("miles", "l_linenumber", "l_linenumber", "DOUBLE"),
    ("time", "l_linestatus", "l_linestatus", "VARCHAR"),
    ("total_fee", "l_partkey", "l_partkey", "VARCHAR"),
    ("ss_prereg", "l_linenumber > 2", "l_linenumber > 2", "BOOLEAN"),
    ("registration_time", "l_shipdate", "l_shipdate", "TIMESTAMP"),
    *[(name, "l_returnflag", "l_returnflag", "VARCHAR") for name in (
        "payment_method", "street_address", "city", "state_province", "zip_code", "country",
        "emergency_contact_name", "contact", "tshirt", "hoodie", "event_name")],
    ("event_date", "l_shipdate", "l_shipdate", "TIMESTAMP"),
    ("own_event", "l_linenumber > 3", "l_linenumber > 3", "BOOLEAN"),
    ("event_type_id", "l_linenumber", "l_linenumber", "INT"),
    ("event_type", "l_linestatus", "l_linestatus", "VARCHAR"),
    ("series_id", "l_linenumber", "l_linenumber", "INT"),
    ("series", "l_returnflag", "l_returnflag", "VARCHAR"),
    ("how_heard", "l_linestatus", "l_linestatus", "VARCHAR"),
]


@query("typed_frame", "SELECT " + ", ".join(
    f"CAST({sql} AS {kind}) AS {name}" for name, _, sql, kind in _TYPED) + " FROM lineitem")
def positional_to_typed(spark, sf_dir):
    raw = v.table(spark, sf_dir, "lineitem").select(
        *[F.expr(expression).alias(f"c{i}") for i, (_, expression, _, _) in enumerate(_TYPED)])
    return typed_frame(raw)
