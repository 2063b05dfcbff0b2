"""Cleaning steps over participation frames.

Each step adds or replaces columns; ``turnout.plans.preparation`` puts them in
the order the results depend on. Means used for filling are scalar subqueries,
so nothing passes through the driver; per-person values are stored before they are
joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnout import fixed_values as fv
from turnout.functions import cleaning as fn
from turnout.session import cut_lineage


def cast_ids(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns or ("person_id",)})


def known_ages(df: DataFrame) -> DataFrame:
    """Per person: rows, rows with an age, mean known age with halves to even."""
    age = F.col("age").cast("int")
    return df.groupBy("person_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.count(age).alias("_known"), F.sum(age).alias("_ages"),
    ).withColumn("_person_age", F.bround(F.try_divide("_ages", "_known"), 0).cast("int"))


def impute_age(df: DataFrame) -> DataFrame:
    """Adds ``age2``: own age, else the person's mean, else the overall mean cut to a whole.

    The overall mean counts ages filled from the person's mean. It comes from the
    per-person totals, not from a second pass over the filled rows. These totals are
    stored, as both need them and the join can then split a person with very many rows.
    """
    ages = cut_lineage(known_ages(df))
    total = F.sum(F.col("_ages") + (F.col("_rows") - F.col("_known")) * F.col("_person_age"))
    overall = ages.filter("_known > 0").agg(
        F.try_divide(total, F.sum("_rows")).cast("int").alias("mean_age")).scalar()
    return (
        df.join(ages.select("person_id", "_person_age"), "person_id", "left")
        .withColumn("age2", F.coalesce(F.col("age").cast("int"), F.col("_person_age"), overall))
        .drop("_person_age")
    )


def backfill_gender(df: DataFrame, order: list[str]) -> DataFrame:
    """A missing gender is taken from the person's first row that has one, else 'Other'."""
    first = cut_lineage(df.filter(F.col("gender").isNotNull()).groupBy("person_id").agg(
        F.min_by("gender", F.struct(*order)).alias("_gender")))
    return (
        df.join(first, "person_id", "left")
        .withColumn("gender", F.coalesce("gender", "_gender", F.lit(fv.DEFAULT_GENDER)))
        .drop("_gender")
    )


DEFAULTS = {
    "distance": fv.DEFAULT_DISTANCE,
    "gender": fv.DEFAULT_GENDER,
    "tshirt": fv.DEFAULT_TSHIRT,
    "hoodie": fv.DEFAULT_HOODIE,
    "series_id": fv.DEFAULT_SERIES,
}


def fill_defaults(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Constant fills for the columns present (or for ``columns``)."""
    chosen = columns or [c for c in DEFAULTS if c in df.columns]
    return df.na.fill({c: DEFAULTS[c] for c in chosen})


def known_miles(strict: bool = False) -> Column:
    """Recorded miles, else those of the distance name; needs the filled distance."""
    by_name = fn.miles_by_distance(F.col("distance"))
    if strict:
        unlisted = F.col("distance") != fv.DEFAULT_DISTANCE
        by_name = F.coalesce(by_name, F.when(unlisted, F.raise_error(
            F.concat(F.lit("no miles for distance "), F.col("distance")))))
    return F.coalesce(F.col("miles"), by_name)


def impute_miles(df: DataFrame, strict: bool = False) -> DataFrame:
    """Adds ``miles2``; what is still missing gets the mean as a whole number."""
    mean = df.agg(F.round(F.avg(known_miles(strict)), 0).alias("mean_miles")).scalar()
    return df.withColumn("miles2", F.coalesce(known_miles(strict), mean))


def clean_times(df: DataFrame) -> DataFrame:
    """Adds ``time2``; rows that are left without a time are dropped."""
    time = fn.clean_time(F.col("event_id"), F.col("time"))
    return df.withColumn("time2", time).filter(F.col("time2").isNotNull())


def coerce_fee(df: DataFrame) -> DataFrame:
    """Fee text to number; what is no number gets the mean with two decimals."""
    fee = fn.number_or_null(F.col("total_fee"))
    mean = df.agg(F.round(F.avg(fee), 2).alias("mean_fee")).scalar()
    return df.withColumn("total_fee", F.coalesce(fee, mean))


def prereg_flag(df: DataFrame) -> DataFrame:
    flag = fn.prereg_flag(F.col("ss_prereg"), F.col("registration_time"))
    return df.withColumn("preregistered", flag)


def presence_flag(df: DataFrame, column: str, flag: str) -> DataFrame:
    """Replace a text by whether it is there."""
    return df.withColumn(flag, fn.presence_flag(F.col(column))).drop(column)


def bucket_payment(df: DataFrame) -> DataFrame:
    bucket = fn.bucket_payment(F.col("payment_method"))
    return df.withColumn("payment_method", bucket).withColumn(
        "has_pay_method", fn.has_payment_flag(F.col("payment_method")))


def bucket_contact(df: DataFrame) -> DataFrame:
    return df.withColumn("contact", fn.bucket_contact(F.col("contact")))


def unify_series(df: DataFrame) -> DataFrame:
    unified = fn.unify_series(F.col("series_id"), F.col("event_type"))
    return df.withColumn("series_id", unified)


def missing_value_domain(df: DataFrame, missing: str, shown: str) -> DataFrame:
    """Distinct values of one column where another is missing."""
    return df.filter(F.col(missing).isNull()).select(shown).distinct()


def filter_by_value(df: DataFrame, column: str, value, newest_by: list[str]) -> DataFrame:
    """Rows with one value, newest first."""
    return df.filter(F.col(column) == value).orderBy(*[F.desc(c) for c in newest_by])


PERSON_COLUMNS = ["person_id", "gender", "age2", "city", "state_province", "zip_code", "country"]
EVENT_COLUMNS = ["event_id", "event_name", "event_date", "own_event", "event_type_id",
                 "event_type", "series_id", "venue_zip"]


def project_frames(df: DataFrame, person: list[str] = PERSON_COLUMNS,
                   event: list[str] = EVENT_COLUMNS) -> dict[str, DataFrame]:
    """Event, person and participation columns as frames of their own."""
    own = [c for c in df.columns if c not in set(person) | set(event)]
    return {
        "person": df.select(*person).distinct(),
        "event": df.select(*event).distinct(),
        "participation": df.select("person_id", "event_id", *own),
    }


def add_label(df: DataFrame) -> DataFrame:
    return df.withColumn("participated", F.lit(1))
