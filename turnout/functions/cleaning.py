"""Column expressions for cleaning registrations. All of them stay in codegen."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from turnout import fixed_values as fv


def _lookup(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def _respell(column: Column, spellings: dict[str, list[str]]) -> Column | None:
    """The bucket whose spellings contain the value, else NULL."""
    buckets = [F.when(column.isin(found), F.lit(bucket)) for bucket, found in spellings.items()]
    return F.coalesce(*buckets)


def bucket_payment(column: Column) -> Column:
    """Free payment text to a bucket; a missing method stays missing.

    Texts that are bucket names already count as that bucket.
    """
    known = {bucket: found + [bucket] for bucket, found in fv.PAYMENT_SPELLINGS.items()}
    return F.coalesce(_respell(column, known),
                      F.when(column.isNotNull(), F.lit(fv.PAYMENT_OTHER)))


def has_payment_flag(column: Column) -> Column:
    return F.when(column.isNull(), F.lit("N")).otherwise(F.lit("Y"))


def bucket_contact(column: Column) -> Column:
    """Yes / No / No Response; other answers are kept as they are."""
    return F.coalesce(_respell(column, fv.CONTACT_SPELLINGS), column, F.lit(fv.CONTACT_MISSING))


def unify_series(series_id: Column, event_type: Column) -> Column:
    """One id per series over the years; scrambles always form their own series."""
    unified = F.coalesce(_lookup(fv.SERIES_SAME_AS)[series_id], series_id)
    return F.when(event_type == fv.SCRAMBLE_EVENT_TYPE, F.lit(fv.SCRAMBLE_SERIES)).otherwise(unified)


def has_series_flag(series_id: Column) -> Column:
    """Take this before missing ids are set to 0."""
    return F.when(series_id.isNotNull(), F.lit("Y")).otherwise(F.lit("N"))


def decode_series(series_id: Column) -> Column:
    return _lookup(fv.SERIES_LABELS)[series_id]


def miles_by_distance(distance: Column) -> Column:
    return _lookup(fv.DISTANCE_MILES)[distance]


def clean_time(event_id: Column, time: Column) -> Column:
    """Set time for timed events, the recorded time otherwise."""
    return F.when(event_id > fv.TIMED_EVENT_LIMIT, F.lit(fv.TIMED_EVENT_TIME)).otherwise(time)


def number_or_null(column: Column) -> Column:
    """Text to number; text that is no number, and NaN, become NULL."""
    return F.nanvl(column.try_cast("double"), F.lit(None))


def prereg_flag(prereg: Column, registration_time: Column) -> Column:
    early = F.coalesce(prereg, F.lit(False)) | registration_time.isNotNull()
    return early.cast("int")


def presence_flag(column: Column) -> Column:
    return column.isNotNull().cast("int")


def parse_zip(column: Column) -> Column:
    return F.coalesce(column.try_cast("int"), F.lit(fv.UNKNOWN_ZIP))


def patch_value(column: Column, where: Column, value) -> Column:
    """Replace the value of the rows that match."""
    return F.when(where, F.lit(value)).otherwise(column)


def item_bucket(column: Column) -> Column:
    """Whole-number item id of a measure, halves away from zero."""
    return F.round(column).cast("int")


def truncate_dates(dates: Column) -> Column:
    return F.transform(dates, lambda d: F.to_date(d))


def whole_seconds(moment: Column) -> Column:
    """Timestamp cut to whole seconds, so that it can serve as a join key."""
    return F.date_trunc("second", moment)


def epoch_align(moment: Column) -> Column:
    """Nanoseconds since 1970 on whole seconds."""
    return F.unix_seconds(whole_seconds(moment).cast("timestamp")) * F.lit(1_000_000_000)


def zero_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(0))
