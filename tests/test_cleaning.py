import pytest
from pyspark.sql import functions as F

from turnout.functions import cleaning as fn
from turnout.operators import prepare as step
from turnout.operators.joins import ci_key_join, master_join, override_lookup, strict_lookup
from turnout.plans.preparation import clean, enrich, participation_core, prepare_participations
from turnout.schemas import PARTICIPATION, SOURCE_TABLES


def column(spark, kind, values, expression):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    found = rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in found]


def test_payment_spellings(spark):
    values = ["Cash", "cash/comp", "Check", "Authorize", "CC", "cc", "$261 CC, $30 cash", "PayPal",
              "PayPal pending", "Comp", "gift", "credit", None]
    assert column(spark, "string", values, fn.bucket_payment) == [
        "cash", "cash", "check", "credit", "credit", "credit", "credit", "paypal", "paypal", "comp",
        "other", "credit", None]
    assert column(spark, "string", ["Cash", None], fn.has_payment_flag) == ["Y", "N"]


def test_contact_spellings(spark):
    values = ["no", "NO", "0", "yes", "YES", "-1", "maybe", None]
    assert column(spark, "string", values, fn.bucket_contact) == [
        "No", "No", "No", "Yes", "Yes", "Yes", "maybe", "No Response"]


def test_series_ids(spark):
    unified = column(spark, "int", [1, 4, 5, 6, 9, None],
                     lambda c: fn.unify_series(c, F.lit("Trail Run")))
    assert unified == [1, 1, 2, 3, 9, None]
    scramble = column(spark, "int", [4, None], lambda c: fn.unify_series(c, F.lit("Street Scramble")))
    assert scramble == [4, 4]
    assert column(spark, "int", [0, 3, 7], fn.decode_series) == ["No Series", "Summer Series", None]


def test_small_expressions(spark):
    assert column(spark, "string", ["98101", "n/a", None], fn.parse_zip) == [98101, -1, -1]
    assert column(spark, "string", ["12.5", "comp", "NaN", None], fn.number_or_null) == [12.5, None, None, None]
    assert column(spark, "double", [2.5, 3.5, -2.5], fn.item_bucket) == [3, 4, -3]
    assert column(spark, "int", [0, 4], fn.zero_to_null) == [None, 4]
    assert column(spark, "boolean", [True, False, None],
                  lambda c: fn.prereg_flag(c, F.lit(None).cast("timestamp"))) == [1, 0, 0]
    assert column(spark, "timestamp_ntz", [], fn.epoch_align) == []


def test_ages_round_half_to_even_and_overall_mean_is_cut(spark):
    rows = [(1, 20.0), (1, 21.0), (1, None),          # mean 20.5 -> 20
            (2, 21.0), (2, 22.0), (2, None),          # mean 21.5 -> 22
            (3, None)]                                # overall (20+21+20+21+22+22)/6 = 21.0
    found = step.impute_age(spark.createDataFrame(rows, "person_id long, age double")).collect()
    assert sorted((r.person_id, r.age2) for r in found if r.age is None) == [(1, 20), (2, 22), (3, 21)]


def test_miles_by_name_then_mean(spark):
    rows = spark.createDataFrame(
        [("10 k", None), ("Variable-SS", None), ("anything", 2.0), ("22 mile", 5.0)],
        "distance string, miles double")
    found = {r.distance: r.miles2 for r in step.impute_miles(rows, strict=True).collect()}
    assert found == {"10 k": 6.0, "Variable-SS": 4.0, "anything": 2.0, "22 mile": 5.0}
    unlisted = spark.createDataFrame([("3 laps", None)], "distance string, miles double")
    assert step.impute_miles(unlisted).collect()[0].miles2 is None
    with pytest.raises(Exception, match="no miles for distance"):
        step.impute_miles(unlisted, strict=True).collect()


def test_gender_backfill(spark):
    rows = spark.createDataFrame(
        [(1, 1, None), (1, 2, "Female"), (1, 3, "Male"), (2, 1, None)], "person_id long, n int, gender string")
    found = sorted((r.person_id, r.n, r.gender) for r in step.backfill_gender(rows, ["n"]).collect())
    assert found == [(1, 1, "Female"), (1, 2, "Female"), (1, 3, "Male"), (2, 1, "Other")]


def test_lookups(spark):
    rows = spark.createDataFrame([(1, 7), (2, 7), (3, None)], "event_id long, series_id int")
    listed = spark.createDataFrame([(2, 0), (3, None)], "event_id long, series_id int")
    found = sorted((r.event_id, r.series_id) for r in
                   override_lookup(rows, listed, "event_id", "series_id").collect())
    assert found == [(1, 7), (2, 0), (3, None)]
    zips = spark.createDataFrame([(1, 98101), (2, 98102)], "event_id long, venue_zip int")
    assert strict_lookup(rows, zips, "event_id", "venue_zip", strict=False).count() == 3
    with pytest.raises(Exception, match="no venue_zip for event_id 3"):
        strict_lookup(rows, zips, "event_id", "venue_zip").collect()


def test_case_insensitive_join_keeps_left_spelling_and_fans_out(spark):
    left = spark.createDataFrame([("10 K",), (None,)], "distance string")
    right = spark.createDataFrame([("10 k", 6.0), ("10 K", 6.2)], "distance string, miles double")
    found = sorted(ci_key_join(left, right, "distance").collect(), key=str)
    assert [(r.distance, r.miles) for r in found if r.distance] == [("10 K", 6.0), ("10 K", 6.2)]
    assert len(found) == 3


def tables(spark):
    def frame(name, rows):
        return spark.createDataFrame(rows, SOURCE_TABLES[name])

    def person_event(person, event, distance="10 k", time="0:40:00.0", age=30.0, fee="20", **more):
        values = dict(person_id=person, event_id=event, distance=distance, time=time, age=age,
                      total_fee=fee, **more)
        return tuple(values.get(f.name) for f in SOURCE_TABLES["person_events"])

    return {
        "person_events": frame("person_events", [
            person_event(1, 10, fee="10"), person_event(1, 1000, time=None, age=None, fee="x"),
            person_event(2, 10, time=None, fee="1000", age=61.0), person_event(2, 11, fee="30", age=61.0),
            person_event(3, 29, age=None, distance="10 K", fee="20",
                         emergency_contact_name="someone", payment_method="Check")]),
        "events": frame("events", [(e, f"event {e}", None, True, 2 if e == 1000 else 1)
                                   for e in (10, 11, 29, 1000)]),
        "series_events": frame("series_events", [(11, 5), (1000, 9)]),
        "series": frame("series", [(5, "Half 2017")]),
        "distances": frame("distances", [("10 k", 6.2)]),
        "event_types": frame("event_types", [(1, "Trail Run"), (2, "Street Scramble")]),
        "persons": frame("persons", [(1, "Male"), (2, "Female")]),
        "ss_team_people": frame("ss_team_people", [(1, 1000, True, "web")]),
    }


def test_master_join_and_clean_chain(spark, tmp_path):
    source = tables(spark)
    raw = master_join(source)
    assert raw.columns == PARTICIPATION.names and raw.count() == 5
    assigned = spark.createDataFrame([(29, 0)], "event_id long, series_id int")
    zips = spark.createDataFrame([(e, 98000 + e) for e in (10, 11, 29, 1000)], "event_id long, venue_zip int")
    done = prepare_participations(source, assigned, zips, str(tmp_path / "raw"))
    rows = {(r.person_id, r.event_id): r for r in done.collect()}
    # the untimed row without a time is gone, the timed event got its set time
    assert set(rows) == {(1, 10), (1, 1000), (2, 11), (3, 29)}
    assert rows[1, 1000].time2 == "1:30:00.0"
    # mean fee of the rows kept: (10 + 30 + 20) / 3, the dropped 1000 does not count
    assert rows[1, 1000].total_fee == 20.0
    # overall mean age counts all rows and filled ones: (30 + 30 + 61 + 61) / 4 = 45.5
    assert rows[1, 1000].age2 == 30 and rows[3, 29].age2 == 45
    # assigned series 0 counts as having a series, none at all does not
    assert (rows[3, 29].has_series, rows[3, 29].series_id) == ("Y", 0)
    assert (rows[1, 10].has_series, rows[1, 10].series_id) == ("N", 0)
    assert rows[1, 1000].series_id == 4 and rows[2, 11].series_id == 2
    assert rows[3, 29].gender == "Other" and rows[3, 29].distance == "10 K"
    assert rows[3, 29].has_emerg_contact == 1 and rows[3, 29].payment_method == "check"
    assert rows[1, 1000].preregistered == 1 and rows[1, 10].preregistered == 0
    assert rows[3, 29].venue_zip == 98029 and rows[1, 10].contact == "No Response"
    assert participation_core(done).columns[-2:] == ["fee", "miles"]
    with pytest.raises(Exception, match="no venue_zip"):
        enrich(clean(raw, assigned), zips.filter("event_id <> 29")).collect()
